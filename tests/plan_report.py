"""Plan shape of every registered query: shuffles, broadcasts, joins, limits.

Usage: python tests/plan_report.py [sf_dir] > PLANS.md
Counts operators in the initial physical plan (before AQE re-planning, which
may turn a sort-merge join into a broadcast join when a side is small). A
stage that a query writes first has a row of its own, ``name (stage)``, with
the plan that fills it; in later plans it is a scan.
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

PATTERNS = {
    "hash shuffles": r"Exchange hashpartitioning",
    "range shuffles": r"Exchange rangepartitioning",
    "single-partition": r"Exchange SinglePartition",
    "broadcasts": r"BroadcastExchange",
    "sort-merge joins": r"SortMergeJoin",
    "broadcast joins": r"BroadcastHashJoin",
    "products": r"CartesianProduct",
    "nested loops": r"BroadcastNestedLoopJoin",
    "Python nodes": r"MapInArrow|ArrowEvalPython|FlatMapGroups|BatchEvalPython|MapInPandas",
    "window group limits": r"WindowGroupLimit",
    "take-ordered": r"TakeOrderedAndProject",
}


def main() -> None:
    from encore.session import get_session
    from pyspark.sql.readwriter import DataFrameWriter
    import __spark_entry__ as entry
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = get_session("local[8]", shuffle_partitions=8)
    print("| key | " + " | ".join(PATTERNS) + " |")
    print("| --- |" + " --- |" * len(PATTERNS))

    def row(name, df):
        plan = df._jdf.queryExecution().executedPlan().toString()
        print(f"| {name} | " + " | ".join(str(len(re.findall(p, plan))) for p in PATTERNS.values()) + " |", flush=True)

    write = DataFrameWriter.parquet

    def noted(self, path, *args, **kwargs):
        row(re.sub(r"-[0-9a-f]{32}.*", "", os.path.basename(path)) + " (stage)", self._df)
        return write(self, path, *args, **kwargs)

    DataFrameWriter.parquet = noted
    for key, q in entry.queries().items():
        if key not in ("als_sweep", "als_grid"):  # one model fit a setting
            row(key, q(spark, sf))
    spark.stop()


if __name__ == "__main__":
    main()

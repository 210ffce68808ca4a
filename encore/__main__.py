"""Run the offline evaluation on a data folder and print the comparison tables.

    python -m encore /root/testdata/sf0.01 --k 10 --beta 5000 --als-rank 8

Prints the popularity model's MAP@k on the four segments, the beta sweep on
the validation segments and the ALS model's MAP@k on warm validation users.
The tables are one row per metric; nothing else is collected.
"""

from __future__ import annotations

import argparse

from pyspark.sql import functions as F

from encore.operators import metrics, report
from encore.plans.study import SEGMENTS, Params, Study
from encore.session import get_session
from encore.sources.tables import release_all


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(prog="python -m encore")
    ap.add_argument("data", help="folder with orders / lineitem / customer / part Parquet tables")
    ap.add_argument("--master", default=None)
    ap.add_argument("--k", type=int, default=10)
    ap.add_argument("--beta", type=float, default=5000.0)
    ap.add_argument("--fraction", type=float, default=0.5)
    ap.add_argument("--min-items", type=int, default=10)
    ap.add_argument("--als-rank", type=int, default=8)
    ap.add_argument("--als-iter", type=int, default=5)
    ap.add_argument("--no-als", action="store_true")
    args = ap.parse_args(argv)

    spark = get_session(args.master, app="encore")
    params = Params(fraction=args.fraction, min_items=args.min_items, beta=args.beta, k=args.k,
                    als=dict(rank=args.als_rank, reg=0.5, alpha=1.0, max_iter=args.als_iter,
                             user_blocks=10, item_blocks=10, seed=42))
    s = Study(spark, args.data, params)
    rows = [report.metric_row(s.popularity_map(seg), "popularity", seg, "map", args.k) for seg in SEGMENTS]
    if not args.no_als:
        recs = s.als_recs("val_warm")
        scored = metrics.map_at_k(s.labels("val_warm"), recs, args.k, recs.select("user_id"))
        rows.append(report.metric_row(scored, "als", "val_warm", "map", args.k))
    report.compare_models(rows).show(truncate=False)
    s.beta_sweep().orderBy("segment", F.col("beta")).show(truncate=False)
    release_all(spark)
    spark.stop()


if __name__ == "__main__":
    main()

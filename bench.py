"""Benchmark: the end-to-end evaluation at $BENCH_SF_DIR on local[$BENCH_CPUS].

Prints one JSON line: {"metric", "value" (total seconds), "unit", "queries"
(seconds per step), "sf"}. Steps run in pipeline order; each one forces its
result (count / collect), and shared stages are checkpointed once, so a step's
time is its own work.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    from encore.session import get_session
    conf = {"spark.driver.memory": "16g", "spark.sql.files.maxPartitionBytes": os.environ.get("BENCH_SPLIT", "128m")}
    if os.environ.get("BENCH_EVENT_LOG"):
        conf.update({"spark.eventLog.enabled": "true", "spark.eventLog.dir": os.environ["BENCH_EVENT_LOG"]})
    spark = get_session(f"local[{cpus}]", app="encore-bench", shuffle_partitions=int(cpus), conf=conf)
    from encore.operators import als, index
    from encore.plans.catalog import QUERIES, study

    s = study(spark, sf_dir)
    times: dict[str, float] = {}

    def step(name, fn):
        t0 = time.time()
        out = fn()
        times[name] = round(time.time() - t0, 3)
        print(f"{name}: {times[name]}s -> {out}", file=sys.stderr, flush=True)

    step("interactions", lambda: s.ix.count())
    step("popular_items", lambda: s.popular.count())
    step("prepare_core", lambda: s.core.count())
    step("split", lambda: s.labelled.count())
    step("user_percent_rank", lambda: s.user_ranks.count())
    step("popularity_top_k", lambda: s.top.count())
    step("popularity_report", lambda: QUERIES["popularity_report"](spark, sf_dir).collect()[0]["value"])
    step("beta_sweep", lambda: QUERIES["beta_sweep"](spark, sf_dir).count())
    step("ranking_metrics", lambda: s.popularity_summary("val_warm").collect()[0]["ndcg"])
    step("auc_popularity", lambda: QUERIES["auc_popularity"](spark, sf_dir).collect()[0]["auc"])
    step("item_index", lambda: index.fit_item_index(s.core).count())
    step("coo_triples", lambda: QUERIES["coo_triples"](spark, sf_dir).count())
    step("prepare_catalogue", lambda: QUERIES["prepare_catalogue"](spark, sf_dir).count())
    step("recs_unseen", lambda: QUERIES["recs_unseen"](spark, sf_dir).count())
    step("als_fit", lambda: s.als_model.rank)
    step("als_map", lambda: QUERIES["als_map"](spark, sf_dir).collect()[0]["map"])
    step("als_topk_product", lambda: als.recommend_als(s.als_model, s.p.k).count())
    step("als_topk_exact", lambda: als.recommend_exact(s.als_model, s.p.k).count())
    step("auc_als", lambda: QUERIES["auc_als"](spark, sf_dir).collect()[0]["auc"])
    step("popularity_intervals", lambda: QUERIES["popularity_intervals"](spark, sf_dir).count())
    step("csr_roundtrip", lambda: QUERIES["csr_roundtrip"](spark, sf_dir).count())
    step("als_indexed_recs", lambda: QUERIES["als_indexed_recs"](spark, sf_dir).count())
    small = [dict(rank=r) for r in als.REFERENCE_AXES["rank"][:2]]
    step("als_sweep_two_settings", lambda: als.sweep_als(s.train_warm.select("user_id", "item_id", "interactions"),
                                                         s.labels("val_warm"), small, s.p.k, base=s.p.als).count())
    if os.environ.get("BENCH_SKIP_REFERENCE_ALS"):
        return _emit(times, sf_dir, spark)
    # The reference's ALS configuration (rank 200, reg 0.5, alpha 1, 15 iterations):
    ref = dict(als.REFERENCE_ALS, user_blocks=int(cpus), item_blocks=int(cpus), seed=42)
    step("als_fit_reference_config", lambda: als.fit_als(s.train_warm, **ref).rank)
    _emit(times, sf_dir, spark)


def _emit(times: dict, sf_dir: str, spark) -> None:
    from encore.sources.tables import release_all
    sf = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({"metric": "evaluation_total", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": float(sf.group(1)) if sf else sf_dir}))
    release_all(spark)
    spark.stop()


if __name__ == "__main__":
    main()

"""Plan-shape checks: the properties the operators rely on at scale."""

import re

from encore.operators import als, popularity, prep, ranking, split
from encore.plans import binding
from encore.plans.catalog import QUERIES, study

SF = "/root/testdata/sf0.001"


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _ix(spark):
    return prep.count_interactions(binding.plays(spark, SF), weight="quantity")


def test_no_cartesian_or_nested_loop_join(spark):
    """MLlib's product of factor blocks is only made to be compared with, and written."""
    for key, q in QUERIES.items():
        if key.startswith(("als_sweep", "als_grid")):
            continue
        plan = _plan(q(spark, SF))
        assert "CartesianProduct" not in plan, key
        for line in plan.splitlines():  # per-value edge tables (two rows a partition) may be looked up in a loop
            assert "BroadcastNestedLoopJoin" not in line, key


def test_one_product_for_a_model(spark):
    s = study(spark, SF)
    users = s.labels("test_warm").select("user_id").distinct()
    assert _plan(als.recommend_als(s.als_model, 10, users)).count("CartesianProduct") == 1
    recs, _ = als.score_als(s.als_model, s.labels("test_warm"), 10)
    assert "CartesianProduct" not in _plan(recs)
    known = {r[0] for r in als.known_users(s.als_model).collect()}
    wanted = {r[0] for r in users.collect()}
    assert {r["user_id"] for r in recs.select("user_id").distinct().collect()} == known & wanted  # test users only


def test_per_user_top_k_is_a_window_group_limit(spark):
    ix = _ix(spark)
    assert "WindowGroupLimit" in _plan(ranking.true_top_k(ix, 10))
    plan = _plan(popularity.top_k_per_beta(ix, [1.0, 10.0], 10))
    assert plan.count("WindowGroupLimit") >= 2  # partial (before the shuffle) and final


def test_split_shuffles_rows_once_after_the_range_sort(spark):
    plan = _plan(split.label_split(_ix(spark), 0.8, 42))
    assert "md5" not in plan  # hashed once, before the checkpoint
    rows = [x for x in re.findall(r"Exchange hashpartitioning\((_ord_pid[^)]*)\)", plan) if "user_id" in x]
    assert 1 <= len(rows) <= 2  # the rows' windows, and the counts of (partition, user) behind their partial aggregate
    assert "SortMergeJoin" not in plan and "ShuffledHashJoin" not in plan


def test_restrictions_join_distinct_users(spark):
    a, b = (spark.range(9).selectExpr("id as user_id", "id as item_id", "id as interactions").checkpoint() for _ in range(2))
    for df in (split.warm_test(a, b), split.cold_test(a, b), split.missing_users(b, a)):
        joins = _plan(df)
        right = joins[joins.index("Join"):]
        assert "HashAggregate(keys=[user_id" in right and "LeftSemi" in joins or "LeftAnti" in joins


def test_no_shuffle_on_a_histogram_value(spark):
    ix = _ix(spark).checkpoint()
    scores = popularity.popularity(ix, 10)
    from encore.operators import metrics
    for df, column in ((prep.items_by_percent_rank(ix), "listeners"), (split.user_percent_rank(ix), "total_interactions"),
                       (metrics.auc_global_scores(ix, scores), "score")):
        assert not re.search(rf"hashpartitioning\({column}#\d+L?,", _plan(df)), column


def test_date_filter_reaches_the_scan(spark):
    plan = _plan(binding.plays(spark, SF, end=binding.TEST_CUT))
    assert "PushedFilters: [IsNotNull(o_orderdate), LessThan(o_orderdate" in plan


def test_filter_on_the_stored_type_reaches_the_scan(spark):
    from pyspark.sql import functions as F

    from encore.sources.tables import read_table
    df = read_table(spark, f"{SF}/lineitem.parquet", "l_partkey INT", where=F.col("l_partkey") == 5)
    assert "EqualTo(l_partkey,5)" in _plan(df)


def test_many_plays_are_counted_in_tasks_of_bounded_rows(spark):
    """AQE's 64 MB a task are two gigabytes of catalogue names: beyond a core's share the number of tasks follows the rows."""
    from encore.plans import catalog
    plays = spark.range(10).selectExpr("id % 3 as user_id", "'x' as recording_mbid")
    many = catalog._in_tasks(plays, 10**7)
    assert "REPARTITION_BY_NUM" in _plan(many) and many.rdd.getNumPartitions() == 10**7 // catalog.PLAYS_TASK + 1
    assert "Exchange" not in _plan(catalog._in_tasks(plays, 10**5))

from pyspark.sql import functions as F

from encore.operators import prep


def _ix(spark, rows):
    return spark.createDataFrame(rows, "user_id long, item_id string, interactions long")


def test_user_without_plays_keeps_null_item(spark):
    users = spark.createDataFrame([(1,), (77,)], "user_id long")
    plays = spark.createDataFrame([(1, "a"), (1, None)], "user_id long, item_id string")
    got = sorted(prep.count_interactions(prep.attach_users(users, plays)).collect(),
                 key=lambda r: (r[0], r[1] or ""))
    assert [tuple(r) for r in got] == [(1, None, 1), (1, "a", 1), (77, None, 1)]


def test_null_item_never_ranked(spark):
    rows = [(1, "a", 1), (2, "a", 1), (1, None, 1), (2, None, 1), (3, None, 1), (3, "b", 1)]
    # 2 non-NULL items, fraction 0.5 -> 1 item: 'a' (2 listeners), the NULL group is ignored.
    got = [r["item_id"] for r in prep.popular_items(_ix(spark, rows), 0.5).collect()]
    assert got == ["a"]


def test_top_fraction_ties_by_item_id(spark):
    # 10 items, all with 1 listener except 'i9' with 2: fraction 0.3 -> i9, then i0, i1.
    rows = [(1, f"i{i}", 1) for i in range(10)] + [(2, "i9", 1)]
    got = sorted(r["item_id"] for r in prep.popular_items(_ix(spark, rows), 0.3).collect())
    assert got == ["i0", "i1", "i9"]


def test_top_fraction_large_tie_group(spark):
    rows = [(u, f"i{i:03d}", 1) for i in range(200) for u in range(1 + (i % 3 == 0))]
    ix = _ix(spark, rows)
    got = {r["item_id"] for r in prep.popular_items(ix, 0.5).collect()}
    listeners = {f"i{i:03d}": 1 + (i % 3 == 0) for i in range(200)}
    expected = set(sorted(listeners, key=lambda k: (-listeners[k], k))[:100])
    assert got == expected


def test_active_and_low_activity_partition_users(spark):
    rows = [(u, f"i{i}", 1) for u in range(5) for i in range(u * 5)]
    ix = _ix(spark, rows)
    active = {r[0] for r in prep.active_users(ix, 10).collect()}
    low = {r[0] for r in prep.low_activity_users(ix, 10).collect()}
    assert active == {2, 3, 4} and low == {1}


def test_percent_rank_and_percentile_variants(spark):
    rows = [(u, f"i{i}", 1) for i in range(10) for u in range(i + 1)]
    ix = _ix(spark, rows)
    pr = {r["item_id"]: r["percent_rank"] for r in prep.items_by_percent_rank(ix, 0.15).collect()}
    assert pr == {"i9": 0.0, "i8": 1 / 9}
    p = prep.listener_percentile(ix, 0.85).first()[0]
    assert abs(p - 8.65) < 1e-12
    assert {r["item_id"] for r in prep.items_by_percentile(ix, 0.85).collect()} == {"i9", "i8"}


def test_histograms_sum_to_totals(spark):
    rows = [(u, f"i{i}", 1) for i in range(60) for u in range(i % 7 + 1)]
    ix = _ix(spark, rows)
    assert prep.listener_histogram(ix).agg(F.sum("track_counts")).first()[0] == 60
    assert prep.activity_histogram(ix).agg(F.sum("user_counts")).first()[0] == 7


def test_fractional_weights_are_kept(spark):
    plays = spark.createDataFrame([(1, "a", 0.9), (1, "a", 0.9), (2, "a", 0.5)], "user_id long, item_id string, w double")
    ix = prep.positive_only(prep.count_interactions(plays, weight="w"))
    assert {r["user_id"]: r["interactions"] for r in ix.collect()} == {1: 1.8, 2: 0.5}


def test_histogram_edges_are_arguments(spark):
    rows = [(u, f"i{i}", 1) for i in range(4) for u in range(3 * i + 1)]
    got = {r[0]: r[1] for r in prep.listener_histogram(_ix(spark, rows), [5], ["few", "many"]).collect()}
    assert got == {"few": 2, "many": 2}


def test_percent_rank_keeps_the_most_heard(spark):
    rows = [(u, f"i{i}", 1) for i in range(20) for u in range(1 + i // 5)]
    got = {r["item_id"]: r["percent_rank"] for r in prep.items_by_percent_rank(_ix(spark, rows), 0.3).collect()}
    assert got == {**{f"i{i}": 0.0 for i in range(15, 20)}, **{f"i{i}": 5 / 19 for i in range(10, 15)}}

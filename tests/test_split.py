import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from encore.functions.columns import hash_order_key
from encore.operators import split


def _ix(spark, sizes, seed=3):
    rnd = random.Random(seed)
    rows = [(u, i, rnd.randint(1, 9)) for u, n in sizes.items() for i in range(n)]
    return spark.createDataFrame(rows, "user_id long, item_id long, interactions long")


def test_split_invariants(spark):
    ix = _ix(spark, {1: 1, 2: 5, 3: 6, 4: 9, 5: 10, 6: 37})
    train, val = split.train_val_split(ix, 0.8, seed=42)
    t = {(r[0], r[1]) for r in train.collect()}
    v = {(r[0], r[1]) for r in val.collect()}
    assert not (t & v)
    assert t | v == {(r[0], r[1]) for r in ix.collect()}
    per_user = {}
    for u, _ in t:
        per_user[u] = per_user.get(u, 0) + 1
    assert per_user == {2: 4, 3: 4, 4: 7, 5: 8, 6: 29}


def _plain(ix):
    w = Window.partitionBy("user_id").orderBy("h", "item_id")
    rows = (ix.withColumn("h", hash_order_key(42, "user_id", "item_id")).withColumn("rn", F.row_number().over(w))
              .withColumn("n", F.count(F.lit(1)).over(Window.partitionBy("user_id"))))
    return {(r["user_id"], r["item_id"]): (r["rn"], r["n"]) for r in rows.collect()}


def test_split_equals_a_plain_window(spark):
    ix = _ix(spark, {1: 300, 2: 40, 3: 7})
    for partitions in (1, 3, 16):
        got = {(r["user_id"], r["item_id"]): (r["rn"], r["n"]) for r in split.label_split(ix, 0.8, 42, partitions=partitions).collect()}
        assert got == _plain(ix)


def test_rows_of_a_null_user_are_split_as_one_user(spark):
    ix = _ix(spark, {1: 30, 2: 4}).withColumn("user_id", F.expr("if(user_id = 1, null, user_id)"))
    rows = split.label_split(ix, 0.8, 42, partitions=5).collect()
    assert sorted(r["rn"] for r in rows if r["user_id"] is None) == list(range(1, 31)) and {r["n"] for r in rows} == {30, 4}


def test_a_user_with_a_third_of_the_rows_is_spread(spark):
    ix = spark.range(0, 12000).select(F.when(F.col("id") < 4000, 0).otherwise(F.col("id") % 500).cast("long").alias("user_id"),
                                      F.col("id").alias("item_id"), F.lit(1).alias("interactions"))
    parts = 4
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        out = split.label_split(ix, 0.8, 42, partitions=split.PIECES * parts)
        assert "Exchange rangepartitioning" not in out._jdf.queryExecution().executedPlan().toString()  # behind the checkpoint
        tasks = [r["n"] for r in out.groupBy(F.spark_partition_id()).agg(F.count(F.lit(1)).alias("n")).collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    assert sum(tasks) == 12000 and max(tasks) <= 2 * 12000 / parts


def test_split_is_seeded_and_order_free(spark):
    ix = _ix(spark, {1: 50, 2: 20})
    a = sorted(split.train_val_split(ix, 0.8, seed=42)[0].collect())
    b = sorted(split.train_val_split(ix.repartition(5), 0.8, seed=42)[0].collect())
    c = sorted(split.train_val_split(ix, 0.8, seed=7)[0].collect())
    assert a == b and a != c


def test_percent_rank_ties_share_lowest(spark):
    ix = spark.createDataFrame([(1, 1, 1), (2, 1, 1), (3, 1, 5), (4, 1, 9)],
                               "user_id long, item_id long, interactions long")
    got = {r["user_id"]: r["percent_rank"] for r in split.user_percent_rank(ix).collect()}
    assert got == {1: 0.0, 2: 0.0, 3: 2 / 3, 4: 1.0}


def test_percent_rank_single_user(spark):
    ix = spark.createDataFrame([(1, 1, 1)], "user_id long, item_id long, interactions long")
    assert split.user_percent_rank(ix).first()["percent_rank"] == 0.0


def test_cold_warm_partition_users(spark):
    ix = _ix(spark, {u: u + 1 for u in range(1, 21)})
    cold = {r[0] for r in split.cold_start_users(ix, 0.1).collect()}
    warm = {r[0] for r in split.warm_users(ix, 0.1).collect()}
    assert cold.isdisjoint(warm) and len(cold | warm) == 20 and cold


def test_coverage_and_test_restrictions(spark):
    train = spark.createDataFrame([(1, 1, 1)], "user_id long, item_id long, interactions long")
    val = spark.createDataFrame([(1, 2, 1), (2, 2, 1)], "user_id long, item_id long, interactions long")
    assert [r[0] for r in split.missing_users(train, val).collect()] == [2]
    assert [r[0] for r in split.warm_test(val, train).collect()] == [1]
    assert [r[0] for r in split.cold_test(val, train).collect()] == [2]
    assert split.split_sizes(val).where(F.col("user_id") == 2).first()["row_counts"] == 0


def test_split_pieces_grow_with_rows_not_with_files(spark):
    """Every piece writes a file a shuffle partition, twice: 3.1 million rows do not need 308 pieces."""
    assert split._pieces(3_080_530, 800, 8) == 13
    assert split._pieces(110_000_000, 800, 12) == 441 and split._pieces(10**9, 800, 12) == 800
    assert split._pieces(100_000, 800, 12) == 11 and split._pieces(0, 800, 12) == 1  # cores are kept busy, small tables in one


def test_split_checkpoints_no_hash(spark, monkeypatch):
    """The hash orders the rows; it is 16 bytes wide on the way and is not written with them."""
    import hashlib
    ix = spark.createDataFrame([(u, i, 1) for u in range(9) for i in range(20)] + [(None, 3, 1), (2, None, 1)], "user_id long, item_id long, interactions long")
    kept, frame = [], type(ix)
    checkpoint = frame.checkpoint
    monkeypatch.setattr(frame, "checkpoint", lambda df, *a, **b: kept.append(df) or checkpoint(df, *a, **b))
    rows = split.label_split(ix, 0.8, 42, partitions=3).collect()
    key = lambda u, i: hashlib.md5("|".join(["42", *[str(x) for x in (u, i) if x is not None]]).encode()).hexdigest()
    for user in {r["user_id"] for r in rows}:
        own = sorted((r for r in rows if r["user_id"] == user), key=lambda r: r["rn"])
        assert [r["rn"] for r in own] == list(range(1, len(own) + 1))
        assert [r["item_id"] for r in own] == [i for _, i in sorted((key(user, r["item_id"]), r["item_id"]) for r in own)]
    assert kept and all(df.columns == ix.columns for df in kept)

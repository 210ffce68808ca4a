import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from encore.functions.ordering import exclusive_prefix_sum, global_row_number, histogram_ranks, value_positions


def _frame(spark, n=500, seed=7):
    rnd = random.Random(seed)
    rows = [(i, rnd.randint(0, 20)) for i in range(n)]
    return spark.createDataFrame(rows, "id long, v long"), rows


def test_global_row_number_matches_sort(spark):
    df, rows = _frame(spark)
    got = global_row_number(df, [F.col("v").desc(), F.col("id").asc()], "rn", partitions=5)
    expected = sorted(rows, key=lambda r: (-r[1], r[0]))
    ranks = {r["id"]: r["rn"] for r in got.collect()}
    assert [ranks[i] for i, _ in expected] == list(range(1, len(rows) + 1))


def test_global_row_number_ignores_input_partitioning(spark):
    df, _ = _frame(spark)
    a = {r["id"]: r["rn"] for r in global_row_number(df, [F.col("v"), F.col("id")], "rn").collect()}
    b = {r["id"]: r["rn"] for r in global_row_number(df.repartition(7), [F.col("v"), F.col("id")], "rn").collect()}
    assert a == b


def test_exclusive_prefix_sum(spark):
    df = spark.createDataFrame([(i, i * 2) for i in range(1, 30)], "k long, w long")
    got = {r["k"]: r["before"] for r in exclusive_prefix_sum(df, [F.col("k")], "w", "before", 4).collect()}
    assert got == {k: sum(2 * j for j in range(1, k)) for k in range(1, 30)}


def test_histogram_ranks_descending(spark):
    df = spark.createDataFrame([(v,) for v in (3, 3, 1, 2, 3, 2)], "v long")
    got = {r["v"]: (r["cnt"], r["before"]) for r in histogram_ranks(df, "v", descending=True).collect()}
    assert got == {3: (3, 0), 2: (2, 3), 1: (1, 5)}


def test_value_positions_match_a_window(spark):
    """Ties over several partitions, a hot value, and NULL as the lowest."""
    rows = [(i, None if i % 11 == 0 else (7 if i % 3 else i % 5)) for i in range(300)]
    df = spark.createDataFrame(rows, "id long, v int")
    for descending in (False, True):
        order = F.col("v").desc_nulls_last() if descending else F.col("v").asc_nulls_first()
        want = {r["id"]: (r["b"], r["t"]) for r in df.select(
            "id", (F.rank().over(Window.orderBy(order)) - 1).alias("b"), F.count(F.lit(1)).over(Window.partitionBy("v")).alias("t")).collect()}
        for partitions in (1, 4, 13):
            got = value_positions(df, "v", ["id"], descending=descending, partitions=partitions)
            assert {r["id"]: (r["before"], r["ties"]) for r in got.collect()} == want
    assert value_positions(df.limit(0), "v", ["id"]).count() == 0

from fractions import Fraction

from pyspark.sql import functions as F

from encore.functions.columns import (LISTENER_EDGES, LISTENER_LABELS, bucketize, exact_fraction,
                                      floor_fraction, impute_item_id, smoothed_mean)


def test_exact_fraction_reads_decimal():
    assert exact_fraction(0.8) == Fraction(4, 5)
    assert exact_fraction(0.03) == Fraction(3, 100)


def test_floor_fraction_split_sizes(spark):
    df = spark.createDataFrame([(n,) for n in (1, 5, 6, 9, 10)], "n long")
    got = [r[0] for r in df.select(floor_fraction("n", 0.8)).orderBy(F.col("n")).collect()]
    assert sorted(got) == [0, 4, 4, 7, 8]


def test_impute_item_id(spark):
    df = spark.createDataFrame([(None, "x"), ("m", "y")], "mbid string, msid string")
    got = sorted(r[0] for r in impute_item_id(df, "mbid", "msid").select("mbid").collect())
    assert got == ["m", "x"]


def test_bucketize_edges(spark):
    df = spark.createDataFrame([(v,) for v in (0, 4, 5, 49, 50, 499, 500, 10_000)], "v long")
    got = [r[0] for r in df.select(bucketize("v", LISTENER_EDGES, LISTENER_LABELS)).collect()]
    assert got == ["[0, 5)", "[0, 5)", "[5, 10)", "[40, 50)", "[50, 100)", "[200, 500)", ">=500", ">=500"]


def test_smoothed_mean(spark):
    df = spark.createDataFrame([(30, 2)], "t long, n long")
    assert df.select(smoothed_mean("t", "n", 8)).first()[0] == 3.0


def test_cluster_conf_sizes_partitions():
    from encore.session import cluster_conf
    conf = cluster_conf(100 * 2**40, executors=1000, cores_per_executor=8)
    assert int(conf["spark.sql.shuffle.partitions"]) == 100 * 2**40 // (256 << 20) + 1
    small = cluster_conf(2**30, executors=10, cores_per_executor=4)
    assert int(small["spark.sql.shuffle.partitions"]) == 80

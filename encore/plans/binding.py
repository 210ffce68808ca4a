"""Binding of the driver's TPC-H-like tables to the recommender's inputs.

* plays: ``orders JOIN lineitem`` on the order key; user = o_custkey,
  item = l_partkey, strength = l_quantity, time = o_orderdate.
* history / test: plays before / from ``TEST_CUT``.
* a second source: ``events`` (user_id, item = the ``k`` field of ``props``).
* users: ``customer``; item catalogue ("tracks"): ``part``, with a raw id
  (the part key as text) and a nullable canonical id (name / brand, missing
  for SMALL parts) that falls back to the raw id.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from encore.functions.columns import exact_long
from encore.operators.prep import count_interactions
from encore.sources.tables import read_table

TEST_CUT = "2001-01-01"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_table(spark, f"{sf_dir}/{name}.parquet")


def _ts(value: str):
    return F.lit(value).cast("timestamp_ntz")


def plays(spark: SparkSession, sf_dir: str, start: str | None = None, end: str | None = None) -> DataFrame:
    """(user_id, item_id, quantity) for orders dated in [start, end)."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    if start:
        orders = orders.where(F.col("o_orderdate") >= _ts(start))
    if end:
        orders = orders.where(F.col("o_orderdate") < _ts(end))
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    return (orders.join(lines, orders.o_orderkey == lines.l_orderkey)
                  .select(F.col("o_custkey").alias("user_id"), F.col("l_partkey").alias("item_id"),
                          exact_long("l_quantity").alias("quantity")))


def interactions_by_period(spark: SparkSession, sf_dir: str, cut: str = TEST_CUT) -> DataFrame:
    """(user_id, item_id, interactions, period): history and test from ONE join.

    ``period`` is 'history' before the cut and 'test' from it; lineitem (the
    largest table) is scanned and shuffled once for both sets.
    """
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    period = F.when(F.col("o_orderdate") < _ts(cut), F.lit("history")).otherwise(F.lit("test"))
    joined = (orders.where(F.col("o_orderdate").isNotNull())
                    .join(lines, orders.o_orderkey == lines.l_orderkey)
                    .select(F.col("o_custkey").alias("user_id"), F.col("l_partkey").alias("item_id"),
                            exact_long("l_quantity").alias("quantity"), period.alias("period")))
    return (joined.groupBy("user_id", "item_id", "period")
                  .agg(F.sum("quantity").alias("interactions")))


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("user_id"))


def tracks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(recording_msid, recording_mbid nullable, __index_level_0__) from ``part``."""
    part = table(spark, sf_dir, "part")
    return part.select(
        F.col("p_partkey").cast("string").alias("recording_msid"),
        F.when(F.col("p_type") == F.lit("SMALL"), F.lit(None).cast("string"))
         .otherwise(F.concat_ws(" / ", "p_name", "p_brand")).alias("recording_mbid"),
        F.col("p_partkey").alias("__index_level_0__"))


def event_interactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Second interaction source: ``events`` rows as plays of item ``props.k``."""
    return count_interactions(event_plays(spark, sf_dir))


def event_plays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(user_id, item_id): one row per event; most customers have none."""
    return table(spark, sf_dir, "events").select(
        "user_id", F.get_json_object("props", "$.k").cast("long").alias("item_id"))


def raw_plays(spark: SparkSession, sf_dir: str, end: str | None = None) -> DataFrame:
    """(user_id, recording_msid): one row per play, the raw-id form."""
    return plays(spark, sf_dir, end=end).select("user_id",
                                                 F.col("item_id").cast("string").alias("recording_msid"))

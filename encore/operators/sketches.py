"""Mergeable sketches: distinct listeners by HyperLogLog, quantiles of listener counts by KLL.

States are columns of a table: kept by group (a period, a day's plays), they are
merged for any union of groups without reading the plays again. All are Spark's
own aggregates (DataSketches), with partial aggregation in the tasks.

Bounds. An HLL state of ``lg_k`` has a relative standard error of about
1.04 / sqrt(2^lg_k); small counts are kept exactly. A KLL state of ``k`` has a
normalised rank error of about 2.3 / k^0.9 at 99 % confidence; fewer than k values
are kept exactly.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

U, I = "user_id", "item_id"
LG_K = 12
KLL_K = 800


def hll_error(lg_k: int = LG_K) -> float:
    """Relative standard error of a count."""
    return 1.04 / 2 ** (lg_k / 2)


def kll_error(k: int = KLL_K) -> float:
    """Normalised rank error that 99 % of quantiles keep."""
    return 2.296 / k ** 0.9021


def listener_states(plays: DataFrame, by: list[str] | None = None, lg_k: int = LG_K, group: str = I, counted: str = U) -> DataFrame:
    """(group, *by, state): an HLL state of the distinct ``counted`` of every group; rows without a group go."""
    return plays.where(F.col(group).isNotNull()).groupBy(group, *(by or [])).agg(F.hll_sketch_agg(counted, lg_k).alias("state"))


def merge_states(states: DataFrame, group: str = I) -> DataFrame:
    """(group, state) over all rows of the group; states of different ``lg_k`` may meet."""
    return states.groupBy(group).agg(F.hll_union_agg("state", True).alias("state"))


def estimates(states: DataFrame, out: str = "listeners", group: str = I) -> DataFrame:
    """(group, out): the estimated distinct count, a long."""
    return states.select(group, F.hll_sketch_estimate("state").alias(out))


def quantile_state(values: DataFrame, column: str, by: list[str] | None = None, k: int = KLL_K) -> DataFrame:
    """(*by, state): a KLL state of a column of longs, by group or over all; nulls are left out."""
    rows = values.where(F.col(column).isNotNull()).select(*(by or []), F.col(column).cast("long").alias(column))
    agg = F.kll_sketch_agg_bigint(column, k).alias("state")
    return rows.groupBy(*by).agg(agg) if by else rows.agg(agg)


def merge_quantiles(states: DataFrame, k: int = KLL_K) -> DataFrame:
    """(state): one state over all rows' states."""
    return states.agg(F.kll_merge_agg_bigint("state", k).alias("state"))


def quantiles(state: DataFrame, qs: list[float]) -> DataFrame:
    """(q, value): the smallest kept value whose rank is at least q, from one state."""
    values = [F.struct(F.lit(q).alias("q"), F.kll_sketch_get_quantile_bigint("state", F.lit(q)).alias("value")) for q in qs]
    return state.select(F.explode(F.array(*values)).alias("r")).select("r.q", "r.value")


def rank_errors(values: DataFrame, column: str, found: DataFrame, qs: list[float]) -> DataFrame:
    """(q, value, error): how far q lies outside the ranks that ``value`` has among the values (0 inside).

    One pass over the values: the few quantiles are broadcast as one row.
    """
    at = found.groupBy().agg(F.map_from_entries(F.collect_list(F.struct("q", "value"))).alias("m")).scalar()  # a row a quantile
    v = F.col(column)
    counts = [F.struct(F.lit(q).alias("q"), F.max(F.col("m")[q]).alias("value"), F.avg((v < F.col("m")[q]).cast("int")).alias("below"),
                       F.avg((v <= F.col("m")[q]).cast("int")).alias("upto")) for q in qs]
    rows = values.where(v.isNotNull()).withColumn("m", at).agg(F.array(*counts).alias("r")).select(F.explode("r").alias("r")).select("r.*")
    outside = F.greatest(F.col("below") - F.col("q"), F.col("q") - F.col("upto"), F.lit(0.0))
    return rows.select("q", "value", outside.alias("error"))


def union_states(parts: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), parts)

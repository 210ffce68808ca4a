"""Distributed global orderings: prefix sums, row numbers and value ranks.

A window without PARTITION BY moves every row into one task. The helpers here
give the same numbers with the work spread over ``partitions`` tasks:

1. range-partition the rows on the full sort order and sort each partition;
2. checkpoint the result to the reliable checkpoint directory, which fixes
   which row sits in which partition and in what position (the range bounds
   come from a sample; recomputing them could move rows between partitions);
3. number or sum inside each partition, and add the total of all earlier
   partitions (a table with one row per partition, broadcast by construction).

Callers must pass a *total* order (append a unique tie-breaker), otherwise the
position of tied rows is arbitrary.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from encore.session import ensure_checkpoint_dir

_PID = "_ord_pid"
_POS = "_ord_pos"


def range_sorted_checkpoint(df: DataFrame, order: list[Column],
                            partitions: int | None = None, drop: list[str] | None = None) -> DataFrame:
    """Range-partition on ``order``, sort each partition, checkpoint reliably, without the columns to ``drop``.

    Without an explicit ``partitions`` the range shuffle uses the session's
    shuffle partitions and AQE may merge adjacent (small) ranges, which keeps
    them contiguous and ordered.
    """
    ensure_checkpoint_dir(df.sparkSession)
    ranged = df.repartitionByRange(int(partitions), *order) if partitions else df.repartitionByRange(*order)
    return ranged.sortWithinPartitions(*order).drop(*drop or []).checkpoint(eager=True)


def _tag(cp: DataFrame) -> DataFrame:
    # Directly above the checkpointed scan, so partition index and position are
    # those of the range-sorted partitions.
    return (cp.withColumn(_PID, F.spark_partition_id())
              .withColumn(_POS, F.monotonically_increasing_id() - F.shiftleft(F.col(_PID).cast("long"), 33)))


def _partition_offsets(tagged: DataFrame, weight: Column) -> DataFrame:
    """Exclusive running total of ``weight`` over partitions (one row each), and the total of all."""
    totals = tagged.groupBy(_PID).agg(F.sum(weight).alias("_ord_pt"))
    # One row per range partition: bounded by the partition count, not the data.
    before = Window.orderBy(_PID).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy()
    return totals.select(_PID, F.coalesce(F.sum("_ord_pt").over(before), F.lit(0)).cast("long").alias("_ord_off"),
                         F.sum("_ord_pt").over(whole).cast("long").alias("_ord_all"))


def global_row_number(df: DataFrame, order: list[Column], out: str = "row_number",
                      partitions: int | None = None) -> DataFrame:
    """Add a 1-based ``out`` = position of the row in the total ``order``."""
    tagged = _tag(range_sorted_checkpoint(df, order, partitions))
    offsets = _partition_offsets(tagged, F.lit(1))
    return (tagged.join(F.broadcast(offsets), _PID)
                  .withColumn(out, (F.col("_ord_off") + F.col(_POS) + 1).cast("long"))
                  .drop(_PID, _POS, "_ord_off", "_ord_all"))


def exclusive_prefix_sum(df: DataFrame, order: list[Column], weight: str, out: str,
                         partitions: int | None = None) -> DataFrame:
    """Add ``out`` = sum of ``weight`` over all rows strictly before this row."""
    tagged = _tag(range_sorted_checkpoint(df, order, partitions))
    offsets = _partition_offsets(tagged, F.col(weight))
    # Each window group is one range partition of the (already aggregated) input.
    within = Window.partitionBy(_PID).orderBy(_POS).rowsBetween(Window.unboundedPreceding, -1)
    local = tagged.withColumn("_ord_lp", F.coalesce(F.sum(weight).over(within), F.lit(0)))
    return (local.join(F.broadcast(offsets), _PID)
                 .withColumn(out, (F.col("_ord_off") + F.col("_ord_lp")).cast("long"))
                 .drop(_PID, _POS, "_ord_off", "_ord_all", "_ord_lp"))


def value_positions(df: DataFrame, value_col: str, tie_break: list[str], descending: bool = False,
                    partitions: int | None = None, before: str = "before", ties: str = "ties", total: str = "total") -> DataFrame:
    """Add ``before`` = rows whose value comes strictly earlier, ``ties`` = rows of the same value, ``total`` = all rows.

    NULL is the lowest value. The rows are range-sorted on (value, tie-breaker),
    so a value that most rows share is spread over partitions; a row's numbers
    come from its own partition, except for a value at a partition's edge. Those
    are corrected from a table of two rows per partition, which is broadcast.
    No row is shuffled or joined on the value alone.
    """
    first = F.col(value_col).desc_nulls_last() if descending else F.col(value_col).asc_nulls_first()
    tagged = _tag(range_sorted_checkpoint(df, [first, *[F.col(c).asc() for c in tie_break]], partitions))
    offsets = _partition_offsets(tagged, F.lit(1))
    groups = (tagged.groupBy(_PID, value_col).agg(F.count(F.lit(1)).alias("_ord_n"), F.min(_POS).alias("_ord_at"))
                    .join(F.broadcast(offsets), _PID)
                    .withColumn("_ord_start", F.col("_ord_off") + F.col("_ord_at")))
    edge = F.struct("_ord_at", F.col(value_col).alias("v"), "_ord_n", "_ord_start")
    edges = (groups.groupBy(_PID).agg(F.array_distinct(F.array(F.min(edge), F.max(edge))).alias("_ord_e"))
                   .select(F.explode("_ord_e").alias("e"))
                   .groupBy(F.col("e.v").alias("_ord_v"))
                   .agg(F.min("e._ord_start").alias("_ord_start"), F.sum("e._ord_n").alias("_ord_ties")))
    # One partition's rows of a value, at most; the groups of a partition share its hash only by chance.
    local = tagged.join(F.broadcast(offsets), _PID)
    same = Window.partitionBy(_PID, value_col)
    local = (local.withColumn("_ord_first", F.col("_ord_off") + F.min(_POS).over(same))
                  .withColumn("_ord_count", F.count(F.lit(1)).over(same)))
    joined = local.join(F.broadcast(edges), F.col(value_col).eqNullSafe(F.col("_ord_v")), "left")
    return joined.select(*df.columns,
                         F.coalesce("_ord_start", "_ord_first").cast("long").alias(before),
                         F.coalesce("_ord_ties", "_ord_count").cast("long").alias(ties), F.col("_ord_all").alias(total))


def histogram_ranks(values: DataFrame, value_col: str, descending: bool = False) -> DataFrame:
    """``(value_col, cnt, before)``: rows per value, and rows ordered before the value.

    For counts (listeners of an item, say) the histogram has at most sqrt(2 * rows
    counted) rows, so one window task ranks it.
    """
    hist = values.groupBy(value_col).agg(F.count(F.lit(1)).alias("cnt"))
    order = F.col(value_col).desc() if descending else F.col(value_col).asc()
    before = F.sum("cnt").over(Window.orderBy(order).rowsBetween(Window.unboundedPreceding, -1))
    return hist.withColumn("before", F.coalesce(before, F.lit(0)).cast("long"))

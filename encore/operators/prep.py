"""Preparation: joins, interaction counts, popular items, active users, histograms.

Canonical interactions frame ``ix``: (user_id, item_id, interactions), unique on
(user_id, item_id). Every aggregate here is a hash aggregate with a map-side
partial step, so a hot user or item is combined before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from encore.functions.columns import (ACTIVITY_EDGES, ACTIVITY_LABELS, LISTENER_EDGES,
                                      LISTENER_LABELS, bucketize, exact_fraction)
from encore.functions.ordering import global_row_number, histogram_ranks
from encore.sources.tables import materialize

U, I, N = "user_id", "item_id", "interactions"


# ---------------------------------------------------------------- joins

def attach_items(plays: DataFrame, items: DataFrame, on: str) -> DataFrame:
    """plays LEFT JOIN items: a play without a catalogue row keeps NULL item columns."""
    return plays.join(items, on=on, how="left")


def attach_users(users: DataFrame, plays: DataFrame, on: str = U) -> DataFrame:
    """users LEFT JOIN plays: a user without plays keeps one row with NULL play columns."""
    return users.join(plays, on=on, how="left")


def restrict_items(ix: DataFrame, items: DataFrame, item: str = I) -> DataFrame:
    """Interactions whose item is in ``items`` (semi-join: never duplicates rows)."""
    return ix.join(items.select(item), on=item, how="left_semi")


def restrict_users(ix: DataFrame, users: DataFrame, user: str = U) -> DataFrame:
    """Interactions whose user is in ``users`` (semi-join)."""
    return ix.join(users.select(user), on=user, how="left_semi")


# ---------------------------------------------------------------- aggregates

def count_interactions(plays: DataFrame, user: str = U, item: str = I,
                       weight: str | None = None) -> DataFrame:
    """One row per (user, item): number of plays, or the summed ``weight`` in the weight's own type.

    NULL users / items form their own group, as in SQL GROUP BY; they are
    removed later by the semi-joins and before any ranking.
    """
    strength = F.count(F.lit(1)) if weight is None else F.sum(weight)
    return plays.groupBy(F.col(user).alias(U), F.col(item).alias(I)).agg(strength.alias(N))


def item_listeners(ix: DataFrame, distinct: bool = False, rsd: float | None = None) -> DataFrame:
    """(item_id, listeners): users per non-NULL item.

    ``ix`` is unique on (user, item), so a plain count equals the distinct
    count and avoids the extra distinct-aggregation shuffle; ``distinct=True``
    is for raw plays. With ``rsd`` the count is HyperLogLog++'s of that relative
    standard deviation: one shuffle, whatever the number of plays.
    """
    agg = F.approx_count_distinct(U, rsd) if rsd is not None else F.count_distinct(U) if distinct else F.count(U)
    return ix.where(F.col(I).isNotNull()).groupBy(I).agg(agg.alias("listeners"))


def user_activity(ix: DataFrame, distinct: bool = False, rsd: float | None = None) -> DataFrame:
    """(user_id, tracks): items per non-NULL user; ``distinct`` and ``rsd`` as for ``item_listeners``."""
    agg = F.approx_count_distinct(I, rsd) if rsd is not None else F.count_distinct(I) if distinct else F.count(I)
    return ix.where(F.col(U).isNotNull()).groupBy(U).agg(agg.alias("tracks"))


# ---------------------------------------------------------------- top fraction

def popular_items(ix: DataFrame, fraction: float = 0.03, partitions: int | None = None) -> DataFrame:
    """Top ``floor(fraction * N)`` items by listeners, ties by item id ascending.

    N = number of distinct non-NULL items. Instead of a global sort with one
    reducer, the histogram of listener counts gives the cut-off count c and
    the number A of items strictly above it; items above c are kept by a
    filter and the remaining n - A slots go to the smallest item ids at
    exactly c (a distributed row number over that tie group only).
    Returns (item_id, listeners).
    """
    # One row per item, read three times below (histogram, head, ties).
    listeners = materialize(item_listeners(ix), "listeners")
    q = exact_fraction(fraction)
    # One action returns the histogram row that holds the n-th item, n =
    # floor(fraction * N): its count c and the number of items above it.
    hist = histogram_ranks(listeners, "listeners", descending=True)
    n = F.call_function("div", F.sum("cnt").over(Window.partitionBy()) * F.lit(q.numerator), F.lit(q.denominator))
    cut = (hist.withColumn("n", n).where((F.col("before") < F.col("n")) & (F.col("before") + F.col("cnt") >= F.col("n")))
               .select("listeners", "before", "cnt", "n").first())
    if cut is None:
        return listeners.limit(0)
    c, above, at_c, n = int(cut["listeners"]), int(cut["before"]), int(cut["cnt"]), int(cut["n"])
    head = listeners.where(F.col("listeners") > F.lit(c))
    ties = listeners.where(F.col("listeners") == F.lit(c))
    take = n - above
    if take == at_c:
        return head.unionByName(ties)
    ranked = global_row_number(ties, [F.col(I).asc()], out="_tie_rn", partitions=partitions)
    return head.unionByName(ranked.where(F.col("_tie_rn") <= F.lit(take)).drop("_tie_rn"))


# ---------------------------------------------------------------- activity

def active_users(ix: DataFrame, min_items: int = 10) -> DataFrame:
    """Users with at least ``min_items`` interactions rows (HAVING COUNT(*) >= m)."""
    return (ix.where(F.col(U).isNotNull()).groupBy(U).agg(F.count(F.lit(1)).alias("n_items"))
              .where(F.col("n_items") >= F.lit(min_items)).select(U))


def low_activity_users(ix: DataFrame, max_items: int = 10) -> DataFrame:
    """Users with fewer than ``max_items`` rows: the saved cold-start list."""
    return (ix.where(F.col(U).isNotNull()).groupBy(U).agg(F.count(F.lit(1)).alias("n_items"))
              .where(F.col("n_items") < F.lit(max_items)).select(U))


def prepare_interactions(ix: DataFrame, fraction: float = 0.03, min_items: int = 10,
                         partitions: int | None = None, checkpoint_input: bool = True) -> DataFrame:
    """Popular items only, then users with at least ``min_items`` of them left.

    ``ix`` is read by two passes (item ranking, then the restrictions); with
    ``checkpoint_input`` it is first written as a table in the checkpoint
    folder, so an expensive lineage (joins of raw plays) is computed once.
    """
    if checkpoint_input:
        ix = materialize(ix, "interactions")
    popular = popular_items(ix, fraction, partitions)
    kept = restrict_items(ix.where(F.col(I).isNotNull()), popular)
    return restrict_users(kept, active_users(kept, min_items))


def positive_only(ix: DataFrame) -> DataFrame:
    """Keep rows with a positive interaction strength."""
    return ix.where(F.col(N) > 0)


# ---------------------------------------------------------------- percentile variants

def listener_percentile(ix: DataFrame, q: float = 0.85, accuracy: int | None = None) -> DataFrame:
    """Exact percentile (linear interpolation) of listeners per item, one row.

    The value is rounded to 9 decimals so that integer results are not
    perturbed by the interpolation arithmetic. The exact percentile keeps a
    value -> count map per task and merges the maps in one final task; its
    size is the number of distinct listener counts, at most sqrt(2 * |ix|).
    With ``accuracy`` it is ``percentile_approx``: a listener count whose rank is
    within 1 / accuracy of q, from states of bounded size.
    """
    return _percentile(item_listeners(ix), q, accuracy)


def _percentile(listeners: DataFrame, q: float, accuracy: int | None = None) -> DataFrame:
    if accuracy is not None:
        return listeners.agg(F.percentile_approx("listeners", F.lit(q), F.lit(accuracy)).cast("double").alias("listener_percentile"))
    return listeners.agg(F.round(F.percentile(F.col("listeners"), F.lit(q)), 9).alias("listener_percentile"))


def items_by_percentile(ix: DataFrame, q: float = 0.85, accuracy: int | None = None) -> DataFrame:
    """Items whose listener count is at least the ``q`` percentile (exact, or approximate as above); listeners are aggregated once."""
    listeners = materialize(item_listeners(ix), "listeners")
    threshold = _percentile(listeners, q, accuracy)
    return listeners.where(F.col("listeners") >= threshold.scalar())


def items_by_percent_rank(ix: DataFrame, pct: float = 0.15) -> DataFrame:
    """Items with percent_rank <= pct, ranking by listeners descending.

    percent_rank = (items with more listeners) / (N - 1), 0 when N = 1. The
    listener histogram (at most sqrt(2 * |ix|) rows, ranked in one task) gives
    the lowest count that is kept; only items at or above it are ranked, by a
    broadcast of the kept histogram rows, so the many items with few listeners
    are dropped by a filter and never shuffled on their count.
    """
    listeners = materialize(item_listeners(ix), "listeners")
    hist = histogram_ranks(listeners, "listeners", descending=True)
    n_items = F.sum("cnt").over(Window.partitionBy())
    rank = F.when(n_items <= 1, F.lit(0.0)).otherwise(F.col("before").cast("double") / (n_items - 1).cast("double"))
    kept = hist.withColumn("percent_rank", rank).where(F.col("percent_rank") <= F.lit(float(pct)))
    kept = kept.select("listeners", "percent_rank").checkpoint()
    least = kept.agg(F.min("listeners")).scalar()
    return (listeners.where(F.col("listeners") >= least)
                     .join(F.broadcast(kept), "listeners").select(I, "listeners", "percent_rank"))


# ---------------------------------------------------------------- histograms

def listener_histogram(ix: DataFrame, edges: list | None = None, labels: list[str] | None = None) -> DataFrame:
    """(listeners_counts, track_counts): items per listener-count bin (ten by default), by count."""
    bins = bucketize("listeners", edges or LISTENER_EDGES, labels or LISTENER_LABELS)
    return (item_listeners(ix).groupBy(bins.alias("listeners_counts"))
            .agg(F.count(F.lit(1)).alias("track_counts"))
            .orderBy("track_counts", "listeners_counts"))


def activity_histogram(ix: DataFrame, edges: list | None = None, labels: list[str] | None = None) -> DataFrame:
    """(track_counts, user_counts): users per activity bin (nine by default), by count."""
    bins = bucketize("tracks", edges or ACTIVITY_EDGES, labels or ACTIVITY_LABELS)
    return (user_activity(ix).groupBy(bins.alias("track_counts"))
            .agg(F.count(F.lit(1)).alias("user_counts"))
            .orderBy("user_counts", "track_counts"))

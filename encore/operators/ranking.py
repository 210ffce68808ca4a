"""Ranked lists: per-user ground truth, list arrays, pairing, seen-item removal.

A recommendation list is kept in relational form, one row per
(user_id, item_id, rank); array forms are built only on request.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

U, I, N = "user_id", "item_id", "interactions"


def true_top_k(ix: DataFrame, k: int = 100) -> DataFrame:
    """(user_id, item_id, interactions, rank): each user's k strongest items,
    ties by item id. ``row_number() <= k`` is planned as a window group limit,
    so every map task keeps at most k rows per user before the shuffle."""
    w = Window.partitionBy(U).orderBy(F.col(N).desc(), F.col(I).asc())
    return (ix.withColumn("rank", F.row_number().over(w).cast("long"))
              .where(F.col("rank") <= F.lit(k)))


def ranked_array(ranked: DataFrame, out: str, group: list[str] | None = None,
                 as_double: bool = False) -> DataFrame:
    """Items of a ranked frame as an array in rank order (per ``group``, or one row).

    ``collect_list`` alone has no order guarantee: collect (rank, item) structs
    and sort them. Each list is bounded by its k.
    """
    arr = F.transform(F.sort_array(F.collect_list(F.struct("rank", I))), lambda s: s[I])
    if as_double:
        arr = arr.cast("array<double>")
    if group:
        return ranked.groupBy(*group).agg(arr.alias(out))
    return ranked.agg(arr.alias(out))


def true_arrays(labels: DataFrame, as_double: bool = False) -> DataFrame:
    """(user_id, true_labels) from ranked ground truth."""
    return ranked_array(labels, "true_labels", [U], as_double)


def rec_items(recs: DataFrame, field: str = "item_id", out: str = "predicted_labels") -> DataFrame:
    """Model output array<struct<item, rating>> -> array<double> of items."""
    return recs.withColumn(out, F.col(f"recommendations.{field}").cast("array<double>"))


def explode_recs(recs: DataFrame, field: str = "item_id", user: str = U) -> DataFrame:
    """array<struct<item, rating>> per user -> one row per (user_id, item_id, rank, score)."""
    return (recs.select(F.col(user).alias(U), F.posexplode("recommendations").alias("_p", "_r"))
                .select(U, F.col(f"_r.{field}").cast("long").alias(I),
                        (F.col("_p") + 1).cast("long").alias("rank"),
                        F.col("_r.rating").cast("double").alias("score")))


def pair_labels(truth: DataFrame, predicted: DataFrame, how: str = "inner") -> DataFrame:
    """Ground-truth arrays joined to predicted arrays by user.

    ``inner`` drops users the model cannot score (the reference's choice);
    ``left`` keeps them with a NULL prediction.
    """
    return truth.join(predicted, U, how)


def exclude_seen(recs: DataFrame, seen: DataFrame) -> DataFrame:
    """Drop recommendations the user already interacted with and re-rank 1..m."""
    kept = recs.join(seen.select(U, I), [U, I], "left_anti")
    w = Window.partitionBy(U).orderBy(F.col("rank").asc(), F.col(I).asc())
    return kept.withColumn("rank", F.row_number().over(w).cast("long"))

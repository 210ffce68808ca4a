"""Ranking metrics as joins and per-user aggregates.

``labels``: (user_id, item_id), the relevant items of each user (unique).
``recs``: (user_id, item_id, rank) per user, or a global list (item_id, rank)
shared by all users (the popularity model). Only the hits -- labels joined to
recommendations on (user, item) -- carry a rank; per-user state is bounded
by k. Definitions follow Spark's RankingMetrics:

* AP@k   = sum over hits at position p <= k of (hits up to p) / p, / min(k, |labels|)
* P@k    = hits in the first k / k
* R@k    = hits in the first k / |labels|
* NDCG@k = sum over hits of 1/log2(p+1), / sum_{i <= min(k, |labels|)} 1/log2(i+1)
* RR     = 1 / position of the first hit (0 without a hit)

Users: those with labels and a prediction (``how='inner'``, the reference's
join), every labelled user with missing predictions scored 0 (``'left'``),
or every user with a prediction, users without labels scoring 0 (``'pred'``,
as an evaluator row with an empty label list).
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from encore.functions.ordering import value_positions

U, I = "user_id", "item_id"


def _ideal_dcg(k: int):
    """Literal array: ideal DCG for 1..k relevant items (k is a parameter)."""
    vals, acc = [], 0.0
    for i in range(1, k + 1):
        acc += 1.0 / math.log2(i + 1)
        vals.append(F.lit(acc))
    return F.array(*vals)


def _with_rank(labels: DataFrame, recs: DataFrame, k: int) -> DataFrame:
    """Label rows with the rank of the item in the user's list (NULL if absent)."""
    top = recs.where(F.col("rank") <= F.lit(k))
    if U in recs.columns:
        return labels.select(U, I).join(top.select(U, I, "rank"), [U, I], "left")
    # A global list has at most k rows here: broadcast by construction.
    return labels.select(U, I).join(F.broadcast(top.select(I, "rank")), I, "left")


def per_user_metrics(labels: DataFrame, recs: DataFrame, k: int = 100,
                     pred_users: DataFrame | None = None, how: str = "inner") -> DataFrame:
    """(user_id, n_labels, hits, ap, precision, recall, ndcg, rr) per evaluated user.

    One aggregate per user over its label rows: the label count and the
    sorted ranks of the hits. A user has at most k hits (ranks 1..k are
    unique), so the rank array is bounded by k whatever the label count;
    position i (1-based) in it is the number of hits so far.
    """
    stats = (_with_rank(labels, recs, k).groupBy(U)
             .agg(F.count(F.lit(1)).cast("long").alias("n_labels"),
                  F.sort_array(F.collect_list("rank")).alias("_ranks")))
    if how == "inner":
        if pred_users is None:
            if U not in recs.columns:
                raise ValueError("a global list needs pred_users")
            pred_users = recs.select(U)
        users = stats.join(pred_users.select(U).distinct(), U, "left_semi")
    elif how == "left":
        users = stats
    elif how == "pred":
        if pred_users is None:
            pred_users = recs.select(U)
        users = (pred_users.select(U).distinct().join(stats, U, "left")
                 .select(U, F.coalesce("n_labels", F.lit(0)).cast("long").alias("n_labels"),
                         F.coalesce("_ranks", F.array().cast("array<long>")).alias("_ranks")))
    else:
        raise ValueError("how must be 'inner', 'left' or 'pred'")
    ranks = F.col("_ranks")
    hits = F.size(ranks).cast("long")
    dcg = F.aggregate(F.transform(ranks, lambda r: F.lit(1.0) / F.log2(r.cast("double") + 1.0)),
                      F.lit(0.0), lambda acc, x: acc + x)
    m = F.least(F.col("n_labels"), F.lit(k))
    has = F.col("n_labels") > 0
    return users.select(
        U, "n_labels", hits.alias("hits"),
        F.when(has, _ap_of_ranks(ranks, F.col("n_labels"), k)).otherwise(F.lit(0.0)).alias("ap"),
        (hits.cast("double") / F.lit(float(k))).alias("precision"),
        F.when(has, hits.cast("double") / F.col("n_labels").cast("double")).otherwise(F.lit(0.0)).alias("recall"),
        F.when(has, dcg / F.element_at(_ideal_dcg(k), m.cast("int"))).otherwise(F.lit(0.0)).alias("ndcg"),
        F.when(hits > 0, F.lit(1.0) / F.element_at(ranks, 1).cast("double")).otherwise(F.lit(0.0)).alias("rr"))


def _ap_of_ranks(ranks, n_labels, k: int):
    """AP@k from the sorted hit ranks (position i = hits so far) and |labels|."""
    ap_sum = F.aggregate(F.transform(ranks, lambda r, i: (i + 1).cast("double") / r.cast("double")),
                         F.lit(0.0), lambda acc, x: acc + x)
    return ap_sum / F.least(n_labels, F.lit(k)).cast("double")


def map_per_list(labels: DataFrame, lists: DataFrame, users: DataFrame, k: int, key: str,
                 keys: list) -> DataFrame:
    """(key, users, map): MAP@k of several global lists at once, in one pass.

    ``lists`` holds (key, item_id, rank) for the list keys ``keys`` (a
    parameter list), at most k items each. The lists are grouped per item
    (|keys| x k rows at most, broadcast), each label row is joined once, and
    one per-user aggregate collects the user's (key, rank) hits -- at most
    |keys| x k. AP per key comes from the hits of that key; users without a
    hit score 0. Users: labelled users that are in ``users``.
    """
    per_item = (lists.where(F.col("rank") <= F.lit(k))
                     .groupBy(I).agg(F.collect_list(F.struct(F.col(key).alias("key"), F.col("rank")))
                                     .alias("_lr")))
    stats = (labels.select(U, I).join(F.broadcast(per_item), I, "left")
                   .groupBy(U).agg(F.count(F.lit(1)).cast("long").alias("n_labels"),
                                   F.flatten(F.collect_list("_lr")).alias("_hits"))
                   .join(users.select(U).distinct(), U, "left_semi"))
    def of_key(value):
        # One-argument predicate: PySpark reads a second parameter as the index.
        return lambda h: h["key"] == F.lit(value)

    aps = []
    for i, value in enumerate(keys):
        ranks = F.array_sort(F.transform(F.filter("_hits", of_key(value)), lambda h: h["rank"]))
        aps.append(_ap_of_ranks(ranks, F.col("n_labels"), k).alias(f"_ap{i}"))
    sums = stats.select(*aps).agg(F.count(F.lit(1)).cast("long").alias("users"),
                                  *[F.coalesce(F.sum(f"_ap{i}"), F.lit(0.0)).alias(f"_s{i}")
                                    for i in range(len(keys))])
    rows = F.array(*[F.struct(F.lit(value).alias(key), F.col(f"_s{i}").alias("_s"))
                     for i, value in enumerate(keys)])
    return (sums.select("users", F.explode(rows).alias("_r"))
                .select(F.col(f"_r.{key}").alias(key), "users",
                        F.when(F.col("users") > 0, F.col("_r._s") / F.col("users").cast("double"))
                         .otherwise(F.lit(0.0)).alias("map")))


def summarize(per_user: DataFrame) -> DataFrame:
    """One row: users and the mean of every per-user metric."""
    return per_user.agg(F.count(F.lit(1)).cast("long").alias("users"),
                        F.coalesce(F.avg("ap"), F.lit(0.0)).alias("map"),
                        F.coalesce(F.avg("precision"), F.lit(0.0)).alias("precision"),
                        F.coalesce(F.avg("recall"), F.lit(0.0)).alias("recall"),
                        F.coalesce(F.avg("ndcg"), F.lit(0.0)).alias("ndcg"),
                        F.coalesce(F.avg("rr"), F.lit(0.0)).alias("mrr"))


def ranking_summary(top_labels: DataFrame, labels: DataFrame, recs: DataFrame, k: int,
                    pred_users: DataFrame | None = None) -> DataFrame:
    """One row: users; map and ndcg against ``top_labels`` (the truth cut to k), precision, recall and mrr against ``labels``."""
    cut = summarize(per_user_metrics(top_labels, recs, k, pred_users)).select("users", "map", "ndcg")
    whole = summarize(per_user_metrics(labels, recs, k, pred_users)).select(F.struct("precision", "recall", "mrr").alias("m"))
    return cut.withColumn("m", whole.scalar()).select("users", "map", "m.precision", "m.recall", "ndcg", "m.mrr")


def _mean(per_user: DataFrame, column: str, out: str) -> DataFrame:
    return per_user.agg(F.count(F.lit(1)).cast("long").alias("users"),
                        F.coalesce(F.avg(column), F.lit(0.0)).alias(out))


def map_at_k(labels, recs, k=100, pred_users=None, how="inner") -> DataFrame:
    """One row (users, map)."""
    return _mean(per_user_metrics(labels, recs, k, pred_users, how), "ap", "map")


def precision_at_k(labels, recs, k=100, pred_users=None, how="inner") -> DataFrame:
    return _mean(per_user_metrics(labels, recs, k, pred_users, how), "precision", "precision")


def recall_at_k(labels, recs, k=100, pred_users=None, how="inner") -> DataFrame:
    return _mean(per_user_metrics(labels, recs, k, pred_users, how), "recall", "recall")


def ndcg_at_k(labels, recs, k=100, pred_users=None, how="inner") -> DataFrame:
    return _mean(per_user_metrics(labels, recs, k, pred_users, how), "ndcg", "ndcg")


def mrr(labels, recs, k=100, pred_users=None, how="inner") -> DataFrame:
    return _mean(per_user_metrics(labels, recs, k, pred_users, how), "rr", "mrr")


def auc_global_scores(positives: DataFrame, scores: DataFrame, score: str = "score", universe: DataFrame | None = None,
                      partitions: int | None = None) -> DataFrame:
    """(user_id, m, auc): per-user AUC of one global item scoring.

    ``universe`` (item_id) is the dictionary of items, by default the scored
    ones; items of it without a score share the lowest mid-rank. An item's
    ascending mid-rank is (items scored lower) + (items with the same score +
    1) / 2; the items are range-sorted for it, and only the positives are joined
    to them, never users x items.
    AUC_u = (sum of positive mid-ranks - m(m+1)/2) / (m (N - m)) for the m
    positives of u in the universe of N items, users with 0 < m < N.
    """
    items = scores.select(I, score)
    if universe is not None:
        items = universe.select(I).distinct().join(items, I, "left")
    ranked = value_positions(items, score, [I], partitions=partitions)
    n_items = F.col("total")
    mid = ranked.select(I, "total", (F.col("before").cast("double") + (F.col("ties").cast("double") + 1.0) / 2.0).alias("_mid"))
    pos = positives.select(U, I).distinct().join(mid, I)
    return (pos.groupBy(U).agg(F.count(F.lit(1)).cast("long").alias("m"), F.sum("_mid").alias("_s"), F.max("total").alias("total"))
               .where((F.col("m") > 0) & (F.col("m") < n_items))
               .select(U, "m", ((F.col("_s") - F.col("m") * (F.col("m") + 1) / 2.0)
                                / (F.col("m").cast("double") * (n_items - F.col("m")).cast("double"))).alias("auc")))


def auc_summary(per_user: DataFrame) -> DataFrame:
    return _mean(per_user, "auc", "auc")

"""Damped popularity model: P[i] = sum_u R[u,i] / (|R[:,i]| + beta).

The model is one list shared by all users, so it is never multiplied out into
users x k rows for evaluation: metrics join the ground truth to the (broadcast,
k-bounded) list on the item.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from encore.functions.columns import smoothed_mean
from encore.functions.ordering import global_row_number
from encore.operators.metrics import map_per_list
from encore.session import ensure_checkpoint_dir
from encore.sources.tables import materialize

U, I, N = "user_id", "item_id", "interactions"
#: So many of the best ranks are broadcast to the users that take them.
HEAD = 20_000


def item_aggregates(ix: DataFrame) -> DataFrame:
    """(item_id, total_listens, num_users) over positive interactions."""
    return (ix.where(F.col(N) > 0).groupBy(I)
              .agg(F.sum(N).alias("total_listens"),
                   F.count(U).cast("long").alias("num_users")))


def popularity(ix: DataFrame, beta: float = 5000) -> DataFrame:
    """(item_id, total_listens, num_users, score) with score = total / (users + beta)."""
    return item_aggregates(ix).withColumn("score", smoothed_mean("total_listens", "num_users", beta))


def top_k(pop: DataFrame, k: int = 100, score: str = "score") -> DataFrame:
    """(item_id, score, rank) of the k best items, ties by item id.

    Sort + limit becomes a take-ordered: each task keeps k rows, the final
    merge sees k rows per task. The rank is numbered over those k rows only.
    """
    best = pop.orderBy(F.col(score).desc(), F.col(I).asc()).limit(k).select(I, score)
    # Window over the k-row result (bounded by k).
    w = Window.orderBy(F.col(score).desc(), F.col(I).asc())
    return best.withColumn("rank", F.row_number().over(w).cast("long"))


def recommend_popular(top: DataFrame, users: DataFrame, out: str = "recommendations") -> DataFrame:
    """(user_id, recommendations): the same ranked item array for every user.

    The k-item array is a scalar subquery, evaluated once and attached to
    each user row; no join or cross product with the user table.
    """
    arr = top.agg(F.transform(F.sort_array(F.collect_list(F.struct("rank", I))),
                              lambda s: s[I]).alias(out))
    return users.select(U).distinct().select(U, arr.scalar().alias(out))


def recommend_unseen(pop: DataFrame, users: DataFrame, seen: DataFrame, k: int = 100, score: str = "score",
                     width: int = 1000) -> DataFrame:
    """(user_id, item_id, rank): each user's k best items among those the user has not seen.

    The items are ranked once. The unseen ranks of a user are all ranks but
    those of the user's own items, so only these are looked at, never users x
    items: they are counted in stretches of ``width`` ranks, the stretches up to
    the k-th unseen rank are kept, and the gaps between the seen ranks there
    give the ranks that fill the k places. A user gets fewer than k items only
    where fewer unseen ones exist.
    """
    ranked = materialize(global_row_number(pop.select(I, score), [F.col(score).desc(), F.col(I).asc()], out="g").select(I, "g"), "ranking")
    n_items = ranked.agg(F.count(F.lit(1))).first()[0]
    own = seen.select(U, I).distinct().join(ranked, I).select(U, "g", F.floor((F.col("g") - 1) / width).alias("s"))
    own = materialize(own.join(users.select(U).distinct(), U, "left_semi"), "seen_ranks")
    counts = own.groupBy(U, "s").agg(F.count(F.lit(1)).alias("c"))
    # Ranks in the stretches before, less the seen ones: a stretch in which k unseen ones have gone before is not needed.
    before = F.coalesce(F.sum("c").over(Window.partitionBy(U).orderBy("s").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    needed = counts.withColumn("seen_before", before).where(F.col("s") * width - F.col("seen_before") < k).select(U, "s")
    places = Window.partitionBy(U).orderBy("g")
    near = (own.join(needed, [U, "s"], "left_semi")
               .withColumn("j", F.row_number().over(places))
               .where(F.col("g") - F.col("j") < k)
               .withColumn("next", F.lead("g").over(places)))
    head = near.where("j = 1").select(U, F.lit(0).cast("long").alias("g"), F.lit(0).alias("j"), F.col("g").alias("next"))
    fresh = users.select(U).distinct().join(near.select(U).distinct(), U, "left_anti").select(
        U, F.lit(0).cast("long").alias("g"), F.lit(0).alias("j"), F.lit(None).cast("long").alias("next"))
    gaps = near.select(U, "g", "j", "next").unionByName(head).unionByName(fresh)
    # After seen rank g, the j-th: g - j unseen ranks have gone before; the gap gives at most k - (g - j) more.
    last = F.least(F.coalesce("next", F.lit(n_items + 1)) - 1, F.col("g") + k - (F.col("g") - F.col("j")), F.lit(n_items))
    filled = (gaps.where(last > F.col("g")).select(U, "j", F.explode(F.sequence(F.col("g") + 1, last)).alias("g")))
    places = materialize(filled.select(U, "g", (F.col("g") - F.col("j")).cast("long").alias("rank")).where(F.col("rank") <= k), "unseen_ranks")
    # Nearly every user takes its places among the first ranks: these few rows are broadcast, so no rank is a hot key.
    first = F.col("g") <= HEAD
    head = places.where(first).join(F.broadcast(ranked.where(first)), "g")
    rest = places.where(~first).join(ranked.where(~first), "g")
    return head.unionByName(rest).select(U, I, "rank")


def top_k_per_beta(ix: DataFrame, betas: list[float], k: int = 100) -> DataFrame:
    """(beta, item_id, score, rank): top k for every beta in one job.

    Item aggregates are computed once; each item row is expanded into one row
    per beta (a parameter list) and ranked per beta with a window group limit,
    so each task keeps k rows per beta before the shuffle.
    """
    agg = item_aggregates(ix)
    expanded = (agg.withColumn("beta", F.explode(F.array(*[F.lit(float(b)) for b in betas])))
                   .withColumn("score", F.col("total_listens").cast("double")
                               / (F.col("num_users").cast("double") + F.col("beta"))))
    w = Window.partitionBy("beta").orderBy(F.col("score").desc(), F.col(I).asc())
    return (expanded.withColumn("rank", F.row_number().over(w).cast("long"))
                    .where(F.col("rank") <= F.lit(k))
                    .select("beta", I, "score", "rank"))


def sweep_popularity(train: DataFrame, segments: dict[str, tuple[DataFrame, DataFrame]],
                     betas: list[float], k: int = 100) -> DataFrame:
    """(beta, segment, users, map): MAP@k of the popularity list for every beta.

    ``segments`` maps a name to (labels, users): the ground truth (user_id,
    item_id) and the users asked to be scored. The lists of all betas are
    built in one job from one item aggregation and checkpointed; each segment
    is scored against all of them in one pass over its labels.
    """
    ensure_checkpoint_dir(train.sparkSession)
    lists = top_k_per_beta(train, betas, k).checkpoint(eager=True)
    keys = [float(b) for b in betas]
    rows = [map_per_list(labels, lists, users, k, "beta", keys).withColumn("segment", F.lit(name))
            for name, (labels, users) in segments.items()]
    out = rows[0]
    for r in rows[1:]:
        out = out.unionByName(r)
    return out.select("beta", "segment", "users", "map")

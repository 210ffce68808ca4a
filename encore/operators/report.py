"""Model comparison table: one (model, segment, metric, k, users, value) row per result."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def metric_row(summary: DataFrame, model: str, segment: str, metric: str, k: int,
               column: str | None = None) -> DataFrame:
    """Label a one-row metric summary (columns ``users`` and ``column``)."""
    return summary.select(F.lit(model).alias("model"), F.lit(segment).alias("segment"),
                          F.lit(metric).alias("metric"), F.lit(k).cast("int").alias("k"),
                          F.col("users"), F.col(column or metric).cast("double").alias("value"))


def metric_rows(summary: DataFrame, model: str, segment: str, k: int,
                metrics: list[str]) -> DataFrame:
    """All ``metrics`` of a one-row summary as rows, computing the summary once."""
    long = summary.select("users", *[F.col(m).cast("double").alias(m) for m in metrics]).unpivot(
        ["users"], metrics, "metric", "value")
    return long.select(F.lit(model).alias("model"), F.lit(segment).alias("segment"), "metric",
                       F.lit(k).cast("int").alias("k"), "users", "value")


def compare_models(rows: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), rows)


def _poisson_steps(most: int = 16) -> list[float]:
    """P(X <= k) of a Poisson variable of mean 1, for k = 0, 1, ..."""
    out, term, total = [], math.exp(-1.0), 0.0
    for k in range(most):
        total += term
        out.append(total)
        term /= k + 1
    return out


POISSON_STEPS = _poisson_steps()


def bootstrap(per_user: DataFrame, metrics: list[str], replicates: int = 200, seed: int = 42, level: float = 0.95, user: str = "user_id") -> DataFrame:
    """(metric, users, value, low, high): means over users, with percentile intervals from a Poisson bootstrap.

    A user counts Poisson(1) times in a replicate, by a hash of seed, user and
    replicate, so every task draws for itself and the same user gets the same
    draws in every model: intervals of paired differences are valid. Each task
    adds up its users by replicate; only ``replicates`` rows a task are shuffled.
    A replicate in which nobody counts is left out; without users there is no row.
    """
    u = F.conv(F.substring(F.md5(F.concat_ws("|", F.lit(str(seed)), F.col(user).cast("string"), F.col("replicate").cast("string"))), 1, 13), 16, 10)
    unit = u.cast("long").cast("double") / F.lit(float(1 << 52))
    weight = reduce(lambda a, b: a + b, [(F.col("unit") >= F.lit(c)).cast("int") for c in POISSON_STEPS])
    drawn = (per_user.select(user, *[F.col(m).cast("double").alias(m) for m in metrics], F.explode(F.sequence(F.lit(1), F.lit(replicates))).alias("replicate"))
                     .withColumn("unit", unit).withColumn("w", weight))
    sums = drawn.groupBy("replicate").agg(F.sum("w").alias("n"), *[F.sum(F.col(m) * F.col("w")).alias(m) for m in metrics]).where("n > 0")
    means = sums.select("replicate", *[(F.col(m) / F.col("n")).alias(m) for m in metrics]).unpivot(["replicate"], metrics, "metric", "value")
    tail = (1 - level) / 2
    bounds = means.groupBy("metric").agg(F.percentile("value", F.lit(tail)).alias("low"), F.percentile("value", F.lit(1 - tail)).alias("high"))
    whole = per_user.agg(F.count(F.lit(1)).cast("long").alias("users"), *[F.avg(m).alias(m) for m in metrics]).unpivot(["users"], metrics, "metric", "value")
    return whole.join(F.broadcast(bounds), "metric").select("metric", "users", "value", "low", "high")  # a row a metric


def paired_difference(a: DataFrame, b: DataFrame, metrics: list[str], user: str = "user_id") -> DataFrame:
    """Per user: the metrics of ``a`` less those of ``b``, for users of both."""
    other = b.select(user, *[F.col(m).alias(f"other_{m}") for m in metrics])
    return a.join(other, user).select(user, *[(F.col(m) - F.col(f"other_{m}")).alias(m) for m in metrics])

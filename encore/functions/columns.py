"""Scalar column helpers (all native Spark expressions, no UDFs)."""

from __future__ import annotations

from fractions import Fraction

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Histogram bins of the reference's distribution tables.
# Unique listeners per track, 10 bins (edges are exclusive upper bounds).
LISTENER_EDGES = [5, 10, 20, 30, 40, 50, 100, 200, 500]
LISTENER_LABELS = ["[0, 5)", "[5, 10)", "[10, 20)", "[20, 30)", "[30, 40)", "[40, 50)",
                   "[50, 100)", "[100, 200)", "[200, 500)", ">=500"]
# Unique tracks per user, 9 bins.
ACTIVITY_EDGES = [10, 25, 50, 100, 200, 300, 400, 500]
ACTIVITY_LABELS = ["[0, 10)", "[10, 25)", "[25, 50)", "[50, 100)", "[100, 200)",
                   "[200, 300)", "[300, 400)", "[400, 500)", ">=500"]


def exact_fraction(x) -> Fraction:
    """Decimal reading of ``x`` (0.8 -> 4/5), never the binary float."""
    return Fraction(str(x)).limit_denominator(10**9)


def floor_fraction(col: str, fraction) -> Column:
    """floor(fraction * col) for a non-negative count column, in exact integer arithmetic."""
    q = exact_fraction(fraction)
    return F.expr(f"(CAST(`{col}` AS BIGINT) * {q.numerator}) div {q.denominator}")


def exact_long(col: Column | str) -> Column:
    """A number that holds a whole value as bigint; a fractional value is an error, never truncated."""
    c = F.col(col) if isinstance(col, str) else col
    whole = F.when(c.isNull(), F.lit(None)).when(c == F.floor(c), c.cast("long"))
    return whole.otherwise(F.raise_error(F.concat(F.lit("not a whole number: "), c.cast("string"))).cast("long"))


def impute_item_id(df: DataFrame, primary: str, fallback: str, out: str | None = None) -> DataFrame:
    """Missing primary id replaced by the fallback id (coalesce)."""
    return df.withColumn(out or primary, F.coalesce(F.col(primary), F.col(fallback).cast("string")))


def bucketize(col: Column | str, edges: list, labels: list[str]) -> Column:
    """Label of the half-open bin [edge_i-1, edge_i) holding ``col``; last label above."""
    if len(labels) != len(edges) + 1:
        raise ValueError("need one more label than edges")
    c = F.col(col) if isinstance(col, str) else col
    expr = F.when(c < F.lit(edges[0]), F.lit(labels[0]))
    for edge, label in zip(edges[1:], labels[1:-1]):
        expr = expr.when(c < F.lit(edge), F.lit(label))
    return expr.otherwise(F.lit(labels[-1]))


def smoothed_mean(total: Column | str, count: Column | str, beta) -> Column:
    """Damped mean total / (count + beta) in double arithmetic."""
    t = F.col(total) if isinstance(total, str) else total
    n = F.col(count) if isinstance(count, str) else count
    return t.cast("double") / (n.cast("double") + F.lit(float(beta)))


def conform(df: DataFrame, columns: list[str] | None = None, positions: list[int] | None = None) -> DataFrame:
    """Reorder / select columns by name or by position."""
    if positions is not None:
        return df.select(*[df.columns[i] for i in positions])
    return df.select(*columns)


def hash_order_key(seed, *cols: str) -> Column:
    """md5 of 'seed|c1|c2...': a seeded, random-looking, engine-independent order."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.col(c).cast("string") for c in cols]))

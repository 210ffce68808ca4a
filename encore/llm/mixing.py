"""Mixing sources to target weights by Poisson replication.

A source's mean repetition rate is ``target share * wanted rows / rows of the
source``. Each document draws its number of copies by inverting the Poisson
distribution of that rate at a hash of seed and id, is exploded by it, and all
copies are dealt out and sorted by a hash: a global shuffle. Draws depend on
the row alone, so a lost task draws the same again.

A large rate is cut into equal parts of at most ``PART_RATE`` whose draws (each
with its own hash) add up: the sum of Poisson variables is one, and the
inversion table of a part stays short.

Native: DataFrame functions only.

Defined cases: a null source is a source of its own; a source without a weight
gets weight 0 and vanishes; equal ids draw equally (repeated rows are repeated
together), null ids draw by their text; null and empty texts are mixed like
others; an empty table stays empty; columns of any name are kept, and the
added ones take free names (``copy``, ``copies``, ``rate``, ``shuffle_key``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from encore.llm.common import free_name
from encore.session import ensure_checkpoint_dir

PART_RATE = 16.0
#: Table length of a part: the Poisson tail beyond it is under 2^-52 for rates up to PART_RATE.
TABLE = 80


def hash_unit(*parts: Column) -> Column:
    """52 bits of md5 over the parts as a double in [0, 1)."""
    digest = F.md5(F.concat_ws("|", *[p.cast("string") for p in parts]))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("long").cast("double") / F.lit(float(1 << 52))


def source_rates(docs: DataFrame, source_col: str = "source", weights: dict[str | None, float] | None = None,
                 exponent: float = 0.5, wanted_rows: int | None = None) -> DataFrame:
    """One row a source: source, rows, rate, parts, table (cumulative Poisson of one part).

    ``weights`` are target shares in any unit; without them a source's weight is
    ``rows ** exponent``, which evens out sources. ``wanted_rows`` is the mean
    size of the mix, by default that of the input.
    """
    stats = docs.groupBy(F.col(source_col).alias("source")).agg(F.count(F.lit(1)).alias("rows"))
    if weights is None:
        weight = F.pow(F.col("rows").cast("double"), F.lit(exponent))
    else:
        weight = F.lit(0.0)
        for name, value in weights.items():
            weight = F.when(F.col("source").eqNullSafe(F.lit(name)), F.lit(float(value))).otherwise(weight)
    ensure_checkpoint_dir(docs.sparkSession)
    stats = stats.withColumn("weight", weight).checkpoint()
    sums = stats.agg(F.sum("weight").alias("w"), F.sum("rows").alias("n")).first()
    if not sums["n"] or not sums["w"]:
        stats = stats.withColumn("rate", F.lit(0.0))
    else:
        wanted = float(sums["n"] if wanted_rows is None else wanted_rows)
        stats = stats.withColumn("rate", F.col("weight") / F.lit(float(sums["w"])) * F.lit(wanted) / F.col("rows"))
    stats = stats.withColumn("parts", F.greatest(F.ceil(F.col("rate") / PART_RATE).cast("int"), F.lit(1)))
    part = F.col("rate") / F.col("parts")
    steps = F.aggregate(
        F.sequence(F.lit(1), F.lit(TABLE)),
        F.struct(F.exp(-part).alias("p"), F.array(F.exp(-part)).alias("cdf")),
        lambda s, k: F.struct((s["p"] * part / k).alias("p"),
                              F.concat(s["cdf"], F.array(F.element_at(s["cdf"], -1) + s["p"] * part / k)).alias("cdf")),
        lambda s: s["cdf"])
    return stats.select("source", "rows", "rate", "parts", steps.alias("table"))


def mix(docs: DataFrame, rates: DataFrame, seed: int = 11, id_col: str = "doc_id", source_col: str = "source",
        text_col: str = "text", broadcast_sources: int = 10_000) -> DataFrame:
    """``docs`` repeated to the rates, in global random order.

    Adds rate, copies (drawn for the row), copy (1 ...) and shuffle_key. The
    rates are broadcast while there are at most ``broadcast_sources`` of them;
    beyond, they are joined by a shuffle, whose hot sources AQE splits.
    """
    names = {n: free_name(docs, n) for n in ("rate", "copies", "copy", "shuffle_key", "mix_key", "mix_parts", "mix_table", "mix_source")}
    table = rates.select(F.col("source").alias(names["mix_source"]), F.col("rate").alias(names["rate"]),
                         F.col("parts").alias(names["mix_parts"]), F.col("table").alias(names["mix_table"])).where(F.col(names["rate"]) > 0)
    if rates.limit(broadcast_sources + 1).count() <= broadcast_sources:
        table = F.broadcast(table)
    key = F.coalesce(F.col(id_col).cast("string"), F.concat(F.lit("null:"), F.md5(F.coalesce(F.col(text_col).cast("string"), F.lit("")))))
    joined = docs.join(table, F.col(source_col).eqNullSafe(F.col(names["mix_source"])), "inner").withColumn(names["mix_key"], key)
    points = F.transform(F.sequence(F.lit(1), F.col(names["mix_parts"])),
                         lambda part: hash_unit(F.lit(seed), F.col(names["mix_key"]), part))
    drawn = F.aggregate(points, F.lit(0), lambda total, u: total + F.size(F.filter(F.col(names["mix_table"]), lambda c: c <= u)))
    copies = (joined.withColumn(names["copies"], drawn).where(F.col(names["copies"]) > 0)
              .withColumn(names["copy"], F.explode(F.sequence(F.lit(1), F.col(names["copies"])))))
    shuffled = copies.withColumn(names["shuffle_key"], F.md5(F.concat_ws("|", F.lit(seed), F.lit("order"), F.col(names["mix_key"]), F.col(names["copy"]))))
    return (shuffled.drop(names["mix_key"], names["mix_parts"], names["mix_table"], names["mix_source"])
            .repartition(F.col(names["shuffle_key"])).sortWithinPartitions(names["shuffle_key"]))

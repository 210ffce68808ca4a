"""Dense id dictionaries kept as tables, and coordinate (COO) triples.

A fitted ``StringIndexer`` holds every label in a driver-side array that is
shipped to all tasks; at tens of millions of items that is the bottleneck.
Here the dictionary is a DataFrame numbered by a distributed global row
number and applied with a join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from encore.functions.ordering import global_row_number

U, I, N = "user_id", "item_id", "interactions"


def fit_item_index(df: DataFrame, item: str = I, out: str = "item_idx",
                   partitions: int | None = None) -> DataFrame:
    """(item, label, freq, out): index 0.. by row frequency descending, ties by
    the label string ascending -- StringIndexer's frequencyDesc order. NULLs
    are not indexed."""
    counts = (df.where(F.col(item).isNotNull()).groupBy(item)
                .agg(F.count(F.lit(1)).cast("long").alias("freq"))
                .withColumn("label", F.col(item).cast("string")))
    ranked = global_row_number(counts, [F.col("freq").desc(), F.col("label").asc()], "_rn", partitions)
    return ranked.select(item, "label", "freq", (F.col("_rn") - 1).cast("long").alias(out))


def apply_item_index(df: DataFrame, index: DataFrame, item: str = I, out: str = "item_idx") -> DataFrame:
    """Attach the index; unseen and NULL items get the extra index n (= number
    of labels), like handleInvalid='keep'."""
    n_labels = index.agg(F.count(F.lit(1)).cast("long")).scalar()
    return (df.join(index.select(item, out), item, "left")
              .withColumn(out, F.coalesce(F.col(out), n_labels)))


def fit_ids(df: DataFrame, col: str, out: str, partitions: int | None = None) -> DataFrame:
    """(col, out): distinct non-NULL values numbered 0.. in ascending order."""
    values = df.select(col).where(F.col(col).isNotNull()).distinct()
    ranked = global_row_number(values, [F.col(col).asc()], "_rn", partitions)
    return ranked.select(col, (F.col("_rn") - 1).cast("long").alias(out))


def to_coo(ix: DataFrame, users: DataFrame, items: DataFrame) -> DataFrame:
    """(u_idx, i_idx, value, weight): binary interaction matrix and weights."""
    return (ix.join(users, U).join(items, I)
              .select("u_idx", "i_idx", F.lit(1.0).alias("value"),
                      F.col(N).cast("double").alias("weight")))


#: Entries of a CSR block: 16 bytes each.
BLOCK_ENTRIES = 1 << 16


def to_csr(coo: DataFrame, entries: int = BLOCK_ENTRIES, value: str = "weight", partitions: int | None = None) -> DataFrame:
    """(block, rows, indptr, indices, data): the sparse matrix in blocks of ``entries`` entries, the last one shorter.

    Entries are numbered by (u_idx, i_idx) over the whole matrix and cut into
    blocks of equal size, so a user with many items spans blocks and no block is
    larger than the others. ``rows`` lists the block's users; the j-th has
    ``indices`` and ``data`` from ``indptr[j]`` to ``indptr[j + 1]``.
    """
    numbered = global_row_number(coo.select("u_idx", "i_idx", F.col(value).alias("v")), [F.col("u_idx").asc(), F.col("i_idx").asc()], "_rn", partitions)
    at = F.col("_rn") - 1
    placed = numbered.select("u_idx", "i_idx", "v", F.floor(at / entries).alias("block"), F.pmod(at, F.lit(entries)).cast("int").alias("at"))
    held = F.sort_array(F.collect_list(F.struct("at", "u_idx", "i_idx", "v")))  # a block's entries, in order
    blocks = placed.groupBy("block").agg(held.alias("e"))
    starts = F.filter(F.transform("e", lambda x, i: F.when((i == 0) | (x["u_idx"] != F.get("e", i - 1)["u_idx"]), i)), lambda i: i.isNotNull())
    starts = blocks.select("block", "e", starts.alias("starts"))
    return starts.select("block", F.transform("starts", lambda i: F.get("e", i)["u_idx"]).alias("rows"),
                         F.concat("starts", F.array(F.size("e"))).alias("indptr"), F.transform("e", lambda x: x["i_idx"]).alias("indices"),
                         F.transform("e", lambda x: x["v"]).alias("data"))


def from_csr(blocks: DataFrame, value: str = "weight") -> DataFrame:
    """(u_idx, i_idx, value): the entries of CSR blocks."""
    rows = blocks.select("indptr", "indices", "data", F.posexplode("rows").alias("j", "u_idx"))
    begin, n = F.get("indptr", F.col("j")), F.get("indptr", F.col("j") + 1) - F.get("indptr", F.col("j"))
    own = rows.select("u_idx", F.arrays_zip(F.slice("indices", begin + 1, n).alias("i"), F.slice("data", begin + 1, n).alias("v")).alias("e"))
    return own.select("u_idx", F.explode("e").alias("e")).select("u_idx", F.col("e")["i"].alias("i_idx"), F.col("e")["v"].alias(value))

"""Near duplicates by MinHash with tensored banding.

A text's set is its distinct 5-word shingles; documents are linked where the
sets' Jaccard similarity is at least 0.75, and a group is what links connect.

Tensored banding: there are two small collections of ``side`` half keys each,
a half key being ``half`` minhashes. The ``side * side`` table keys of a text
are all pairs (left half key, right half key). Two texts of similarity s share
a table key with probability ``(1 - (1 - s**half) ** side) ** 2``, which is
0.9995 at 0.75 for the defaults, out of 40 minhashes where as many independent
tables would need 400.

Texts with equal sets are one class, found by a digest of the set; only class
representatives go on. In each table bucket the members are paired with one
leader (not with each other), and pairs are verified on the full sets. Where a
bucket still holds several components, further rounds pair its members with
other leaders, drawn by a hash, if their components differ. Its hot key is a
row on the leaders' side of a join whose other side AQE splits.

The buckets that then still hold several components are finished exactly: their
members meet by the left half key of the bucket, in blocks of about
``BLOCK_ROWS`` texts and ``BLOCK_SHINGLES`` shingles, two blocks a task, and a
task counts the common shingles of all its pairs on the full sets. So every two
texts that share a table key are verified or known to be of one component. Rows
grow with a bucket's members times its blocks, and a task is bounded; the work
in tasks grows with the square of the members of such buckets.

Defined cases: null, empty and wordless texts have an empty set and are linked
with nothing; a text of fewer than five words is one shingle; rows without an
id are linked with nothing (component null, kept); rows that share an id are
one node, which has the links of all of them; an empty table gives no rows;
columns of other names are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from encore.llm.common import as_texts, pieces
from encore.llm.components import connected_components
from encore.llm.shingles import SHINGLE_WORDS, mix, shingle_sets
from encore.sources.tables import materialize

PIECE_BYTES = 1 << 20
#: Lists of at most so many ids are broadcast; longer ones are joined by a shuffle.
BROADCAST_IDS = 1_000_000
#: About so many texts and shingles are in a block of the exact join.
BLOCK_ROWS, BLOCK_SHINGLES = 256, 1 << 19
#: Shingles in fewer texts of a task are counted pair by pair, others by a matrix product of so many columns at a time.
PAIRED, COLUMNS = 32, 2048


def _factors(count: int, seed: int) -> np.ndarray:
    """Odd 64-bit multipliers; each orders hashed shingles in its own way."""
    return mix(np.arange(1, count + 1, dtype=np.uint64) + np.uint64(seed << 32)) | np.uint64(1)


def half_keys(sets: list[np.ndarray], side: int, half: int, seed: int) -> np.ndarray:
    """(texts, 2 * side) half keys of non-empty sets, each hashed from ``half`` minima."""
    values = np.concatenate(sets)
    starts = np.cumsum([0, *map(len, sets)])[:-1]
    out = np.zeros((len(sets), 2 * side), np.uint64)
    factors = _factors(2 * side * half, seed)
    with np.errstate(over="ignore"):
        for key in range(2 * side):
            for part in range(half):
                least = np.minimum.reduceat(values * factors[key * half + part], starts)
                out[:, key] = mix(out[:, key] * np.uint64(31) + least + np.uint64(part + 1))
    return out


def sketches(docs: DataFrame, id_col: str, text_col: str, words: int, side: int, half: int, seed: int) -> DataFrame:
    """One row a document: id, n (set size), digest of the set, left and right half keys."""

    def run(batches):
        for batch in batches:
            texts = as_texts(batch.column("text"))
            for start, rows in pieces(texts, PIECE_BYTES):
                sets = shingle_sets(texts.slice(start, rows), words)
                solid = [s for s in sets if len(s)]
                keys = iter(half_keys(solid, side, half, seed).view(np.int64).tolist() if solid else [])
                lists = [next(keys) if len(s) else [] for s in sets]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id").slice(start, rows), pa.array([len(s) for s in sets], pa.int64()),
                     pa.array([xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets], pa.binary()),
                     pa.array([k[:side] for k in lists], pa.list_(pa.int64())), pa.array([k[side:] for k in lists], pa.list_(pa.int64()))],
                    names=["id", "n", "digest", "left", "right"])

    base = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return base.mapInArrow(run, f"id {dict(base.dtypes)['id']}, n long, digest binary, left array<long>, right array<long>")


def _sets(docs: DataFrame, nodes: DataFrame, id_col: str, text_col: str, words: int) -> DataFrame:
    """(node, set) of the documents whose ids are in ``nodes``."""

    def run(batches):
        for batch in batches:
            texts = as_texts(batch.column("text"))
            for start, rows in pieces(texts, PIECE_BYTES):
                sets = shingle_sets(texts.slice(start, rows), words)
                offsets = np.cumsum([0, *map(len, sets)]).astype(np.int32)
                values = pa.array(np.concatenate(sets).view(np.int64), pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [batch.column("node").slice(start, rows), pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), values)], names=["node", "set"])

    base = docs.select(F.col(id_col).alias("node"), F.col(text_col).cast("string").alias("text"))
    wanted = base.join(_small(nodes), "node", "left_semi")
    return wanted.mapInArrow(run, f"node {dict(base.dtypes)['node']}, set array<long>")


def _small(ids: DataFrame) -> DataFrame:
    """``ids`` (one column), to be broadcast if its size, which is checked, allows it."""
    return F.broadcast(ids) if ids.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS else ids


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets have 100 * intersection >= percent * union."""
    left = sets.select(F.col("node").alias("a"), F.col("set").alias("sa"))
    right = sets.select(F.col("node").alias("b"), F.col("set").alias("sb"))
    both = F.size(F.array_intersect("sa", "sb"))
    # Pairs are distinct already; an aggregate here would keep AQE from splitting a hot leader's pairs.
    return (pairs.join(left, "a").join(right, "b").where(100 * both >= percent * (F.size("sa") + F.size("sb") - both))
            .select("a", "b"))


def common_counts(sets: list[np.ndarray]) -> np.ndarray:
    """How many values each two of the sets (of distinct values) have in common; only the upper triangle is whole."""
    m = len(sets)
    values = np.concatenate(sets)
    rows = np.repeat(np.arange(m), [len(s) for s in sets])
    order = np.argsort(values, kind="stable")  # the rows of a value stay in ascending order
    values, rows = values[order], rows[order]
    starts = np.flatnonzero(np.concatenate([[True], values[1:] != values[:-1]]))
    often = np.diff(np.append(starts, len(values)))
    each = np.repeat(often, often)
    out = np.zeros((m, m), np.float32)
    few, at = (each > 1) & (each < PAIRED), 1
    v, r = values[few], rows[few]
    while at < PAIRED and (same := v[:-at] == v[at:]).any():
        out += np.bincount(r[:-at][same] * m + r[at:][same], minlength=m * m).reshape(m, m)
        at += 1
    many = each >= PAIRED
    column, r = np.repeat(np.arange((often >= PAIRED).sum()), often[often >= PAIRED]), rows[many]
    for low in range(0, int(column[-1]) + 1 if len(column) else 0, COLUMNS):
        a, b = np.searchsorted(column, [low, low + COLUMNS])
        holds = np.zeros((m, COLUMNS), np.float32)
        holds[r[a:b], column[a:b] - low] = 1
        out += holds @ holds.T
    return out


def _exact(open_rows: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) between components, one for each two in a task, among the texts (key, node, n, c) that share a key."""
    sizes = (open_rows.groupBy("key").agg(F.count(F.lit(1)).alias("m"), F.sum("n").alias("w"), F.min("c").alias("c0"), F.max("c").alias("c1"))
             .where("c0 <> c1").select("key", F.greatest(F.ceil(F.col("m") / BLOCK_ROWS), F.ceil(F.col("w") / BLOCK_SHINGLES)).cast("int").alias("blocks")))
    block = F.pmod(F.xxhash64("key", "node"), F.col("blocks")).cast("int")
    others = F.when(F.col("blocks") == 1, F.array(F.lit(0))).otherwise(
        F.array_except(F.sequence(F.lit(0), F.col("blocks") - 1), F.array(F.col("block"))))
    dealt = (open_rows.join(sizes, "key").withColumn("block", block).withColumn("other", F.explode(others))
             .select("key", "node", "c", F.least("block", "other").alias("p"), F.greatest("block", "other").alias("q")))

    def run(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        lists = table.column("set").chunk(0)
        flat, at = lists.flatten().to_numpy(), lists.offsets.to_numpy() - lists.offsets[0].as_py()
        alike = [flat[a:b] for a, b in zip(at, at[1:])]
        n = np.diff(at)
        both = common_counts(alike)
        component = table.column("c").chunk(0).dictionary_encode().indices.to_numpy()
        near = np.triu(100 * both >= percent * (n[:, None] + n[None, :] - both), 1) & (component[:, None] != component[None, :])
        a, b = np.nonzero(near)
        ends = np.sort(np.stack([component[a], component[b]], 1), axis=1)
        one = np.unique(ends, axis=0, return_index=True)[1]
        node = table.column("node").chunk(0)
        return pa.table({"a": node.take(pa.array(a[one])), "b": node.take(pa.array(b[one]))})

    kind = dict(open_rows.dtypes)["node"]
    return dealt.join(sets, "node").select("key", "p", "q", "node", "c", "set").groupBy("key", "p", "q").applyInArrow(run, f"a {kind}, b {kind}")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = SHINGLE_WORDS, percent: int = 75,
                    side: int = 10, half: int = 2, rounds: int = 3, seed: int = 5) -> DataFrame:
    """One row for each row of ``docs``: id, n_shingles, component_id (smallest id reachable), kept (id is that)."""
    sketch = materialize(sketches(docs, id_col, text_col, words, side, half, seed), "sketches")
    linked = sketch.where(F.col("digest").isNotNull() & F.col("id").isNotNull())
    classes = materialize(linked.groupBy("digest").agg(
        F.min("id").alias("node"), F.first("n").alias("n"), F.first("left").alias("left"), F.first("right").alias("right")), "classes")
    member = classes.select("digest", "node")

    tensored = F.flatten(F.transform("left", lambda x, i: F.transform("right", lambda y, j: F.xxhash64(i, j, x, y))))
    keys = classes.select("node", "n", F.explode(tensored).alias("key"))
    common = keys.groupBy("key").agg(F.count(F.lit(1)).alias("m")).where(F.col("m") > 1).select("key")
    shared = materialize(keys.join(common, "key").select("key", "node", "n"), "buckets")
    sets = materialize(_sets(docs, shared.select("node").distinct(), id_col, text_col, words), "sets")

    # Rows that share an id but not a set tie their classes.
    several = linked.groupBy("id").agg(F.count_distinct("digest").alias("m")).where(F.col("m") > 1).select("id")
    ties = (linked.join(several, "id").select("id", "digest").join(member, "digest")
            .where(F.col("id") != F.col("node")).select(F.col("node").alias("a"), F.col("id").alias("b")))

    links = materialize(ties.distinct(), "links")
    tried, component, order = None, None, 0

    def verify(members: DataFrame) -> bool:
        """Pair the members (key, node, n, c) of each bucket with its leader, if the components differ; add the links found."""
        nonlocal links, tried, order
        order += 1
        # The first order is the same in all buckets, so a group's members meet the same leader; later ones differ by bucket.
        by = F.xxhash64(F.lit(order), F.lit(0), "key", "node") if order > 1 else F.lit(0)
        lead = (members.groupBy("key").agg(F.min(F.struct(by.alias("o"), "node", "n", "c")).alias("lead"), F.min("c").alias("c0"), F.max("c").alias("c1"))
                .where("c0 <> c1").select("key", "lead"))
        apart = members.join(lead, "key").where(
            (F.col("c") != F.col("lead.c")) & (100 * F.least("n", F.col("lead.n")) >= percent * F.greatest("n", F.col("lead.n"))))
        pairs = apart.select(F.least("node", F.col("lead.node")).alias("a"), F.greatest("node", F.col("lead.node")).alias("b")).distinct()
        pairs = materialize(pairs if tried is None else pairs.join(tried, ["a", "b"], "left_anti"), "pairs")
        found = materialize(_verified(pairs, sets, percent), "links")
        tried = pairs if tried is None else tried.union(pairs)
        links = links.union(found)
        return found.limit(1).count() > 0

    def labelled() -> DataFrame:
        return shared.join(component.withColumnRenamed("component", "c"), "node", "left").withColumn("c", F.coalesce("c", "node"))

    verify(shared.withColumn("c", F.col("node")))
    component = connected_components(links)
    for _ in range(rounds - 1):
        if not verify(labelled()):
            break
        component = connected_components(links)
    # A bucket of two has met its only pair. The others that still hold several components are finished pair by pair.
    rows = labelled()
    several_left = (rows.groupBy("key").agg(F.count(F.lit(1)).alias("m"), F.min("c").alias("c0"), F.max("c").alias("c1"))
                    .where("c0 <> c1 and m > 2").select("key"))
    whole = rows.join(several_left, "key", "left_semi").join(classes.select("node", "left", "right"), "node")
    # The left half key of a bucket joins its members once for all buckets that share it.
    halves = F.filter(F.transform("left", lambda x, i: F.when(
        F.exists(F.transform("right", lambda y, j: F.xxhash64(i, j, x, y)), lambda k: k == F.col("key")), F.xxhash64(i, x))), lambda h: h.isNotNull())
    open_rows = materialize(whole.select(F.explode(halves).alias("key"), "node", "n", "c").distinct(), "open")
    links = links.union(materialize(_exact(open_rows, sets, percent), "links"))
    component = connected_components(links)

    label = member.join(component.withColumnRenamed("component", "c"), "node", "left").select("digest", F.coalesce("c", "node").alias("c"))
    joined = sketch.join(label, "digest", "left")
    component_id = F.when(F.col("id").isNotNull(), F.coalesce("c", "id"))
    return joined.select("id", F.col("n").alias("n_shingles"), component_id.alias("component_id"),
                         F.coalesce(F.col("id") == component_id, F.lit(True)).alias("kept"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` with one document of each group: that of the smallest id; of rows with that id one, by the hash of its text.

    Rows without an id all stay.
    """
    result = materialize(near_duplicates(docs, id_col, text_col, **options).where("kept and id is not null").select("id"), "kept")
    counts = result.groupBy("id").agg(F.count(F.lit(1)).alias("m"))
    once, more = counts.where("m = 1").select(F.col("id").alias(id_col)), counts.where("m > 1").select(F.col("id").alias(id_col))
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    first = (docs.join(_small(more), id_col, "left_semi").groupBy(F.col(id_col))
             .agg(F.min_by(row, F.coalesce(F.xxhash64(F.col(text_col)), F.lit(0))).alias("row")).select("row.*"))
    kept = docs.join(_small(once), id_col, "left_semi").unionByName(docs.where(F.col(id_col).isNull())).unionByName(first)
    return kept.select(*[F.col(f"`{c}`") for c in docs.columns])

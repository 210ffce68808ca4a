"""Removal of text that repeats across (or within) documents.

Units are lines, cut further at the ends of sentences, because shared passages
often sit inside a line; a sentence of more than ``span`` words (half of
``min_words``) is cut again after its anchors: of every ``span`` consecutive words
the longest (in bytes), of equally long ones the first in byte order, of equal
ones the last. So a cut depends on the
words near it alone, and a passage is cut alike wherever it stands but for at
most ``span`` words at each end.

What is compared are stretches of whole units: the shortest of at least
``min_words`` words from each unit on, and up to each end of a sentence; a text of
fewer words is one stretch. A stretch is normalised (lower case, no white space but
between words) and hashed to 128 bits, two polynomials of its words' digests. Digests are grouped globally, and
of equal stretches the earliest in the order (id, hash of the text, position)
stays. The others are removed, so what goes is covered by stretches that
occur word for word before: short sentences that repeat by chance leave a
document alone at any size of the corpus, every removed unit has an equal one
that stays, and no run of ``min_words + 2 * span`` or more words stays twice.
Removed ranges are returned with the offsets of the original text, in code
points.

Per digest only one row (its earliest occurrence) is formed, by partial
aggregation before the shuffle; the occurrences are joined with that row, and
AQE splits the occurrences of a hot digest. No digest's occurrences are
gathered.

Defined cases: null and empty texts have no units and stay as they are, and so do
white-space-only ones; white space belongs to the unit before it, at the start of
a text to the first; a null id ranks before others; rows with equal id and text
are one document and get the same result; a text of fewer words than
``min_words`` goes as a copy of a whole text only; an empty table stays empty;
other columns are kept as they are, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from encore.llm.common import as_texts, free_name, pieces
from encore.sources.tables import materialize


#: A task's tables at once: about so many bytes of text, or one text.
PIECE_BYTES = 1 << 20
SPANS = "array<struct<start:int,end:int>>"
_SOLID = ~np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
_BASES = (0x9E3779B97F4A7C15 | 7, 0xC2B2AE3D27D4EB4F | 5)


def _powers(base: int, n: int) -> np.ndarray:
    factors = np.full(n, base, np.uint64)
    factors[:1] = 1
    return np.cumprod(factors)


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """The least of every ``width`` consecutive values."""
    size = 1
    while 2 * size <= width:
        values = np.minimum(values[:-size], values[size:])
        size *= 2
    return np.minimum(values[:len(values) - (width - size)], values[width - size:])


def _words(texts: pa.Array):
    """The words of all texts: row, start, end (bytes), end of the white space after; number; rank and digest of the distinct ones."""
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, np.int64)[texts.offset:texts.offset + len(texts) + 1]
    raw = np.frombuffer(data if data is not None else b"", np.uint8)[offsets[0]:offsets[-1]]
    bounds = offsets - offsets[0]
    solid = _SOLID[raw]
    edge = np.zeros(len(raw) + 1, bool)
    edge[bounds] = True
    start = np.flatnonzero(solid & ~(np.concatenate([[False], solid[:-1]]) & ~edge[:-1]))
    end = np.flatnonzero(solid & ~(np.concatenate([solid[1:], [False]]) & ~edge[1:])) + 1
    row = np.repeat(np.arange(len(texts)), np.diff(np.searchsorted(start, bounds)))
    last = np.append(row[1:] != row[:-1], True)
    stop = np.where(last, bounds[row + 1], np.append(start[1:], 0))
    joined = pa.Array.from_buffers(pa.large_string(), len(start), [
        None, pa.py_buffer(np.concatenate([[0], np.cumsum(end - start)])), pa.py_buffer(raw[solid])]).dictionary_encode()
    lower = pc.utf8_lower(joined.dictionary)
    digests = np.frombuffer(b"".join([xxhash.xxh3_128_digest(w) for w in lower.cast(pa.large_binary()).to_pylist()]), ">u8")
    # Rank of each: the longest first, equally long ones in byte order.
    size, place = pc.binary_length(lower).to_numpy(zero_copy_only=False), pc.rank(lower, tiebreaker="dense").to_numpy(zero_copy_only=False)
    order = np.unique((size.max(initial=0) - size) * (len(lower) + 1) + place.astype(np.int64), return_inverse=True)[1].astype(np.int64)
    return raw, bounds, row, start, end, stop, last, joined.indices.to_numpy(zero_copy_only=False), order, digests.astype(np.uint64).reshape(-1, 2)


def stretches(texts: pa.Array, min_words: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(row, start, end, digest) of all stretches; offsets in code points, digests as two numbers."""
    if not pc.sum(pc.binary_length(texts)).as_py() or not min_words:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros((0, 2), np.int64)
    span = max(1, min_words // 2)
    raw, bounds, row, start, end, stop, last, codes, order, digests = _words(texts)
    n = len(row)
    lines = np.flatnonzero(raw == 10)
    ends = last | ((stop > end) & np.isin(raw[end - 1], np.frombuffer(b".!?", np.uint8))) | (
        np.searchsorted(lines, stop) > np.searchsorted(lines, end))
    cut = ends.copy()
    if n >= span:
        sentence = np.concatenate([[0], np.cumsum(ends)[:-1]])
        size = np.bincount(sentence)[sentence]
        key = (order[codes] << 32) | (0xFFFFFFFF - np.arange(n))  # the longest word's last place is the least
        inside = (sentence[:n - span + 1] == sentence[span - 1:]) & (size[:n - span + 1] > span)
        cut[0xFFFFFFFF - (_least(key, span)[inside] & 0xFFFFFFFF)] = True
    # Units: number of the last word, of the first; stretches [i, j] of units.
    final = np.flatnonzero(cut)
    first = np.concatenate([[0], final[:-1] + 1])[:len(final)]
    of, count = row[final], len(final)
    from_each = np.searchsorted(final, first + min_words - 1)
    i = np.flatnonzero(from_each < count)
    forward = i[of[from_each[i]] == of[i]]
    j = np.flatnonzero(ends[final])
    back = np.searchsorted(first, final[j] + 1 - min_words, side="right") - 1
    fits = (back >= 0) & (of[back] == of[j])
    heads = np.flatnonzero(np.append(True, of[1:] != of[:-1])[:count])
    tails = np.append(heads[1:] - 1, count - 1)[:len(heads)]
    short = final[tails] + 1 - first[heads] < min_words
    pairs = np.unique(np.concatenate([
        forward * count + from_each[forward], back[fits] * count + j[fits], heads[short] * count + tails[short]]))
    i, j = pairs // max(count, 1), pairs % max(count, 1)
    # A stretch's digest: its words' digests as a polynomial's coefficients, from sums over all words.
    found = np.empty((len(pairs), 2), np.uint64)
    for half, base in enumerate(_BASES):
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(digests[codes, half] * _powers(base, n))])
        found[:, half] = (sums[final[j] + 1] - sums[first[i]]) * _powers(pow(base, -1, 1 << 64), n)[first[i]]
    head = np.zeros(count, bool)
    head[heads] = True
    begin = np.where(head, bounds[of], stop[np.maximum(first - 1, 0)])[i]
    tails_of = stop[final[j]]
    inner = np.flatnonzero((raw & 0xC0) == 0x80)  # bytes that begin no code point
    base = bounds[of[i]] - np.searchsorted(inner, bounds[of[i]])
    return of[i], begin - np.searchsorted(inner, begin) - base, tails_of - np.searchsorted(inner, tails_of) - base, found.astype(np.int64)


def _stretch_rows(min_words: int):
    def run(batches):
        for batch in batches:
            texts = as_texts(batch.column("text"))
            for at, rows in pieces(texts, PIECE_BYTES):
                row, start, end, digest = stretches(texts.slice(at, rows), min_words)
                take = pa.array(row + at)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id").take(take), batch.column("version").take(take), pa.array(start, pa.int32()),
                     pa.array(end, pa.int32()), pa.array(digest[:, 0]), pa.array(digest[:, 1])],
                    names=["id", "version", "start", "end", "high", "low"])

    return run


def repeated_stretches(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = 25) -> DataFrame:
    """One row a document that has stretches which repeat earlier ones: id, version (hash of the text), stretches."""
    base = docs.where(F.length(text_col) > 0).select(
        F.col(id_col).alias("id"), F.xxhash64(text_col).alias("version"), F.col(text_col).alias("text"))
    id_type = dict(base.dtypes)["id"]
    found = base.mapInArrow(_stretch_rows(min_words), f"id {id_type}, version long, start int, end int, high long, low long")
    place = F.struct("id", "version", "start")
    # Written, so that the join below reads two plain shuffles: then AQE can split the occurrences of a hot digest.
    first = materialize(found.groupBy("high", "low").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("n"))
                        .where(F.col("n") > 1).select("high", "low", "first"), "firsts")
    again = found.join(first, ["high", "low"]).where(place > F.col("first"))
    return again.groupBy("id", "version").agg(F.collect_set(F.struct("start", "end")).alias("stretches"))


def merged(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The union of the ranges, as ranges that do not touch."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(ranges):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def _cut(arrays: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
    for texts, lists in arrays:
        kept, spans = [], []
        for text, found in zip(texts.to_pylist(), lists.to_pylist()):
            gone = merged([(s["start"], s["end"]) for s in found]) if text and found else []
            spans.append([{"start": a, "end": b} for a, b in gone])
            for a, b in reversed(gone):
                text = text[:a] + text[b:]
            kept.append(text)
        span = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
        yield pa.StructArray.from_arrays([pa.array(kept, pa.string()), pa.array(spans, span)], names=["text", "spans"])


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = 25) -> tuple[DataFrame, str]:
    """``docs`` and a struct column (its name is returned): text, what stays; spans, the removed ranges of the original."""
    listed = repeated_stretches(docs, id_col, text_col, min_words)
    name = free_name(docs, "repeats")
    cut = F.arrow_udf(_cut, f"text string, spans {SPANS}").asNondeterministic()
    joined = docs.join(listed, F.col(id_col).eqNullSafe(listed["id"]) & (F.xxhash64(text_col) == listed["version"]), "left")
    return joined.select(*[docs[c] for c in docs.columns], cut(docs[text_col], listed["stretches"]).alias(name)), name


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = 25,
                    length_col: str | None = None) -> DataFrame:
    """``docs`` with repeats cut out of the texts, same columns; documents of which nothing stays go.

    ``length_col`` names a column that holds the text's length and is set anew.
    """
    done, name = remove_repeats(docs, id_col, text_col, min_words)
    cut = F.size(F.col(name)["spans"]) > 0
    new = {text_col: F.col(name)["text"]}
    if length_col:
        new[length_col] = F.when(cut, F.length(F.col(name)["text"]).cast(dict(docs.dtypes)[length_col])).otherwise(F.col(length_col))
    return done.where(~cut | (F.trim(F.col(name)["text"]) != "")).select(*[new.get(c, F.col(c)).alias(c) for c in docs.columns])

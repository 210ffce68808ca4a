"""Language-model scores from a log-frequency Bloom filter.

Counting: tasks hash the training texts' tokens and token pairs, count them for
pieces of bounded size, and deal the counts into buckets of the hash. A bucket
adds up its counts and builds its own part of the filter: an n-gram of count c
is inserted once for every level 1 ... floor(log2 c) + 1, so the filter holds
the count's logarithm, and the highest level found by probing upward gives it
back. What a level stands for is the mean count of the n-grams that reached
it. The part's size follows the bucket's insertions (``bits`` each).

Scoring: the parts are sent to the tasks in segments of at most
``segment_bytes``; each segment is a pass over the texts in which every token
and pair of that segment is probed, level by level. With the levels of w, u
and (u, w), and estimates c^ of their counts::

    P(w | u) = (c^(u, w) + k P(w)) / (c^(u) + k),   P(w) = (c^(w) + 0.1) / (N + 0.1 (V + 1))

A pair is never counted more often than its words (this removes most false
positives). Words are runs of other characters than ASCII white space, ASCII
letters in lower case; a text is its words and an end, and the first word
follows an end.

The base score needs exact counts. The ``frequent`` most frequent words are
broadcast with theirs; the others are joined with the table of counts.

Defined cases: a null text is empty, and an empty text is one end token; with
no training text every token is unknown (N = V = 0); a null id counts as crc32
0 in the caller's split, and repeated rows are counted and scored as often as
they occur; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from encore.llm.common import SPACED, as_texts, pieces, words_of
from encore.llm.shingles import mix
from encore.sources.tables import materialize

END = np.uint64(xxhash.xxh64_intdigest(b""))
PIECE_BYTES = 8 << 20
#: Scoring keeps more arrays for each token, beside the filter.
SCORE_BYTES = 1 << 20
LEVELS = 62
_PAIR = np.uint64(0xD6E8FEB86659FD93)
_LEVEL = np.uint64(0xA0761D6478BD642F)
_PROBE = np.uint64(0xE7037ED1A0B428DB)
_PACKED = "bucket int, words binary, word_counts binary, pairs binary, pair_counts binary"
_PART = ("bucket int, bits long, filter binary, word_level_n array<long>, word_level_sum array<long>, pair_level_n array<long>, "
         "pair_level_sum array<long>, words array<long>, counts array<long>")


def tokens(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(token hashes with an end after every text, offsets of the texts' tokens)."""
    flat, starts = words_of(texts, SPACED)
    coded = flat.dictionary_encode()
    distinct = np.fromiter((xxhash.xxh64_intdigest(w) for w in coded.dictionary.cast(pa.large_binary()).to_pylist()),
                           np.uint64, len(coded.dictionary))
    out = np.full(len(flat) + len(texts), END, np.uint64)
    row = np.repeat(np.arange(len(texts)), np.diff(starts))
    if len(flat):
        out[np.arange(len(flat)) + row] = distinct[coded.indices.to_numpy()]
    return out, starts + np.arange(len(starts))


def pair_keys(token: np.ndarray) -> np.ndarray:
    """Key of (token before, token); an end stands before the first."""
    with np.errstate(over="ignore"):
        return mix(np.concatenate([[END], token[:-1]]).astype(np.uint64) * _PAIR + token)


def word_keys(token: np.ndarray) -> np.ndarray:
    return mix(token)


def _add_up(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys)
    keys, counts = keys[order], counts[order]
    if not len(keys):
        return keys, counts
    starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[starts], np.add.reduceat(counts, starts)


def _packer(bucket_bits: int):
    def cut(keys):
        return np.searchsorted(keys >> np.uint64(64 - bucket_bits), np.arange((1 << bucket_bits) + 1, dtype=np.uint64))

    def run(batches):
        for batch in batches:
            texts = as_texts(batch.column("text"))
            for start, rows in pieces(texts, PIECE_BYTES):
                token, _ = tokens(texts.slice(start, rows))
                words, n = np.unique(word_keys(token), return_counts=True)
                pairs, m = np.unique(pair_keys(token), return_counts=True)
                a, b = cut(words), cut(pairs)
                n, m = n.astype(np.uint32), m.astype(np.uint32)
                full = [k for k in range(1 << bucket_bits) if a[k] < a[k + 1] or b[k] < b[k + 1]]
                cols = [[x[s[k]:s[k + 1]].tobytes() for k in full] for x, s in ((words, a), (n, a), (pairs, b), (m, b))]
                yield pa.RecordBatch.from_arrays([pa.array(full, pa.int32()), *[pa.array(c, pa.binary()) for c in cols]],
                                                 names=["bucket", "words", "word_counts", "pairs", "pair_counts"])

    return run


def levels(counts: np.ndarray) -> np.ndarray:
    """floor(log2 count) + 1."""
    return np.frexp(counts.astype(np.float64))[1].astype(np.int64)


def positions(keys: np.ndarray, level, probe: int, bits) -> np.ndarray:
    """The bit that a probe of (key, level) looks at, in a part of ``bits`` bits (under 2^32)."""
    with np.errstate(over="ignore"):
        h = mix(keys + np.asarray(level).astype(np.uint64) * _LEVEL + np.uint64(probe) * _PROBE)
        return ((h >> np.uint64(32)) * np.asarray(bits).astype(np.uint64)) >> np.uint64(32)


def _builder(bits_each: int, probes: int):
    def insert(field, keys, level):
        for at in range(1, int(level.max(initial=0)) + 1):
            keys, level = keys[level >= at], level[level >= at]
            for p in range(probes):
                field[positions(keys, at, p, len(field))] = 1

    def build(key, table):
        def gathered(keys, counts):
            return _add_up(np.frombuffer(b"".join(table.column(keys).to_pylist()), np.uint64),
                           np.frombuffer(b"".join(table.column(counts).to_pylist()), np.uint32).astype(np.int64))

        words, n = gathered("words", "word_counts")
        pairs, m = gathered("pairs", "pair_counts")
        by_word, by_pair = levels(n), levels(m)
        size = -(-max(64, bits_each * int(by_word.sum() + by_pair.sum())) // 8) * 8
        if size >= 1 << 32:
            raise ValueError("a filter part of 2^32 bits; lower bucket_bytes")
        field = np.zeros(size, np.uint8)
        insert(field, words, by_word)
        insert(field, pairs, by_pair)
        sums = [np.bincount(lv, weights=w, minlength=LEVELS + 2).astype(np.int64).tolist()
                for lv, c in ((by_word, n), (by_pair, m)) for w in (None, c)]
        values = [key[0].as_py(), size, np.packbits(field).tobytes(), *sums, words.view(np.int64).tolist(), n.tolist()]
        names = ["bucket", "bits", "filter", "word_level_n", "word_level_sum", "pair_level_n", "pair_level_sum", "words", "counts"]
        longs = pa.list_(pa.int64())
        types = [pa.int32(), pa.int64(), pa.binary(), longs, longs, longs, longs, longs, longs]
        return pa.Table.from_arrays([pa.array([v], t) for v, t in zip(values, types)], names=names)

    return build


@dataclass
class NgramModel:
    """``parts``: table of the filter's parts and exact word counts; the rest are sums of bounded size."""

    parts: DataFrame
    buckets: list[tuple[int, int]]  # (bucket, bits)
    bucket_bits: int
    probes: int
    train_tokens: int
    train_words: int
    word_means: list[float]
    pair_means: list[float]

    def counts(self) -> DataFrame:
        """(word key, count) of all words of the training texts."""
        return self.parts.select(F.inline(F.arrays_zip(F.col("words").alias("word"), F.col("counts").alias("count"))))


def fit(train: DataFrame, text_col: str = "text", bits: int = 10, probes: int = 5, bucket_bytes: int = 8 << 20) -> NgramModel:
    """Count ``train`` and build the filter; a bucket takes the counts of about ``bucket_bytes`` of text."""
    base = train.select(F.col(text_col).cast("string").alias("text"))
    size = base.agg(F.sum(F.octet_length("text")).alias("b")).first()["b"] or 0
    bucket_bits = max(4, math.ceil(math.log2(max(1, size / bucket_bytes))))
    packed = base.mapInArrow(_packer(bucket_bits), _PACKED)
    parts = materialize(packed.groupBy("bucket").applyInArrow(_builder(bits, probes), _PART), "ngrams")
    buckets = [(r["bucket"], r["bits"]) for r in parts.select("bucket", "bits").orderBy("bucket").collect()]
    index = [F.array(*[F.coalesce(F.sum(F.col(c)[i]), F.lit(0)) for i in range(LEVELS + 2)]).alias(c)
             for c in ("word_level_n", "word_level_sum", "pair_level_n", "pair_level_sum")]
    sums = parts.agg(*index, F.coalesce(F.sum(F.size("words")), F.lit(0)).alias("v")).first()
    means = [[s / n if n else 0.0 for n, s in zip(sums[f"{k}_level_n"], sums[f"{k}_level_sum"])] for k in ("word", "pair")]
    return NgramModel(parts, buckets, bucket_bits, probes, int(sum(sums["word_level_sum"])), int(sums["v"]), *means)


class Filter:
    """A segment of the filter, in a task."""

    def __init__(self, parts: list[tuple[int, int]], data: bytes, bucket_bits: int, probes: int):
        """``parts``: (bucket, bits) in the order of their bytes in ``data``."""
        count = 1 << bucket_bits
        self.shift, self.probes = np.uint64(64 - bucket_bits), probes
        self.bits, self.base = np.zeros(count, np.uint64), np.zeros(count, np.uint64)
        at = 0
        for bucket, bits in parts:
            self.bits[bucket], self.base[bucket] = bits, at
            at += bits
        self.data = np.frombuffer(data, np.uint8)

    def levels(self, keys: np.ndarray) -> np.ndarray:
        """The highest level up to which every level is found; 0 for keys not found, or not of this segment."""
        out = np.zeros(len(keys), np.uint8)
        bucket = (keys >> self.shift).astype(np.int64)
        live = np.flatnonzero(self.bits[bucket] > 0)
        for level in range(1, LEVELS + 1):
            for p in range(self.probes):
                place = self.base[bucket[live]] + positions(keys[live], level, p, self.bits[bucket[live]])
                hit = (self.data[(place >> np.uint64(3)).astype(np.int64)] >> (np.uint64(7) - (place & np.uint64(7))).astype(np.uint8)) & 1
                live = live[hit == 1]
            if not len(live):
                break
            out[live] = level
        return out


def _found(part: Filter, token: np.ndarray, out: np.ndarray) -> np.ndarray:
    """Levels (2, tokens) of each token and of its pair; with those of earlier segments."""
    for k, keys in enumerate((word_keys(token), pair_keys(token))):
        distinct, at = np.unique(keys, return_inverse=True)
        out[k] = np.maximum(out[k], part.levels(distinct)[at])
    return out


def _earlier(codes: pa.Array, starts: np.ndarray) -> np.ndarray:
    """The stored levels of a run of texts."""
    out = np.zeros((2, int(starts[-1])), np.uint8)
    for a, b, c in zip(starts[:-1], starts[1:], codes.to_pylist()):
        if c is not None:
            out[:, a:b] = np.frombuffer(c, np.uint8).reshape(2, -1)
    return out


def _probe_pass(shared, bucket_bits: int, probes: int):
    """A pass over texts and stored levels that adds a segment's levels."""

    def probe(arrays: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        part = Filter(*shared.value, bucket_bits, probes)
        for raw, codes in arrays:
            texts, out = as_texts(raw), []
            for start, rows in pieces(texts, SCORE_BYTES):
                token, starts = tokens(texts.slice(start, rows))
                found = _found(part, token, _earlier(codes.slice(start, rows), starts))
                out += [found[:, a:b].tobytes() for a, b in zip(starts[:-1], starts[1:])]
            yield pa.array(out, pa.binary())

    return F.arrow_udf(probe, "binary").asNondeterministic()


_SCORED = "n_tokens long, n_known long, known_sum double, score double, words array<long>, times array<long>"


def _score_pass(shared, frequent, bucket_bits: int, probes: int, total: int, vocabulary: int, means, prior: float):
    """The last segment's pass: also the scores, and the tokens whose exact count is to be joined."""

    def score(arrays: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        part = Filter(*shared.value, bucket_bits, probes)
        known, counts = (np.frombuffer(x, t) for x, t in zip(frequent.value, (np.uint64, np.int64)))
        word_mean, pair_mean = (np.array(m) for m in means)
        mass = total + 0.1 * (vocabulary + 1)
        for raw, codes in arrays:
            texts, done = as_texts(raw), []
            for start, rows in pieces(texts, SCORE_BYTES):
                token, starts = tokens(texts.slice(start, rows))
                found = _found(part, token, _earlier(codes.slice(start, rows), starts))
                history = np.concatenate([[0], found[0][:-1]])
                history[starts[:-1]] = int(found[0][starts[1:] - 1].max(initial=0))  # the end's level: every text closes with one
                pair = np.minimum(found[1], np.minimum(found[0], history))
                single = (word_mean[found[0]] + 0.1) / mass
                past = word_mean[history]
                logp = np.log10((np.minimum(pair_mean[pair], past) + prior * single) / (past + prior))
                keys = word_keys(token)
                place = np.minimum(np.searchsorted(known, keys), max(len(known) - 1, 0))
                exact = known[place] == keys if len(known) else np.zeros(len(keys), bool)
                logc = np.log10(np.where(exact, counts[place] if len(known) else 0, 0) + 0.1) * exact
                sums = [np.add.reduceat(x, starts[:-1]) for x in (logp, logc, exact.astype(np.int64))]
                rest = np.flatnonzero(~exact)
                cut = np.searchsorted(rest, starts)
                for r in range(rows):
                    words, times = np.unique(keys[rest[cut[r]:cut[r + 1]]].view(np.int64), return_counts=True)
                    done.append((int(starts[r + 1] - starts[r]), int(sums[2][r]), float(sums[1][r]), float(sums[0][r]), words, times))
            cols = list(zip(*done)) or [()] * 6
            types = [pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.list_(pa.int64()), pa.list_(pa.int64())]
            yield pa.StructArray.from_arrays([pa.array(c, t) for c, t in zip(cols, types)],
                                             names=["n_tokens", "n_known", "known_sum", "score", "words", "times"])

    return F.arrow_udf(score, _SCORED).asNondeterministic()


def _segments(model: NgramModel, segment_bytes: int) -> list[list[int]]:
    """Runs of buckets of at most ``segment_bytes`` of filter each (a larger bucket is a run of its own)."""
    out, size = [], 0
    for bucket, bits in model.buckets:
        if not out or size + bits // 8 > segment_bytes:
            out.append([])
            size = 0
        out[-1].append(bucket)
        size += bits // 8
    return out or [[]]


def _frequent(model: NgramModel, most: int) -> tuple[int, list]:
    """(threshold, rows): the words counted at least ``threshold`` times, at most ``most`` of them."""
    # Counts by their float's leading bits: some hundred classes, so the threshold needs no sort of all words.
    step = F.floor(F.log2(F.col("count").cast("double")) * 8).cast("int").alias("step")
    sizes = model.counts().groupBy(step).agg(F.count(F.lit(1)).alias("n"), F.min("count").alias("least")).orderBy(F.desc("step")).collect()
    threshold, total = (1 << 62), 0
    for r in sizes:
        if total + r["n"] > most:
            break
        threshold, total = r["least"], total + r["n"]
    table = model.counts().where(F.col("count") >= threshold).toArrow()
    words = table.column("word").to_numpy().view(np.uint64)
    order = np.argsort(words)
    return threshold, [words[order].tobytes(), table.column("count").to_numpy()[order].astype(np.int64).tobytes()]


def score(spark: SparkSession, docs: DataFrame, model: NgramModel, id_col: str = "doc_id", text_col: str = "text",
          prior: float = 200.0, frequent: int = 1 << 20, segment_bytes: int = 256 << 20) -> DataFrame:
    """One row a document: id, n_tokens, n_known, train_tokens, base_score, score (both log10 probabilities)."""
    context = spark.sparkContext
    threshold, rows = _frequent(model, frequent)
    segments = _segments(model, segment_bytes)

    def load(segment):
        parts = model.parts.where(F.col("bucket").isin(segment)) if segment else model.parts.limit(0)
        rows = [(r["bucket"], r["bits"], r["filter"]) for r in parts.select("bucket", "bits", "filter").toLocalIterator()]
        return context.broadcast(([r[:2] for r in rows], b"".join(r[2] for r in rows)))  # one buffer, which tasks read in place

    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"), F.lit(None).cast("binary").alias("codes"))
    for segment in segments[:-1]:
        probe = _probe_pass(load(segment), model.bucket_bits, model.probes)
        texts = materialize(texts.withColumn("codes", probe("text", "codes")), "levels")
    last = _score_pass(load(segments[-1]), context.broadcast(rows), model.bucket_bits, model.probes, model.train_tokens,
                       model.train_words, (model.word_means, model.pair_means), prior)
    scored = materialize(texts.select("id", last("text", "codes").alias("s")).select(
        "id", "s.*", F.monotonically_increasing_id().alias("row")), "scores")
    rare = (scored.select("row", F.inline(F.arrays_zip(F.col("words").alias("word"), F.col("times").alias("times"))))
            .join(model.counts().where(F.col("count") < threshold), "word", "left")
            .groupBy("row").agg(F.sum(F.col("times") * F.log10(F.coalesce("count", F.lit(0)) + F.lit(0.1))).alias("rare_sum"),
                                F.sum(F.when(F.col("count").isNotNull(), F.col("times")).otherwise(0)).alias("rare_known")))
    mass = model.train_tokens + 0.1 * (model.train_words + 1)
    return scored.join(rare, "row", "left").select(
        "id", "n_tokens", (F.col("n_known") + F.coalesce("rare_known", F.lit(0))).alias("n_known"),
        F.lit(model.train_tokens).cast("long").alias("train_tokens"),
        (F.col("known_sum") + F.coalesce("rare_sum", F.lit(0.0)) - F.col("n_tokens") * F.lit(math.log10(mass))).alias("base_score"), "score")

"""Benchmark decontamination with an FM-index over each shard of the corpus.

Test phrases are windows of 13 consecutive words of the benchmark items. A
task cuts its documents into shards of bounded size and builds, for each
shard, a suffix array over word numbers, its Burrows-Wheeler transform and a
wavelet matrix of that. All windows are searched backward together through the
matrix' ranks; occurrences are located by walking to sampled suffix positions;
their ranges are merged for each document.

The alphabet is the benchmark's own words. Words foreign to it cannot be part
of an occurrence, so a run of them is one separator, and runs of benchmark
words shorter than the shortest window are left out of the index: neither
changes an answer.

The windows are dealt into blocks of bounded bytes by their hash; each block
is sent to all tasks in turn, and a pass over the corpus adds its findings to
those before, so the benchmark may be of any size. Documents are never
shuffled.

Defined cases: a null or wordless text has no words and is never hit; an item
without words is ignored; a null item id counts as the empty string; items
with equal ids are one item; an empty benchmark hits nothing; repeated rows
are judged alike; other columns are kept as they are, whatever their names.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from encore.llm.common import ALPHANUMERIC, as_texts, free_name, pieces, words_of
from encore.sources.tables import delete_path, materialize

WINDOW_WORDS = 13
WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
RESULT = "n_words long, n_hit long, spans array<struct<start:long,end:long>>, items array<string>"
_SPAN = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))


class FmIndex:
    """FM-index of a sequence of symbols 0 ... size-1, where each 0 is a separator of its own."""

    def __init__(self, symbols: np.ndarray, size: int, sample: int = 8):
        symbols = np.append(symbols, 0)  # the end, before which the last symbol stands in the transform
        n = len(symbols)
        self.n = n
        order, bwt = self._suffixes(symbols)
        self.bwt = bwt
        self.first = np.concatenate([[0], np.cumsum(np.bincount(symbols, minlength=size))])  # rows before each symbol's
        # Sampled positions: every sample-th, and those after a separator, where a backward walk has to end.
        kept = (order % sample == 0) | (bwt == 0)
        self.sampled = kept
        self.positions = order[kept]
        self.sample_rank = np.concatenate([[0], np.cumsum(kept)])
        # Wavelet matrix: for each bit from the highest, ones before each place, and the zeros in all.
        self.levels = []
        current = bwt
        for bit in range(max(1, int(size - 1).bit_length()) - 1, -1, -1):
            ones = (current >> bit) & 1
            self.levels.append((bit, np.concatenate([[0], np.cumsum(ones)]).astype(np.int32), int(n - ones.sum())))
            current = np.concatenate([current[ones == 0], current[ones == 1]])

    @staticmethod
    def _suffixes(symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Suffix array by prefix doubling, and the transform. Separators differ, so equal prefixes end at them."""
        n = len(symbols)
        separators = symbols == 0
        rank = np.where(separators, np.cumsum(separators) - 1, separators.sum() + symbols.astype(np.int64))
        order = np.argsort(rank, kind="stable")
        step = 1
        while True:
            sorted_rank = rank[order]
            fresh = np.empty(n, np.int64)
            fresh[order] = np.cumsum(np.concatenate([[0], sorted_rank[1:] != sorted_rank[:-1]])) if n else 0
            rank = fresh
            if n == 0 or rank[order[-1]] == n - 1:
                break
            following = np.zeros(n, np.int64)
            following[:n - step] = rank[step:] + 1
            rank = rank * (n + 1) + following
            order = np.argsort(rank, kind="stable")
            step *= 2
        bwt = np.where(order > 0, symbols[order - 1], 0).astype(np.int64)
        return order, bwt

    def rank(self, symbol: np.ndarray, row: np.ndarray) -> np.ndarray:
        """How often each symbol occurs in the transform before each row."""
        begin = np.zeros(len(row), np.int64)
        end = row.astype(np.int64)
        for bit, ones, zeros in self.levels:
            up = ((symbol >> bit) & 1).astype(bool)
            b, e = ones[begin], ones[end]
            begin = np.where(up, zeros + b, begin - b)
            end = np.where(up, zeros + e, end - e)
        return end - begin

    def search(self, patterns: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Row ranges [low, high) of the patterns (rows of an array, filled up on the right)."""
        low, high = np.zeros(len(patterns), np.int64), np.full(len(patterns), self.n, np.int64)
        live = np.arange(len(patterns))
        for step in range(int(lengths.max(initial=0))):
            live = live[(lengths[live] > step) & (low[live] < high[live])]
            if not len(live):
                break
            symbol = patterns[live, lengths[live] - 1 - step]
            low[live] = self.first[symbol] + self.rank(symbol, low[live])
            high[live] = self.first[symbol] + self.rank(symbol, high[live])
        return low, np.maximum(low, high)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Positions of the suffixes at the rows."""
        rows, walked, out = rows.copy(), np.zeros(len(rows), np.int64), np.empty(len(rows), np.int64)
        live = np.arange(len(rows))
        while len(live):
            found = self.sampled[rows[live]]
            at = live[found]
            out[at] = self.positions[self.sample_rank[rows[at]]] + walked[at]
            live = live[~found]
            symbol = self.bwt[rows[live]]
            rows[live] = self.first[symbol] + self.rank(symbol, rows[live])
            walked[live] += 1
        return out


class Phrases:
    """A block of test phrases: vocabulary, phrases as word numbers from 1, and the items of each."""

    def __init__(self, rows: list[tuple[str, str]]):
        texts = sorted({w for w, _ in rows})
        number = {w: i for i, w in enumerate(texts)}
        items: list[set[str]] = [set() for _ in texts]
        for w, item in rows:
            items[number[w]].add(item)
        split = [w.split(" ") for w in texts]
        self.vocabulary = sorted({x for words in split for x in words})
        code = {x: i + 1 for i, x in enumerate(self.vocabulary)}
        self.lengths = np.array([len(words) for words in split], np.int64)
        self.patterns = np.zeros((len(split), int(self.lengths.max(initial=1))), np.int64)
        for i, words in enumerate(split):
            self.patterns[i, :len(words)] = [code[x] for x in words]
        self.items = [sorted(x) for x in items]

    def occurrences(self, codes: np.ndarray, boundaries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(first word, phrase) of every occurrence in the words; none crosses a boundary (offset of a text's first word)."""
        symbols, origin = self._compact(codes, boundaries)
        if not len(symbols) or not len(self.lengths):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        index = FmIndex(symbols, len(self.vocabulary) + 1)
        low, high = index.search(self.patterns, self.lengths)
        counts = high - low
        phrase = np.repeat(np.arange(len(counts)), counts)
        rows = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts) + np.repeat(low, counts)
        return origin[index.locate(rows)], phrase

    def _compact(self, codes: np.ndarray, boundaries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The runs of known words, long enough for the shortest phrase, each after a separator; and their words' places."""
        n = len(codes)
        if not n:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        known = codes > 0
        begins = known & ~np.concatenate([[False], known[:-1]])
        starts = boundaries[(boundaries >= 0) & (boundaries < n)]
        begins[starts[known[starts]]] = True
        run = np.cumsum(begins) * known  # number of the run, from 1; 0 for foreign words
        sizes = np.bincount(run, minlength=1)
        sizes[0] = 0
        places = np.flatnonzero(sizes[run] >= int(self.lengths.min(initial=1)))
        places = places[known[places]]
        new = np.concatenate([[True], run[places][1:] != run[places][:-1]]) if len(places) else np.zeros(0, bool)
        at = np.arange(len(places)) + np.cumsum(new)
        symbols, origin = np.zeros(len(places) + int(new.sum()), np.int64), np.zeros(len(places) + int(new.sum()), np.int64)
        symbols[at], origin[at] = codes[places], places
        return symbols, origin


def windows(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text", window_words: int = WINDOW_WORDS) -> DataFrame:
    """Distinct (window, item): each run of ``window_words`` words of an item; a shorter item is one window."""

    def run(batches):
        for batch in batches:
            texts = as_texts(batch.column("text"))
            flat, starts = words_of(texts, ALPHANUMERIC)
            flat = flat.to_pylist()
            found, rows = [], []
            for row in range(len(texts)):
                words = flat[starts[row]:starts[row + 1]]
                for i in range(max(1, len(words) - window_words + 1) if words else 0):
                    found.append(" ".join(words[i:i + window_words]))
                    rows.append(row)
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.string()), batch.column("item").take(pa.array(rows, pa.int32()))], names=["window", "item"])

    base = benchmark.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("item"), F.col(text_col).cast("string").alias("text"))
    return base.mapInArrow(run, "window string, item string").distinct()


def _searcher(shared, shard_bytes: int):
    def search(arrays: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        phrases = Phrases(shared.value)
        vocabulary = pa.array(phrases.vocabulary, pa.large_string())
        for raw, before in arrays:
            texts = as_texts(raw)
            done = []
            for start, rows in pieces(texts, shard_bytes):
                flat, starts = words_of(texts.slice(start, rows), ALPHANUMERIC)
                codes = pc.fill_null(pc.index_in(flat, value_set=vocabulary), -1).to_numpy(zero_copy_only=False).astype(np.int64) + 1
                first, phrase = phrases.occurrences(codes, starts[:-1])
                done += _shard_results(phrases, first, phrase, starts, before.slice(start, rows).to_pylist())
            cols = list(zip(*done)) or [()] * 4
            yield pa.StructArray.from_arrays(
                [pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()), pa.array(cols[2], _SPAN), pa.array(cols[3], pa.list_(pa.string()))],
                names=["n_words", "n_hit", "spans", "items"])

    return F.arrow_udf(search, RESULT).asNondeterministic()


def _shard_results(phrases: Phrases, first, phrase, starts, before: list):
    """For each text: words, hit words, merged word ranges, items; with what earlier blocks found."""
    row = np.searchsorted(starts, first, side="right") - 1
    order = np.lexsort((first, row))
    first, phrase, row = first[order], phrase[order], row[order]
    cuts = np.searchsorted(row, np.arange(len(starts)))
    out = []
    for r in range(len(starts) - 1):
        begin = int(starts[r])
        spans = [(s["start"], s["end"]) for s in before[r]["spans"]] if before[r] else []
        items = set(before[r]["items"]) if before[r] else set()
        if cuts[r] < cuts[r + 1]:
            own = slice(cuts[r], cuts[r + 1])
            a = first[own] - begin
            e = np.maximum.accumulate(a + phrases.lengths[phrase[own]])
            new = np.concatenate([[True], a[1:] > e[:-1]])
            last = np.concatenate([np.flatnonzero(new)[1:], [len(a)]]) - 1
            spans += list(zip(a[new].tolist(), e[last].tolist()))
            for p in np.unique(phrase[own]).tolist():
                items.update(phrases.items[p])
        merged: list[list[int]] = []
        for s, e in sorted(spans):
            if merged and s <= merged[-1][1]:
                merged[-1][1] = max(e, merged[-1][1])
            else:
                merged.append([s, e])
        out.append((int(starts[r + 1]) - begin, sum(e - s for s, e in merged), [{"start": s, "end": e} for s, e in merged], sorted(items)))
    return out


def find_contamination(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_id_col: str = "item_id",
                       item_text_col: str = "text", window_words: int = WINDOW_WORDS, block_bytes: int = 32 << 20,
                       shard_bytes: int = 8 << 20) -> tuple[DataFrame, str]:
    """``docs`` and a struct column (its name is returned): n_words, n_hit, spans (of words, to remove), items.

    One pass over the corpus for each block of about ``block_bytes`` of windows. All but the last are written
    with their findings, and then the block's phrases and the table before are deleted: one block is alive at a time.
    """
    spark = docs.sparkSession
    table = materialize(windows(benchmark, item_id_col, item_text_col, window_words), "windows")
    total = table.agg(F.sum(F.octet_length("window") + F.octet_length("item") + 64).alias("b")).first()["b"] or 0
    blocks = max(1, math.ceil(total / block_bytes))
    name = free_name(docs, "contamination")
    found = docs.withColumn(name, F.lit(None).cast(
        "struct<n_words:long,n_hit:long,spans:array<struct<start:long,end:long>>,items:array<string>>"))
    written: list[str] = []
    for block in range(blocks):
        rows = [(r["window"], r["item"]) for r in table.where(F.pmod(F.xxhash64("window"), F.lit(blocks)) == block).collect()]
        sent = spark.sparkContext.broadcast(rows)
        found = found.withColumn(name, _searcher(sent, shard_bytes)(F.col(text_col), F.col(name)))
        if block + 1 < blocks:
            found = materialize(found, "findings", written=written)
            sent.destroy()
            while len(written) > 1:  # read for the last time
                delete_path(spark, written.pop(0))
    return found, name


def contaminated(n_words, n_hit):
    """At least a twentieth of the words are hit."""
    return (n_hit > 0) & (F.lit(20) * n_hit >= n_words)


def char_spans(text: str, spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Word ranges as code point ranges of the text."""
    at = [m.span() for m in WORD.finditer(text)]
    return [(at[a][0], at[b - 1][1]) for a, b in spans]


def remove_spans(text_col: str, found: str):
    """A column expression: the text without the words of its spans."""

    def cut(arrays: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for texts, results in arrays:
            out = []
            for text, result in zip(texts.to_pylist(), results.to_pylist()):
                for a, b in reversed(char_spans(text, [(s["start"], s["end"]) for s in result["spans"]]) if text and result["spans"] else []):
                    text = text[:a] + text[b:]
                out.append(text)
            yield pa.array(out, pa.string())

    return F.arrow_udf(cut, "string").asNondeterministic()(F.col(text_col), F.col(found))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", **options) -> DataFrame:
    """``docs`` without the contaminated documents; same columns."""
    found, name = find_contamination(docs, benchmark, text_col, **options)
    return found.where(~contaminated(F.col(name)["n_words"], F.col(name)["n_hit"])).drop(name)

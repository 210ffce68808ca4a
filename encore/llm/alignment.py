"""Alignment of two tokenizations of a text, by divide and conquer at shared cuts.

Tokenizer A is a byte-level BPE (a ``tokenizers`` file) over space + text, B a
sentencepiece model over the text, to which it adds the space. Places where a
token of A and one of B both end cut the text into groups. An interval is cut at
such a place near the middle of A's tokens, found by bisecting B's ends and going
on outwards from there; both halves are treated alike, and intervals without an
inner shared end are the groups. All intervals of a level, of all texts of a
piece, are worked on at once.

A link is a pair of overlapping token occurrences. Between two neighbouring ends
(of either side) lies exactly one link, so a text has ends(A or B) links. Pairs of
ids are counted over the whole corpus: by tasks, then by Spark.

Tokens are made once for each distinct word that a worker meets: both tokenizers
work on stretches that end before a space that follows a non-space, each for
itself, which ``Pair`` checks of the vocabularies when it loads them. A text
whose tokens' bytes differ from space + text (in either tokenization), a null and
an empty text have no tokens: zeros, and no groups. Repeated rows, and repeated
or null ids, are rows of their own. A text is handled whole in one task. Other
columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from array import array
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from encore.llm.common import as_texts, pieces
from encore.sources.tables import materialize

TOKENIZERS = "/opt/tokenizers"
PIECE_BYTES = 2 << 20
#: A worker keeps the tokens of so many distinct stretches (some 200 bytes each) before it begins anew.
KEPT_STRETCHES = 300_000
#: A row of pair counts holds so many pairs at most.
COUNTS_ROW = 1 << 14
#: Pair counts are broadcast up to this many pairs (13 bytes each, some 50 in a hash table); beyond, they are joined by a shuffle.
BROADCAST_PAIRS = 4_000_000
#: Last bytes of white space characters beyond ASCII: no stretch ends after one of these.
_WIDE_SPACE = np.isin(np.arange(256), [0x80, 0x81, 0x82, 0x83, 0x84, 0x85, 0x86, 0x87, 0x88, 0x89, 0x8A, 0x9F, 0xA0, 0xA8, 0xA9, 0xAF])
_NOT_SOLID = np.isin(np.arange(256), [*range(0x09, 0x0E), *range(0x1C, 0x21)]) | _WIDE_SPACE


def byte_alphabet() -> dict[str, int]:
    """The characters that stand for bytes in a byte-level vocabulary."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


def _piece_bytes(piece: str) -> bytes:
    found = re.fullmatch(r"<0x([0-9A-F]{2})>", piece)
    return bytes([int(found[1], 16)]) if found else piece.replace("▁", " ").encode()


class Pair:
    """Both tokenizers and their tokens' bytes; loaded once a worker."""

    def __init__(self, folder: str):
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(f"{folder}/byte_bpe_50k.json")
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=f"{folder}/piece_bpe_32k.model")
        alphabet = byte_alphabet()
        vocab = self.a.get_vocab(with_added_tokens=True)
        self.bytes_a: list[bytes] = [b""] * (max(vocab.values()) + 1)
        for token, i in vocab.items():
            self.bytes_a[i] = bytes(alphabet[c] for c in token) if all(c in alphabet for c in token) else token.encode()
        self.bytes_b = [_piece_bytes(self.b.id_to_piece(i)) for i in range(self.b.get_piece_size())]
        self.size_b = len(self.bytes_b)
        self.space_b = [self.b.piece_to_id("▁")]
        #: No token of B goes on with a space after something else, so B's merges stay inside stretches.
        self.cuttable = not any(re.search(r"[^▁]▁", self.b.id_to_piece(i)) for i in range(self.size_b))
        self.len_a = np.array([len(x) for x in self.bytes_a], np.int64)
        self.len_b = np.array([len(x) for x in self.bytes_b], np.int64)
        text = lambda n, mark: pa.array([f"{i}{mark}" for i in range(n)], pa.large_binary())
        n = max(len(self.bytes_a), self.size_b)
        #: Ids in decimal with what follows them: ``,`` inside a side, ``|`` after A's side, ``;`` after the group.
        self.shown = pa.concat_arrays([text(n, ","), text(n, "|"), text(n, ";")])
        self.shown_n = n
        self.forget()

    def forget(self) -> None:
        self.known: dict[str, int] = {}
        self.ids = array("i"), array("i")       # of A and of B, of one known stretch after the other
        self.ends = array("q", [0]), array("q", [0])
        self.whole = bytearray()

    def codes(self, stretches: list[str]) -> np.ndarray:
        """Numbers of the stretches; new ones are tokenized."""
        if len(self.known) > KEPT_STRETCHES:
            self.forget()
        new = [s for s in stretches if s not in self.known]
        first, held = len(self.whole), self.encode(new)
        self.known.update(zip(new, range(first, first + len(new))))
        for ids, ends, own in zip(self.ids, self.ends, held):
            ends.extend((np.cumsum(np.fromiter(map(len, own), np.int64, len(own))) + len(ids)).tolist())
            ids.extend(chain.from_iterable(own))
        self.whole.extend([1] * len(new) if self._all_exact(new, held) else map(self.exact, new, *held))
        return np.fromiter(map(self.known.__getitem__, stretches), np.int64, len(stretches))

    def encode(self, stretches: list[str]) -> tuple[list[list[int]], list[list[int]]]:
        """Ids of A and of B for texts that begin with a space."""
        a = [e.ids for e in self.a.encode_batch_fast(stretches, add_special_tokens=False)]
        b = self.b.encode([s[1:] for s in stretches], num_threads=1)
        # The empty text alone gets no space from B.
        return a, [self.space_b if s == " " else x for s, x in zip(stretches, b)]

    def _all_exact(self, stretches: list[str], held: tuple[list[list[int]], list[list[int]]]) -> bool:
        raw = pa.array(stretches, pa.large_string())
        sizes = pc.binary_length(raw).to_numpy()
        joined = "".join(stretches).encode()
        for own, known, length in zip(held, (self.bytes_a, self.bytes_b), (self.len_a, self.len_b)):
            ids = np.fromiter(chain.from_iterable(own), np.int64)
            ends = np.concatenate([[0], np.cumsum(length[ids])])[np.cumsum(np.fromiter(map(len, own), np.int64, len(own)))]
            if not np.array_equal(ends, np.cumsum(sizes)) or b"".join(map(known.__getitem__, ids.tolist())) != joined:
                return False
        return True

    def exact(self, stretch: str, a: list[int], b: list[int]) -> bool:
        raw = stretch.encode()
        return b"".join(map(self.bytes_a.__getitem__, a)) == raw == b"".join(map(self.bytes_b.__getitem__, b))


@lru_cache(maxsize=1)
def load_pair(folder: str) -> Pair:
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return Pair(folder)


@dataclass
class Tokens:
    """One side's tokens of a row of texts: ids, the place in all bytes where each ends, and where each text's tokens begin."""
    ids: np.ndarray
    ends: np.ndarray
    starts: np.ndarray


def _spread(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The places start, start + 1, ... of each run, one run after the other."""
    before = np.concatenate([[0], np.cumsum(sizes)])[:-1]
    return np.repeat(starts - before, sizes) + np.arange(int(sizes.sum()))


def tokenize(pair: Pair, texts: pa.Array) -> tuple[Tokens, Tokens]:
    """Tokens of all texts (a large string array, no nulls); those without an exact tokenization have none."""
    spaced = pc.binary_join_element_wise(pa.scalar("", pa.large_string()), texts, pa.scalar(" ", pa.large_string())) if len(texts) else texts
    _, offsets, data = spaced.buffers()
    offsets = np.frombuffer(offsets, np.int64)[spaced.offset:spaced.offset + len(spaced) + 1] if len(spaced) else np.zeros(1, np.int64)
    raw = np.frombuffer(data, np.uint8)[offsets[0]:offsets[-1]] if data is not None else np.zeros(0, np.uint8)
    offsets = offsets - offsets[0]
    # A stretch begins with each text, and at a space after a solid character.
    begins = np.zeros(len(raw) + 1, bool)
    if pair.cuttable and len(raw):
        begins[1:-1] = (raw[1:] == 0x20) & ~_NOT_SOLID[raw[:-1]]
    begins[offsets] = True
    cuts = np.flatnonzero(begins)
    stretches = pa.Array.from_buffers(pa.large_string(), len(cuts) - 1, [None, pa.py_buffer(cuts.astype(np.int64)), pa.py_buffer(raw.tobytes())])
    coded = stretches.dictionary_encode()
    index = pair.codes(coded.dictionary.to_pylist())[coded.indices.to_numpy()]
    whole = np.array(pair.whole, bool)
    first = np.searchsorted(cuts[:-1], offsets)  # each text's first stretch
    bad = np.concatenate([[0], np.cumsum(~whole[index])])
    empty = offsets[1:] - offsets[:-1] <= 1
    good = np.repeat((bad[first[1:]] == bad[first[:-1]]) & ~empty, first[1:] - first[:-1])
    out = []
    for ids, at, sizes in zip(pair.ids, pair.ends, (pair.len_a, pair.len_b)):
        ids, at = np.array(ids, np.int64), np.array(at, np.int64)
        n = np.where(good, (at[1:] - at[:-1])[index], 0)
        token = ids[_spread(at[:-1][index], n)]
        starts = np.concatenate([[0], np.cumsum(n)])[first]
        # Exact stretches begin where the bytes before them end; the others' bytes are skipped.
        length = sizes[token]
        ends = np.cumsum(length)
        skipped = np.concatenate([[0], np.cumsum(np.where(good, 0, np.diff(cuts)))])[:-1]
        out.append(Tokens(token, ends + np.repeat(skipped, n), starts))
    return out[0], out[1]


def shared_cuts(a: np.ndarray, b: np.ndarray, lo_a: np.ndarray, hi_a: np.ndarray, lo_b: np.ndarray, hi_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places (in a, in b) of the last tokens of all groups, in order.

    ``a`` and ``b`` hold rising ends; interval i is the tokens [lo_a, hi_a) and
    [lo_b, hi_b), whose last ends are the same.
    """
    found_a, found_b = [], []
    solid = (hi_a > lo_a) & (hi_b > lo_b)
    lo_a, hi_a, lo_b, hi_b = lo_a[solid], hi_a[solid], lo_b[solid], hi_b[solid]
    while len(lo_a):
        # Without an inner end on either side there is nothing to cut.
        leaf = (hi_a - lo_a < 2) | (hi_b - lo_b < 2)
        cut_a = np.full(len(lo_a), -1)
        cut_b = np.full(len(lo_a), -1)
        middle = (lo_a + hi_a - 1) // 2
        for step in (1, -1):  # from the middle to the right, then to the left
            todo = np.flatnonzero(~leaf & (cut_a < 0))
            at = middle[todo] if step == 1 else middle[todo] - 1
            while len(todo):
                inner = (at >= lo_a[todo]) & (at < hi_a[todo] - 1)
                todo, at = todo[inner], at[inner]
                if not len(todo):
                    break
                if step == 1:  # bisect: the first end of b that is not before a's
                    near = np.searchsorted(b, a[at])
                    inside = near < hi_b[todo] - 1
                else:  # the last end of b that is not after a's
                    near = np.searchsorted(b, a[at], side="right") - 1
                    inside = near >= lo_b[todo]
                todo, at, near = todo[inside], at[inside], near[inside]
                hit = a[at] == b[near]
                cut_a[todo[hit]], cut_b[todo[hit]] = at[hit], near[hit]
                todo, near = todo[~hit], near[~hit]
                # Next is a's end at or beyond that end of b.
                at = np.searchsorted(a, b[near]) if step == 1 else np.searchsorted(a, b[near], side="right") - 1
        whole = cut_a < 0
        found_a.append(hi_a[whole] - 1)
        found_b.append(hi_b[whole] - 1)
        left = ~whole
        ca, cb = cut_a[left] + 1, cut_b[left] + 1
        lo_a, hi_a, lo_b, hi_b = (np.concatenate([lo_a[left], ca]), np.concatenate([ca, hi_a[left]]),
                                  np.concatenate([lo_b[left], cb]), np.concatenate([cb, hi_b[left]]))
    if not found_a:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    last_a, last_b = np.concatenate(found_a), np.concatenate(found_b)
    order = np.argsort(last_a, kind="stable")
    return last_a[order], last_b[order]


def _groups_text(pair: Pair, a: np.ndarray, b: np.ndarray, last_a: np.ndarray, last_b: np.ndarray, first_group: np.ndarray) -> list[bytes]:
    """``a1,a2|b1;a3|b2,b3`` for each text; ``first_group`` has where its groups begin."""
    begin_a, begin_b = np.concatenate([[0], last_a + 1])[:-1], np.concatenate([[0], last_b + 1])[:-1]
    n_a, n_b = last_a + 1 - begin_a, last_b + 1 - begin_b
    after = np.concatenate([[0], np.cumsum(n_a + n_b)])
    shown = np.zeros(len(a) + len(b), np.int64)
    place_a = _spread(after[:-1], n_a)
    shown[place_a], shown[_spread(after[:-1] + n_a, n_b)] = a, b
    shown[after[:-1] + n_a - 1] += pair.shown_n
    shown[after[1:] - 1] += 2 * pair.shown_n
    joined = pair.shown.take(pa.array(shown))
    _, offsets, data = joined.buffers()
    if not len(joined):
        return [b""] * (len(first_group) - 1)
    offsets = np.frombuffer(offsets, np.int64)[joined.offset:joined.offset + len(joined) + 1]
    bounds = offsets[after[first_group]]
    view = memoryview(data)
    return [bytes(view[x:max(x, y - 1)]) for x, y in zip(bounds[:-1].tolist(), bounds[1:].tolist())]


@dataclass
class Aligned:
    a: Tokens
    b: Tokens
    last_a: np.ndarray       # the last token of each group
    last_b: np.ndarray
    first_group: np.ndarray  # where each text's groups begin


def align(pair: Pair, texts: pa.Array) -> Aligned:
    a, b = tokenize(pair, texts)
    last_a, last_b = shared_cuts(a.ends, b.ends, a.starts[:-1], a.starts[1:], b.starts[:-1], b.starts[1:])
    return Aligned(a, b, last_a, last_b, np.searchsorted(last_a, a.starts))


def links(found: Aligned) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(a, b, first): token places of every link in order, and where each text's links begin."""
    ends = np.concatenate([found.a.ends, found.b.ends])
    ends.sort(kind="stable")
    ends = ends[np.concatenate([[True], ends[1:] != ends[:-1]])] if len(ends) else ends
    n = np.diff(found.a.starts) + np.diff(found.b.starts) - np.diff(found.first_group)
    return np.searchsorted(found.a.ends, ends), np.searchsorted(found.b.ends, ends), np.concatenate([[0], np.cumsum(n)])


def _lists(values: np.ndarray, bounds: np.ndarray, kind: pa.DataType) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(values, kind))


def _aligned(folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = load_pair(folder)
        for batch in batches:
            texts = as_texts(batch.column("text"))
            for start, n in pieces(texts, PIECE_BYTES):
                found = align(pair, texts.slice(start, n))
                g = found.first_group
                ends_a = found.last_a + 1 - np.repeat(found.a.starts[:-1], np.diff(g))
                ends_b = found.last_b + 1 - np.repeat(found.b.starts[:-1], np.diff(g))
                yield pa.record_batch({
                    "id": batch.column("id").slice(start, n), "a_ids": _lists(found.a.ids, found.a.starts, pa.int32()),
                    "b_ids": _lists(found.b.ids, found.b.starts, pa.int32()), "a_ends": _lists(ends_a, g, pa.int32()), "b_ends": _lists(ends_b, g, pa.int32())})
    return run


def alignments(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", folder: str = TOKENIZERS) -> DataFrame:
    """(id, a_ids, b_ids, a_ends, b_ends): each text's tokens, and after how many of them each group ends."""
    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(
        _aligned(folder), f"id {kind}, a_ids array<int>, b_ids array<int>, a_ends array<int>, b_ends array<int>")


def _counted(folder: str):
    """A row a text with its distinct pairs, and rows of pair counts of each piece."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = load_pair(folder)
        row = TaskContext.get().partitionId() << 33
        for batch in batches:
            texts, ids = as_texts(batch.column("text")), batch.column("id")
            for start, n in pieces(texts, PIECE_BYTES):
                found = align(pair, texts.slice(start, n))
                at_a, at_b, first = links(found)
                code = found.a.ids[at_a] * pair.size_b + found.b.ids[at_b]
                # Distinct pairs of each text, with how many of its links hold them.
                text = np.repeat(np.arange(n), np.diff(first))
                order = np.lexsort((code, text))
                code, text = code[order], text[order]
                new = np.flatnonzero(np.concatenate([[True], (code[1:] != code[:-1]) | (text[1:] != text[:-1])])) if len(code) else np.zeros(0, np.int64)
                times = np.diff(np.concatenate([new, [len(code)]]))
                code, bounds = code[new], np.searchsorted(text[new], np.arange(n + 1))
                shown = _groups_text(pair, found.a.ids, found.b.ids, found.last_a, found.last_b, found.first_group)
                yield pa.record_batch({
                    "kind": pa.array([0] * n, pa.int32()), "row": pa.array(np.arange(row, row + n)), "id": ids.slice(start, n),
                    "n_a": pa.array(np.diff(found.a.starts)), "n_b": pa.array(np.diff(found.b.starts)), "n_groups": pa.array(np.diff(found.first_group)),
                    "n_links": pa.array(np.diff(first)), "groups_sha256": pa.array([hashlib.sha256(x).hexdigest() if x else "" for x in shown]),
                    "codes": _lists(code, bounds, pa.int64()), "times": _lists(times, bounds, pa.int32())})
                row += n
                distinct, back = np.unique(code, return_inverse=True)
                total = np.zeros(len(distinct), np.int64)
                np.add.at(total, back, times)
                bounds = np.append(np.arange(0, len(distinct), COUNTS_ROW), len(distinct)) if len(distinct) else np.zeros(1, np.int64)
                m = len(bounds) - 1
                zeros = pa.nulls(m, pa.int64())
                yield pa.record_batch({
                    "kind": pa.array([1] * m, pa.int32()), "row": zeros, "id": pa.nulls(m, ids.type), "n_a": zeros, "n_b": zeros, "n_groups": zeros,
                    "n_links": zeros, "groups_sha256": pa.nulls(m, pa.string()), "codes": _lists(distinct, bounds, pa.int64()),
                    "times": _lists(total, bounds, pa.int32())})
    return run


def pair_counts(held: DataFrame, size_b: int) -> DataFrame:
    """(code, count, best): how many links of the corpus hold each pair of ids, and whether no other pair of its B id has more."""
    each = held.where("kind = 1").select(F.explode(F.arrays_zip("codes", "times")).alias("p"))
    counts = each.groupBy(F.col("p.codes").alias("code")).agg(F.sum(F.col("p.times").cast("long")).alias("count"))
    counts = materialize(counts.withColumn("b", F.pmod("code", F.lit(size_b)).cast("int")), "pair_counts")
    most = counts.groupBy("b").agg(F.max("count").alias("most"))  # one row an id of B: the vocabulary bounds it
    return counts.join(F.broadcast(most), "b").select("code", "count", (F.col("count") == F.col("most")).alias("best"))


def summaries(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", folder: str = TOKENIZERS,
              broadcast_pairs: int = BROADCAST_PAIRS) -> DataFrame:
    """(id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256): one row a text.

    The corpus' pair counts are broadcast to the texts' distinct pairs up to
    ``broadcast_pairs`` of them; more are joined by a shuffle on the pair, which
    AQE splits where most texts share one.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    held = materialize(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(
        _counted(folder), f"kind int, row long, id {kind}, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
                          "codes array<long>, times array<int>"), "alignments", partition_by=["kind"])
    counts = materialize(pair_counts(held, load_pair(folder).size_b), "counts")
    small = counts.limit(broadcast_pairs + 1).count() <= broadcast_pairs
    rows = held.where("kind = 0").drop("kind")
    own = ["row", "id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"]
    each = rows.where("n_links > 0").select(*own, F.explode(F.arrays_zip("codes", "times")).alias("p"))
    each = each.select(*own, F.col("p.codes").alias("code"), F.col("p.times").cast("long").alias("n"))
    # Of a text's own columns only the row number crosses the join and its aggregate.
    sums = (each.select("row", "code", "n").join(F.broadcast(counts) if small else counts, "code").groupBy("row")
                .agg(F.sum(F.when(F.col("best"), F.col("n")).otherwise(0)).alias("n_best"), F.sum(F.col("n") * F.col("count")).alias("count_sum")))
    zero = F.lit(0).cast("long")
    return rows.select(*own).join(sums, "row", "left").select(
        "id", "n_a", "n_b", "n_groups", "n_links", F.coalesce("n_best", zero).alias("n_best"), F.coalesce("count_sum", zero).alias("count_sum"), "groups_sha256")

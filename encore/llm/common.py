"""Helpers shared by the training-data operators."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def id_text(id_col: str) -> Column:
    """The id as text; a null id counts as the empty string."""
    return F.coalesce(F.col(id_col).cast("string"), F.lit(""))


def id_remainder(id_col: str, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus``; a null id counts as the empty string (crc32 0)."""
    return F.pmod(F.crc32(id_text(id_col).cast("binary")), F.lit(modulus))


def unit_hash(seed: int, *cols: Column) -> Column:
    """A double in [0, 1) from a hash of the columns: the same for the same values and seed."""
    return (F.xxhash64(F.lit(seed), *cols).bitwiseAND(F.lit((1 << 52) - 1)) / F.lit(float(1 << 52))).cast("double")


def free_name(df: DataFrame, base: str) -> str:
    """A column name that ``df`` does not have (names are compared without case)."""
    taken = {c.lower() for c in df.columns}
    name = base
    while name.lower() in taken:
        name += "_"
    return name



def sha256_hex(text: str) -> str:
    return hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest()


LOWER = {b: b + 32 for b in range(0x41, 0x5B)}
#: ``[^\x20\x09-\x0D]+`` in lower case: bytes to bytes.
SPACED = bytes(LOWER.get(b, b) for b in range(256))
#: ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` in lower case: other bytes become spaces.
ALPHANUMERIC = bytes(c if c >= 0x80 or 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A else 0x20
                     for c in (LOWER.get(b, b) for b in range(256)))


def as_texts(array: pa.Array) -> pa.Array:
    """64-bit offsets, null as the empty text."""
    return pc.fill_null(array.cast(pa.large_string()), "")


def pieces(array: pa.Array, max_bytes: int) -> list[tuple[int, int]]:
    """(start, rows) of runs of rows with about ``max_bytes`` of text each; a longer text is a run of its own.

    Bounds what a task works on at once; no row is dropped or split.
    """
    ends = np.cumsum(pc.binary_length(array).to_numpy(zero_copy_only=False).astype(np.int64))
    out, start, base = [], 0, 0
    while start < len(array):
        stop = max(start + 1, int(np.searchsorted(ends, base + max_bytes, side="right")))
        out.append((start, stop - start))
        base, start = int(ends[stop - 1]), stop
    return out


def words_of(array: pa.Array, table: bytes) -> tuple[pa.Array, np.ndarray]:
    """All words of the texts in a row, and the offset at which each text's words begin (one more than texts)."""
    _, offsets, data = array.buffers()
    offsets = np.frombuffer(offsets, np.int64)[array.offset:array.offset + len(array) + 1] if len(array) else np.zeros(1, np.int64)
    raw = (data.to_pybytes() if data is not None else b"")[offsets[0]:offsets[-1]].translate(table)
    mapped = pa.Array.from_buffers(pa.large_string(), len(array), [None, pa.py_buffer(np.ascontiguousarray(offsets - offsets[0])), pa.py_buffer(raw)])
    lists = pc.ascii_split_whitespace(mapped)
    flat = lists.flatten()
    starts = lists.offsets.to_numpy().astype(np.int64)
    solid = pc.not_equal(flat, "")
    before = np.concatenate([[0], np.cumsum(solid.to_numpy(zero_copy_only=False))])
    return flat.filter(solid), before[starts - starts[0]]

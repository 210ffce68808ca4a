"""Sets of hashed word shingles, for whole batches of texts at once."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash

from encore.llm.common import SPACED, words_of

SHINGLE_WORDS = 5
_FACTOR = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values (an invertible mixer)."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def word_hashes(words: pa.Array) -> np.ndarray:
    """64-bit hash of every word; each distinct word is hashed once."""
    coded = words.dictionary_encode()
    distinct = np.fromiter((xxhash.xxh64_intdigest(w) for w in coded.dictionary.cast(pa.large_binary()).to_pylist()),
                           np.uint64, len(coded.dictionary))
    return distinct[coded.indices.to_numpy()] if len(words) else np.zeros(0, np.uint64)


def shingle_sets(texts: pa.Array, words: int = SHINGLE_WORDS) -> list[np.ndarray]:
    """For each text the sorted distinct hashes of its runs of ``words`` words.

    A text of fewer words has one hash, that of its whole sequence; one without words has none.
    """
    flat, starts = words_of(texts, SPACED)
    one = word_hashes(flat)
    with np.errstate(over="ignore"):
        n = len(one) - words + 1
        runs = np.zeros(max(n, 0), np.uint64)
        for k in range(words if n > 0 else 0):
            runs = runs * _FACTOR + one[k:n + k]
        runs = mix(runs)
        out = []
        for a, b in zip(starts[:-1].tolist(), starts[1:].tolist()):
            if b - a >= words:
                out.append(np.unique(runs[a:b - words + 1]))
            elif b > a:
                whole = np.uint64(b - a)
                for w in one[a:b]:
                    whole = whole * _FACTOR + w
                out.append(mix(np.array([whole + np.uint64(1)], np.uint64)))
            else:
                out.append(np.zeros(0, np.uint64))
    return out

"""64-bit hashes of the words of many texts at once, in numpy over their bytes."""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa

U64 = np.uint64
#: Bytes of text that are hashed together.
TOGETHER = 1 << 19
_random = np.random.default_rng(5)
#: One odd number for each byte, and a step of the polynomial with its inverse.
_BYTES = _random.integers(1, 2**63, 256, dtype=np.uint64) | U64(1)
_STEP = 0x9E3779B97F4A7C15
_INVERSE = pow(_STEP, -1, 2**64)

# White space of the contracts.
IS_SPACE = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
_lower = np.arange(256, dtype=np.uint8)
_lower[65:91] += 32
LOWER = _lower
_kept = np.arange(256) >= 128
_kept[48:58] = _kept[97:123] = True
#: Bytes that are no part of a term, A-Z lower-cased before.
IS_NO_TERM = ~_kept


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


@lru_cache(maxsize=4)
def _powers_to(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the step and of its inverse."""
    out = []
    for base in (_STEP, _INVERSE):
        table = np.full(n, base, dtype=np.uint64)
        table[0] = 1
        out.append(np.multiply.accumulate(table))
    return out[0], out[1]


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all strings in a row, and where each begins (one more for the end)."""
    column = column.cast(pa.large_string()) if column.null_count == 0 else column.fill_null("").cast(pa.large_string())
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


def word_hashes(column: pa.Array, separators: np.ndarray = IS_SPACE) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all texts in order, A-Z lower-cased, and where each text's words begin.

    A word's hash depends on its bytes alone. Texts are kept apart: none ends inside a word of the next.
    """
    raw, at = text_bytes(column)
    hashes, counts = [], [np.zeros(1, dtype=np.int64)]
    first, words = 0, 0
    while first < len(at) - 1:  # some texts at a time, so that what is computed fits the cache
        last = max(first + 1, int(np.searchsorted(at, at[first] + TOGETHER, "right")) - 1)
        found, begin = _hashes(raw[at[first] : at[last]], at[first : last + 1] - at[first], separators)
        hashes.append(found)
        counts.append(begin[1:] + words)
        first, words = last, words + len(found)
    return np.concatenate(hashes) if hashes else np.zeros(0, dtype=np.uint64), np.concatenate(counts)


def _hashes(raw: np.ndarray, at: np.ndarray, separators: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    n = len(raw)
    if n == 0:
        return np.zeros(0, dtype=np.uint64), np.zeros(len(at), dtype=np.int64)
    low = LOWER[raw]
    inside = ~separators[low]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:]
    edges = at[(at > 0) & (at < n)]
    begins[edges] = inside[edges]
    ends[edges - 1] = inside[edges - 1]
    start, end = np.flatnonzero(begins), np.flatnonzero(ends)
    powers, inverse = _powers_to(1 << max(20, int(n).bit_length()))
    sums = np.cumsum(_BYTES[low] * powers[:n], dtype=np.uint64)
    before = np.where(start > 0, sums[np.maximum(start, 1) - 1], U64(0))
    value = (sums[end] - before) * inverse[start]
    return mix(value + (end - start + 1).astype(np.uint64)), np.searchsorted(start, at)

"""Vectorised word and shingle hashing over UTF-8 bytes, shared by the operators of this package.

A word is a maximal run of bytes other than space and U+0009 to U+000D.  Words are hashed
straight from the Arrow buffer of a text column: no Python string is made per word, so the
cost is a few array passes.  All arrays are made for slices of about ``SLICE`` bytes, so
memory does not follow the size of a batch or of one very long text.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa

SLICE = 1 << 20
_U64 = np.uint64
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser: spreads every input bit over the whole word."""
    x = x.astype(_U64, copy=True)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x ^= x >> _U64(shift)
        x *= _U64(factor)
    x ^= x >> _U64(31)
    return x


# One random-looking 64-bit value per byte, so that the polynomial below has no short relations.
_BYTE = mix(np.arange(1, 257, dtype=_U64) * _U64(0x9E3779B97F4A7C15))
_BASE = 0x9FB21C651E98DF25  # odd, hence invertible modulo 2**64
_INVERSE = pow(_BASE, -1, 1 << 64)
_powers: dict[int, np.ndarray] = {}


def _power(base: int, n: int) -> np.ndarray:
    known = _powers.get(base)
    if known is None or len(known) < n:
        size = max(n, SLICE + 4096)
        known = np.full(size, base, _U64)
        known[0] = 1
        _powers[base] = known = np.multiply.accumulate(known)
    return known[:n]


def buffer_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and row offsets (one more than rows) of a string column; nulls are empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if texts.null_count:
        texts = texts.fill_null("")
    texts = texts.cast(pa.large_string())
    _, offsets, data = texts.buffers()
    at = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return data[at[0] : at[-1]], at - at[0]


def word_spans(data: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end byte of every word of all rows; a row's end also ends a word."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    inside = ~_SPACE[data]
    starts = inside.copy()
    starts[1:] &= ~inside[:-1]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:]
    edge = rows[(rows > 0) & (rows < len(data))]
    starts[edge] = inside[edge]
    ends[edge - 1] = inside[edge - 1]
    return np.flatnonzero(starts), np.flatnonzero(ends) + 1


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool = False) -> np.ndarray:
    """64-bit hash of each byte span; equal spans hash alike wherever they stand.

    Spans are disjoint and ascending.  Sums of byte values times powers of an odd base are
    taken by one cumulative sum per slice and brought to position 0 by the inverse power.
    """
    out = np.empty(len(starts), _U64)
    first = 0
    while first < len(starts):
        low = starts[first]
        last = max(int(np.searchsorted(ends, low + SLICE, "right")), first + 1)
        part = data[low : ends[last - 1]]
        values = _BYTE[_LOWER[part] if lower else part]
        values *= _power(_BASE, len(part))
        total = np.zeros(len(part) + 1, _U64)
        np.cumsum(values, out=total[1:])
        a, b = starts[first:last] - low, ends[first:last] - low
        h = (total[b] - total[a]) * _power(_INVERSE, len(part) + 1)[a]
        out[first:last] = mix(h + (b - a).astype(_U64) * _U64(0x9E3779B97F4A7C15))
        first = last
    return out


def hashed_words(texts: pa.Array, lower: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word, and for each row the index of its first word (one more entry than rows)."""
    data, rows = buffer_of(texts)
    found, counts, at = [], [], 0
    while at < len(rows) - 1:
        upto = max(int(np.searchsorted(rows, rows[at] + SLICE, "right")) - 1, at + 1)
        low = rows[at]
        part, local = data[low : rows[upto]], rows[at : upto + 1] - low
        starts, ends = word_spans(part, local)
        found.append(span_hashes(part, starts, ends, lower))
        counts.append(np.searchsorted(starts, local) if len(starts) else np.zeros(len(local), np.int64))
        at = upto
    words = np.concatenate(found) if found else np.zeros(0, _U64)
    per_row = np.concatenate([np.diff(c) for c in counts]) if counts else np.zeros(0, np.int64)
    return words, np.concatenate([[0], np.cumsum(per_row)]).astype(np.int64)


def window_hashes(words: np.ndarray, width: int) -> np.ndarray:
    """Order-dependent hash of every run of ``width`` consecutive words, rows not regarded."""
    n = len(words) - width + 1
    if n <= 0:
        return np.zeros(0, _U64)
    h = words[:n] * _U64(0x9E3779B97F4A7C15)
    for k in range(1, width):
        h = (h + words[k : k + n]) * _U64((_BASE + 2 * k) & (2**64 - 1))
        h ^= h >> _U64(29)
    return mix(h)


def slices(batches: Iterator[pa.RecordBatch], column: str, size: int = 8 * SLICE) -> Iterator[pa.RecordBatch]:
    """The batches cut into runs of rows whose ``column`` holds about ``size`` bytes (one row at least)."""
    for batch in batches:
        if not batch.num_rows:
            continue
        _, rows = buffer_of(batch.column(column))
        at = 0
        while at < batch.num_rows:
            upto = max(int(np.searchsorted(rows, rows[at] + size, "right")) - 1, at + 1)
            yield batch.slice(at, upto - at)
            at = upto


def _give_back() -> None:
    """Return free memory of the Arrow pool and, where the C library can, of the heap to the system."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def tidy(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]):
    """``run`` for mapInArrow, with the memory it freed given back at the end of each task.

    Python workers wait for later tasks, and beside them the next step has to fit.
    """

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        _give_back()

    return whole

"""Shingle sets of documents: distinct hashes of word runs, made batch by batch from whole texts."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from mairie.llm.textbytes import hashed_words, mix, slices, tidy, window_hashes

_U64 = np.uint64


def shingle_sets(texts: pa.Array, width: int, lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of each row, and where each row's set starts (one more entry than rows).

    A row with fewer than ``width`` words but at least one has its whole sequence as its only shingle.
    """
    words, at = hashed_words(texts, lower)
    counts = np.diff(at)
    whole = window_hashes(words, width)
    rows, hashes = [], []
    if len(whole):
        row = np.repeat(np.arange(len(counts), dtype=np.int64), counts)
        within = row[: len(whole)] == row[width - 1 :]
        rows.append(row[: len(whole)][within])
        hashes.append(whole[within])
    for n in range(1, width):
        short = np.flatnonzero(counts == n)
        if len(short):
            h = np.zeros(len(short), _U64)
            for k in range(n):
                h = mix(h + words[at[short] + k] * _U64(2 * k + 3))
            rows.append(short)
            hashes.append(mix(h + _U64(n)))
    if not rows:
        return np.zeros(0, _U64), np.zeros(len(counts) + 1, np.int64)
    rows, hashes = np.concatenate(rows), np.concatenate(hashes)
    order = np.lexsort((hashes, rows))
    rows, hashes = rows[order], hashes[order]
    first = np.ones(len(rows), bool)
    first[1:] = (rows[1:] != rows[:-1]) | (hashes[1:] != hashes[:-1])
    rows, hashes = rows[first], hashes[first]
    return hashes, np.searchsorted(rows, np.arange(len(counts) + 1))


_FEW = 16
_tables: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _draws(bins: int) -> tuple[np.ndarray, np.ndarray]:
    """The lender each bin draws at each attempt, and the first attempt at which a bin draws each lender."""
    if bins not in _tables:
        number = np.arange(bins, dtype=_U64) * _U64(0x9E3779B97F4A7C15)
        rounds, first = [], np.full((bins, bins), -1, np.int64)
        while (first < 0).any():
            drawn = (mix(number + _U64(len(rounds) + 1)) % _U64(bins)).astype(np.int64)
            new = first[np.arange(bins), drawn] < 0
            first[np.flatnonzero(new), drawn[new]] = len(rounds)
            rounds.append(drawn)
        _tables[bins] = np.array(rounds), first
    return _tables[bins]


def one_permutation(hashes: np.ndarray, starts: np.ndarray, bins: int) -> np.ndarray:
    """One-permutation MinHash of each set: a (rows, bins) array of 32-bit values; empty sets give zeros.

    One hash per shingle: its low bits choose the bin and its high bits compete for the bin's
    minimum.  Empty bins are densified optimally: each borrows from a bin drawn by a hash that
    depends on its own number and the attempt only, so equal sets borrow alike and every filled
    bin is equally likely to lend.
    """
    n = len(starts) - 1
    out = np.full((n, bins), 2**32 - 1, np.uint32)
    full = np.zeros((n, bins), bool)
    mixed = mix(hashes ^ _U64(0x51ED270B9F1C3A77))
    row = np.repeat(np.arange(n), np.diff(starts))
    place = row * bins + (mixed % _U64(bins)).astype(np.int64)
    value = (mixed >> _U64(32)).astype(np.uint32)
    order = np.lexsort((value, place))
    place, value = place[order], value[order]
    first = np.ones(len(place), bool)
    first[1:] = place[1:] != place[:-1]
    out.reshape(-1)[place[first]] = value[first]
    full.reshape(-1)[place[first]] = True
    some = np.diff(starts) > 0
    draws = _draws(bins)
    filled = full.sum(axis=1)
    for count in np.unique(filled[some & (filled <= _FEW)]):  # few lenders: the one drawn first, by table
        rows_here = np.flatnonzero(filled == count)
        lenders = np.nonzero(full[rows_here])[1].reshape(len(rows_here), count)
        pick = np.argmin(draws[1][:, lenders], axis=2)  # (bins, rows)
        own = out[rows_here[None, :], lenders[np.arange(len(rows_here))[None, :], pick]]
        out[rows_here] = np.where(full[rows_here], out[rows_here], own.T)
    row, place = np.nonzero(~full & (filled > _FEW)[:, None])
    attempt = 0
    while len(row):
        lender = draws[0][attempt][place]
        good = full[row, lender]
        out[row[good], place[good]] = out[row[good], lender[good]]
        row, place = row[~good], place[~good]
        attempt += 1
    out[~some] = 0
    return out


def band_keys(signature: np.ndarray, bands: int) -> np.ndarray:
    """(rows, bands) keys; each is a hash of the band's number and its signature values."""
    n, bins = signature.shape
    rows = bins // bands
    key = np.broadcast_to(mix(np.arange(1, bands + 1, dtype=_U64)), (n, bands)).copy()
    values = signature[:, : rows * bands].reshape(n, bands, rows).astype(_U64)
    for k in range(rows):
        key = mix(key ^ values[:, :, k]) + _U64(k + 1)
    return key


def band_rows(width: int, bins: int, bands: int):
    """mapInArrow function: (doc_id, _text) to doc_id, n_shingles, two sums that name the set, and its band keys."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "_text", 4 << 20):
            hashes, starts = shingle_sets(batch.column("_text"), width)
            keys = band_keys(one_permutation(hashes, starts, bins), bands)
            sizes = np.diff(starts)
            total = np.zeros((2, len(hashes) + 1), _U64)
            np.cumsum(hashes, out=total[0, 1:])
            np.cumsum(mix(hashes ^ _U64(0xA0761D6478BD642F)), out=total[1, 1:])
            sums = (total[:, starts[1:]] - total[:, starts[:-1]]).view(np.int64)
            offsets = pa.array(np.arange(len(sizes) + 1, dtype=np.int32) * bands)
            columns = [
                batch.column("doc_id"), pa.array(sizes.astype(np.int64)), pa.array(sums[0]), pa.array(sums[1]),
                pa.ListArray.from_arrays(offsets, pa.array(keys.reshape(-1).view(np.int64))),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_shingles", "set_a", "set_b", "bands"])

    return tidy(run)


def set_rows(width: int):
    """mapInArrow function: (doc_id, _text) to doc_id and the sorted set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "_text", 4 << 20):
            hashes, starts = shingle_sets(batch.column("_text"), width)
            sets = pa.ListArray.from_arrays(pa.array(starts.astype(np.int32)), pa.array(hashes.view(np.int64)))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), sets], names=["doc_id", "shingles"])

    return tidy(run)

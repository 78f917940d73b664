"""Hard negatives by Four-Russians scoring: exact integer inner products from table lookups.

Vectors are integers, component by component.  For every group of eight dimensions an anchor has a
table of the sums of all 256 subsets of its eight components.  A candidate is cut into bit planes
(two's complement); the eight bits of one plane and one group are a byte, and that byte's table
entry is the group's part of the inner product with this plane.  Entries are added over the groups
and shifted and added over the planes, which gives the full score without a multiplication.

Anchors are dealt to groups and candidates to slices; a task holds the tables of one group and
streams one slice through them, so every anchor meets every candidate while neither side is ever
held whole.  Both numbers follow from the row counts; no label, vector or id decides where a row
goes, so none can make a task hot.  A task hands on at most the best few rows of each anchor.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mairie.llm.common import store

SCALE = 256
GROUP_ANCHORS = 1_024
TILE = 512  # candidates whose scores with one group are held at a time
_LARGEST = float(2**62)


def subset_tables(anchors: np.ndarray) -> list[np.ndarray]:
    """For each group of eight columns a (256, anchors) table: row ``s`` sums the components in subset ``s``."""
    tables = []
    for first in range(0, anchors.shape[1], 8):
        part = anchors[:, first : first + 8]
        table = np.zeros((256, len(anchors)), anchors.dtype)
        for bit in range(part.shape[1]):
            half = 1 << bit
            table[half : 2 * half] = table[:half] + part[:, bit]
        tables.append(table)
    return tables


def plane_bytes(values: np.ndarray) -> np.ndarray:
    """(planes, groups, rows) bytes of integer rows in two's complement, lowest plane first."""
    low, high = (int(values.min()), int(values.max())) if values.size else (0, 0)
    planes = max(int(low + 1 if low < 0 else low).bit_length(), high.bit_length()) + 1
    bits = (values[None] >> np.arange(planes, dtype=np.int64)[:, None, None]) & 1
    return np.packbits(bits.astype(np.uint8), axis=2, bitorder="little").transpose(0, 2, 1)


def exact_scores(tables: list[np.ndarray], packed: np.ndarray) -> np.ndarray:
    """(rows, anchors) inner products; the highest plane counts negative."""
    total = None
    for plane in packed[::-1]:
        part = tables[0][plane[0]]
        for table, byte in zip(tables[1:], plane[1:], strict=False):
            part += table[byte]
        if total is None:
            total = -part
        else:
            total <<= 1
            total += part
    return total


def _matrix(values: pa.Array) -> np.ndarray:
    """Integer rows from a list column; rows shorter than the longest are filled with zeros."""
    if isinstance(values, pa.ChunkedArray):
        values = values.combine_chunks()
    sizes = np.diff(values.offsets.to_numpy())
    flat = values.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    width = max(int(sizes.max(initial=0)), 1)
    out = np.zeros((len(sizes), width), np.int64)
    out[np.arange(width)[None] < sizes[:, None]] = flat
    return out


class _Group:
    """The anchors of one group with their tables; rows are ordered by label."""

    def __init__(self, rows: pa.Table):
        labels = rows.column("label").to_pylist()
        order = sorted(range(len(labels)), key=labels.__getitem__)
        self.rows = rows.take(pa.array(order))
        self.x = _matrix(self.rows.column("x"))
        self.labels = np.array([labels[k] for k in order], object)
        self.number = {name: k for k, name in enumerate(sorted(set(labels)))}
        self.span = {name: np.flatnonzero(self.labels == name) for name in self.number}
        self.tables: dict[tuple, list[np.ndarray]] = {}

    def scores(self, x: np.ndarray, label: str | None) -> np.ndarray:
        """(rows, anchors of ``label``, or all) scores of candidate rows."""
        width = min(x.shape[1], self.x.shape[1])
        x, own = x[:, :width], self.x[:, :width]
        # 32 bits are enough where no partial sum can pass them; else sums are taken in 64 bits.
        bound = width * (int(np.abs(own).max(initial=0)) + 1) * 2 * (int(np.abs(x).max(initial=0)) + 1)
        kind = np.int32 if bound < 2**31 else np.int64
        key = (label, width, kind)
        if key not in self.tables:
            chosen = own if label is None else own[self.span[label]]
            self.tables[key] = subset_tables(chosen.astype(kind))
        return exact_scores(self.tables[key], plane_bytes(x))


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Indices of the ``k`` highest scores, ties by smaller id."""
    if len(scores) > k:
        least = np.partition(scores, len(scores) - k)[len(scores) - k]
        near = np.flatnonzero(scores >= least)
    else:
        near = np.arange(len(scores))
    return near[np.lexsort((ids[near], -scores[near].astype(np.int64)))][:k]


class _Top:
    """The ``k`` best (score, id) of every (anchor, rank) over a whole slice."""

    def __init__(self, k: int):
        self.k, self.kept = k, {}

    def offer(self, anchor: int, rank: int, scores: np.ndarray, ids: np.ndarray) -> None:
        held = self.kept.get((anchor, rank))
        if held is not None:
            if len(held[0]) == self.k:  # sorted, so the last score is what others must reach
                near = scores >= held[0][-1]
                scores, ids = scores[near], ids[near]
            scores, ids = np.concatenate([held[0], scores]), np.concatenate([held[1], ids])
        if len(scores):
            best = _best(scores, ids, self.k)
            self.kept[anchor, rank] = scores[best], ids[best]

    def rows(self) -> list[tuple]:
        return [(*key, i, s) for key, (scores, ids) in self.kept.items() for s, i in zip(scores.tolist(), ids.tolist(), strict=True)]


_NO_ID = np.iinfo(np.int64).max  # rows without an id come last among equal scores


def _ids(column) -> np.ndarray:
    return column.fill_null(_NO_ID).to_numpy(zero_copy_only=False)


def _positives(group: _Group, top: _Top) -> Callable[[pa.RecordBatch], None]:
    own = _ids(group.rows.column("vec_id").combine_chunks())

    def run(batch: pa.RecordBatch) -> None:
        labels = np.array(batch.column("label").to_pylist(), object)
        ids = _ids(batch.column("vec_id"))
        x = _matrix(batch.column("x"))
        for label, span in group.span.items():
            rows = np.flatnonzero(labels == label)
            for first in range(0, len(rows), TILE):
                part = rows[first : first + TILE]
                scores = group.scores(x[part], label)
                for column, anchor in enumerate(span):
                    other = ids[part] != own[anchor]
                    top.offer(anchor, 0, scores[other, column], ids[part][other])

    return run


def _negatives(group: _Group, top: _Top, low: int, high: int) -> Callable[[pa.RecordBatch], None]:
    # low * p <= 100 * n <= high * p, as whole numbers: ceil(low * p / 100) <= n <= floor(high * p / 100).
    wanted = [
        [(rank, -(-low * p // 100), high * p // 100) for rank, p in enumerate(each)]
        for each in group.rows.column("positive_scores").to_pylist()
    ]

    def run(batch: pa.RecordBatch) -> None:
        number = np.array([group.number.get(v, -1) for v in batch.column("label").to_pylist()])
        own = np.array([group.number[v] for v in group.labels])
        ids = _ids(batch.column("vec_id"))
        x = _matrix(batch.column("x"))
        for first in range(0, len(ids), TILE):
            scores = group.scores(x[first : first + TILE], None).T
            other = own[:, None] != number[None, first : first + TILE]
            near = ids[first : first + TILE]
            for anchor, bounds in enumerate(wanted):
                mine = scores[anchor]
                for rank, least, most in bounds:
                    found = (mine >= least) & (mine <= most) & other[anchor]
                    top.offer(anchor, rank, mine[found], near[found])

    return run


def _streamed(make: Callable[[_Group, _Top], Callable], k: int, names: list[str]):
    """mapInArrow function: rows come by (part, slice), a group's anchors before the slice's candidates.

    What a slice finds is handed on when it ends: at most ``k`` rows per anchor and rank.
    """

    def ended(group: _Group | None, top: _Top) -> Iterator[pa.RecordBatch]:
        found = top.rows()
        if found:
            at, rank, ids, scores = (np.array(c, np.int64) for c in zip(*found, strict=True))
            columns = [group.rows.column("anchor").combine_chunks().take(pa.array(at)), pa.array(rank.astype(np.int32))]
            columns += [pa.array(ids, mask=ids == _NO_ID), pa.array(scores)]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, anchors, group, work, top = None, [], None, None, _Top(k)
        for batch in batches:
            keys = np.stack([batch.column(c).to_numpy() for c in ("part", "slice", "kind")])
            cuts = np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1
            for first, last in zip([0, *cuts], [*cuts, batch.num_rows], strict=True):
                piece = batch.slice(first, last - first)
                if tuple(keys[:2, first]) != key:
                    yield from ended(group, top)
                    key, anchors, group, top = tuple(keys[:2, first]), [], None, _Top(k)
                if keys[2, first] == 0:
                    anchors.append(piece)
                elif anchors:
                    if group is None:
                        group = _Group(pa.Table.from_batches(anchors))
                        work = make(group, top)
                    work(piece)
        yield from ended(group, top)

    return run


def _meet(anchors: DataFrame, rows: DataFrame, make: Callable, k: int, groups: int, slices: int) -> DataFrame:
    """(anchor, pos, other_id, score): what ``make`` finds when every group of anchors meets every slice."""
    columns = ["part", "slice", "kind", "vec_id", "label", "x", "anchor", "positive_scores"]
    each = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    a = anchors.withColumns({"part": F.pmod("anchor", F.lit(groups)).cast("int"), "kind": F.lit(0)})
    c = rows.withColumns({"slice": F.col("slice"), "kind": F.lit(1), "anchor": F.lit(None).cast("bigint")})
    c = c.withColumn("positive_scores", F.lit(None).cast("array<bigint>")).withColumn("part", each(groups))
    both = a.withColumn("slice", each(slices)).select(*columns).union(c.select(*columns))
    laid = both.repartition("part", "slice").sortWithinPartitions("part", "slice", "kind")
    names = ["anchor", "pos", "other_id", "score"]
    return laid.mapInArrow(_streamed(make, k, names), "anchor bigint, pos int, other_id bigint, score bigint")


def quantised(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """(vec_id, label, x): components as ``floor(scale * component)``, rows that cannot take part left out.

    Left out are rows with a null label, a null vector, or a null or non-finite component, or one whose
    whole number does not fit 62 bits.  The label becomes text, so labels of any type are told apart.
    """
    scaled = F.transform("embedding", lambda v: v.cast("double") * scale)
    usable = F.forall(scaled, lambda v: F.coalesce(F.abs(v) < _LARGEST, F.lit(False)))
    rows = vectors.select("vec_id", F.col("label").cast("string").alias("label"), scaled.alias("_x"), usable.alias("_ok"))
    rows = rows.where(F.col("label").isNotNull() & F.col("_ok"))
    return rows.select("vec_id", "label", F.transform("_x", lambda v: F.floor(v)).alias("x"))


def hard_negatives(
    vectors: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90, scale: int = SCALE
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) of ``vectors``
    (columns vec_id, label, embedding; others are not read).

    A score is the integer inner product of quantised vectors; higher ones come first, ties by smaller
    vec_id.  An anchor's positives are the first ``positives`` rows of its label with another vec_id; for
    each of them come the first ``negatives`` rows of other labels whose score is from ``low`` to
    ``high`` hundredths of the positive's.  A negative positive score has no such rows, a zero one
    takes zeros.

    Rows that ``quantised`` leaves out take no part.  A vector shorter than another counts as if
    filled with zeros, so an empty one scores 0.  Rows that repeat a vec_id are rows of their own, but
    exact repeats of an anchor are one anchor; rows without vec_id are candidates that come last
    among equals, and two such rows are no positives of each other.  Scores are 64-bit numbers.  An
    empty table gives an empty result.
    """
    rows = vectors.withColumn("_anchor", F.coalesce(is_anchor, F.lit(False)))
    numbers = quantised(rows.where("_anchor"), scale).dropDuplicates(["vec_id", "label", "x"])
    numbers = store(numbers.withColumn("anchor", F.monotonically_increasing_id()), "anchors")
    candidates = quantised(vectors, scale)
    n_rows, n_anchors = vectors.count(), numbers.count()
    groups, slices = -(-max(n_anchors, 1) // GROUP_ANCHORS), isqrt(max(n_rows, 1)) // 8 + 1
    # The slice comes from the whole row and its place, so neither equal rows nor one id share a slice.
    dealt = candidates.withColumn("slice", F.pmod(F.xxhash64("vec_id", "x", F.monotonically_increasing_id()), F.lit(slices)).cast("int"))
    dealt = store(dealt, "candidates")

    empty = F.lit(None).cast("array<bigint>")
    found = _meet(numbers.withColumn("positive_scores", empty), dealt, _positives, positives, groups, slices)
    first = Window.partitionBy("anchor").orderBy(F.desc("score"), F.asc_nulls_last("other_id"))
    kept = found.withColumn("_r", F.row_number().over(first)).where(F.col("_r") <= positives)
    # At most ``positives`` rows of an anchor are gathered.
    listed = F.array_sort(F.collect_list(F.struct("_r", "other_id", "score")))
    chosen = store(kept.groupBy("anchor").agg(listed.alias("chosen")), "positives")

    scored = numbers.join(chosen, "anchor").withColumn("positive_scores", F.col("chosen.score"))
    found = _meet(scored, dealt, lambda g, top: _negatives(g, top, low, high), negatives, groups, slices)
    best = Window.partitionBy("anchor", "pos").orderBy(F.desc("score"), F.asc_nulls_last("other_id"))
    ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= negatives)
    joined = ranked.join(scored.select("anchor", F.col("vec_id").alias("anchor_id"), "chosen"), "anchor")
    positive = F.get("chosen", F.col("pos"))
    return joined.select(
        "anchor_id", positive["other_id"].alias("positive_id"), "rank", F.col("other_id").alias("negative_id"),
        positive["score"].alias("positive_score"), F.col("score").alias("negative_score"),
    )

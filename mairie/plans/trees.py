"""Forests and boosted trees over binned features, grown level by level from exact histograms.

Training rows are binned once and kept in blocks of bytes.  Growing one level is one Spark job: every
task adds up its blocks' histograms (by tree, node, feature and bin), Spark sums them by cell, and
the driver sees the sums only, whose number depends on the settings and not on the rows.  All trees of a forest, and
all classes and trees of a boosting round, share the job.

What a row adds to a cell is a whole number (gradients and weights in fixed point), and whether a
tree samples a row follows from a hash of the row's key and the tree's number.  Sums are therefore
exact, and the same rows give the same model in any layout.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mairie.session import cut_lineage

BINS = 32
TASK_ROWS = 50_000
MAX_CELLS = 4_000_000  # of one job's histogram; more nodes take more jobs
CHECKPOINT_ROUNDS = 10  # boosting rounds between two writes of the rows' scores
_POINT = float(1 << 24)
_U64 = np.uint64
# Chances of 0, 1, 2, ... draws of a row in a sample with replacement as large as the data.
_DRAWS = np.cumsum(np.exp(-1.0) / np.cumprod([1.0, *range(1, 12)]))


def _mix(x: np.ndarray) -> np.ndarray:
    x = x.astype(_U64)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> _U64(shift))) * _U64(factor)
    return x ^ (x >> _U64(31))


def uniform(keys: np.ndarray, number: int, seed: int) -> np.ndarray:
    """A number in [0, 1) for each row key, its own for every ``number`` (a tree, say)."""
    salt = _mix(np.array([(number * 0x9E3779B97F4A7C15 + seed) & (2**64 - 1)], _U64))[0]
    return (_mix(keys.astype(np.int64).view(_U64) ^ salt) >> _U64(11)).astype(float) / 2.0**53


@dataclass
class Ensemble:
    """Trees in heap order: the children of node ``i`` are ``2i + 1`` (value <= limit) and ``2i + 2``."""

    feature: np.ndarray  # (trees, nodes), -1 for a leaf
    limit: np.ndarray  # (trees, nodes)
    value: np.ndarray  # (trees, nodes, classes)
    start: np.ndarray  # (classes,) added to the sum over the trees
    softmax: bool  # sums are logits, else they are averaged shares
    gains: np.ndarray = field(default_factory=lambda: np.zeros(0))  # importance of each feature

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        """(rows, classes), each row adding up to one."""
        total = np.tile(self.start, (len(x), 1))
        for first in range(0, len(x), 1_024):
            part = x[first : first + 1_024]
            for t in range(len(self.feature)):
                total[first : first + 1_024] += self.value[t, walk(self.feature[t], self.limit[t], part.T)]
        if not self.softmax:
            return total / np.maximum(total.sum(axis=1, keepdims=True), 1e-300)
        return softmax(total.T).T

    def column(self, *features: Column) -> Column:
        """The probabilities of a row as an array column; features are doubles without nulls."""
        model = self

        @F.pandas_udf("array<double>")
        def score(*values: pd.Series) -> pd.Series:
            x = np.column_stack([v.to_numpy(float) for v in values])
            return pd.Series(list(model.probabilities(x)))

        return score(*features)


def softmax(logits: np.ndarray) -> np.ndarray:
    """Over the first axis."""
    e = np.exp(logits - logits.max(axis=0))
    return e / e.sum(axis=0)


def walk(feature: np.ndarray, limit: np.ndarray, columns: np.ndarray) -> np.ndarray:
    """The node each row reaches; ``columns`` is (features, rows), raw values or bins.  NaN goes right."""
    node = np.zeros(columns.shape[1], np.int64)
    rows = np.arange(columns.shape[1])
    for _ in range(len(feature).bit_length() - 1):
        f = feature[node]
        right = ~(columns[np.maximum(f, 0), rows] <= limit[node])
        node = np.where(f < 0, node, 2 * node + 1 + right)
    return node


# ---- bins


def _ordered(x: np.ndarray) -> np.ndarray:
    """Unsigned numbers in the order of the doubles; -0.0 equals 0.0 and NaN is the largest."""
    x = np.where(np.isnan(x), np.nan, x + 0.0)
    bits = x.view(_U64)
    return np.where(bits >> _U64(63), ~bits, bits | _U64(1 << 63))


def _values(ordered: np.ndarray) -> np.ndarray:
    return np.where(ordered >> _U64(63), ordered ^ _U64(1 << 63), ~ordered).astype(_U64).view(float)


def _flat(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width).astype(float)


def quantile_edges(rows: DataFrame, width: int, n: int, bins: int = BINS) -> list[np.ndarray]:
    """For each feature the distinct values at ranks ceil(n k / bins), 0 < k < bins; all exact.

    The 64 bits of a value are fixed 16 at a time: a pass counts the next 16 bits of the values that
    agree with a wanted rank so far, so only counts leave the tasks.
    """
    ranks = np.unique(-(-n * np.arange(1, bins) // bins)).astype(np.int64)
    prefix = np.zeros((width, len(ranks)), _U64)
    left = np.tile(ranks, (width, 1))  # rank among the values that share the prefix
    for level in range(4):
        wanted = [np.unique(p) for p in prefix]
        shift = _U64(48 - 16 * level)

        def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                x = _ordered(_flat(batch.column("x"), width))
                for f in range(width):
                    high = x[:, f] >> shift >> _U64(16) if level else np.zeros(len(x), _U64)
                    place = np.minimum(np.searchsorted(wanted[f], high), len(wanted[f]) - 1)
                    inside = wanted[f][place] == high
                    digit = ((x[:, f] >> shift) & _U64(0xFFFF)).astype(np.int64)
                    cells, counts = np.unique((place * 65_536 + digit)[inside], return_counts=True)
                    if len(cells):
                        cells = cells + (f * len(ranks) << 16)
                        yield pa.RecordBatch.from_arrays([pa.array(cells), pa.array(counts)], names=["cell", "n"])

        found = rows.select("x").mapInArrow(count, "cell bigint, n bigint").groupBy("cell").agg(F.sum("n").alias("n")).toArrow()
        cells, counts = found.column("cell").to_numpy(), found.column("n").to_numpy()
        order = np.argsort(cells)
        cells, counts = cells[order], counts[order]
        group, digit = cells >> 16, cells & 0xFFFF
        for f in range(width):
            for k in range(len(ranks)):
                mine = group == f * len(ranks) + int(np.searchsorted(wanted[f], prefix[f, k]))
                upto = np.cumsum(counts[mine])
                at = int(np.searchsorted(upto, left[f, k]))
                left[f, k] -= upto[at - 1] if at else 0
                prefix[f, k] = (prefix[f, k] << _U64(16)) | _U64(int(digit[mine][at]))
    return [np.unique(_values(p)) for p in prefix]


@dataclass
class Blocks:
    """Binned training rows: (features, rows) bytes, labels, fixed-point weights, keys and scores of a block."""

    frame: DataFrame
    edges: list[np.ndarray]
    classes: int
    tasks: int


def prepare(rows: DataFrame, width: int, classes: int, task_rows: int = TASK_ROWS) -> Blocks:
    """Blocks of ``rows`` (stored; columns x array<double>, y int, w double, key bigint)."""
    n = rows.count()
    edges = quantile_edges(rows, width, n)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _flat(batch.column("x"), width)
            binned = np.stack([np.searchsorted(e, x[:, f]) for f, e in enumerate(edges)]).astype(np.uint8)
            weight = np.rint(batch.column("w").to_numpy() * _POINT).astype(np.int64)
            parts = [binned, batch.column("y").to_numpy().astype(np.int8), weight, batch.column("key").to_numpy()]
            blobs = [pa.array([p.tobytes()], pa.binary()) for p in (*parts, np.zeros(0))]
            yield pa.RecordBatch.from_arrays(blobs, names=["bins", "y", "w", "key", "scores"])

    tasks = -(-max(n, 1) // task_rows)
    laid = rows.repartition(tasks, "key").mapInArrow(pack, "bins binary, y binary, w binary, key binary, scores binary")
    return Blocks(cut_lineage(laid, "blocks"), edges, classes, tasks)


class _Block:
    def __init__(self, batch: pa.RecordBatch, row: int):
        read = lambda name, kind: np.frombuffer(batch.column(name)[row].as_py(), kind)
        self.y, self.w, self.key, self.scores = read("y", np.int8), read("w", np.int64), read("key", np.int64), read("scores", float)
        self.bins = read("bins", np.uint8).reshape(-1, len(self.y))


def _summed(blocks: Blocks, cells: Callable[[_Block], Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]], size: int) -> np.ndarray:
    """(size, 2) sums by cell of the pairs of whole numbers that ``cells`` finds in each block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, size))
        for batch in batches:
            for row in range(batch.num_rows):
                for cell, a, b in cells(_Block(batch, row)):
                    if len(cell):
                        # Whole numbers below 2^53: float sums are exact in any order.
                        low, high = int(cell.min()), int(cell.max()) + 1
                        total[0, low:high] += np.bincount(cell - low, a)
                        total[1, low:high] += np.bincount(cell - low, b)
        used = np.flatnonzero(total.any(axis=0))
        columns = [pa.array(used), *(pa.array(t[used].astype(np.int64)) for t in total)]
        yield pa.RecordBatch.from_arrays(columns, names=["cell", "a", "b"])

    found = blocks.frame.mapInArrow(run, "cell bigint, a bigint, b bigint")
    if blocks.tasks > 1:
        found = found.groupBy("cell").agg(F.sum("a").alias("a"), F.sum("b").alias("b"))
    table = found.toArrow()
    out = np.zeros((size, 2), np.int64)
    # One task may come as several partial rows only if it was split; adding is right in any case.
    np.add.at(out, table.column("cell").to_numpy(), np.stack([table.column(c).to_numpy() for c in "ab"], axis=1))
    return out


# ---- forest


def grow_forest(
    blocks: Blocks, trees: int = 200, depth: int = 8, min_rows: int = 3, features: int | None = None, seed: int = 42
) -> Ensemble:
    """Classification trees by Gini impurity on bootstrap samples, ``features`` tried at each node
    (the square root, rounded up, if not given); shares of a leaf are those of the weights."""
    width, classes = len(blocks.edges), blocks.classes
    tried = features or int(np.ceil(np.sqrt(width)))
    nodes = 2 ** (depth + 1) - 1
    feature, cut = np.full((trees, nodes), -1, np.int64), np.zeros((trees, nodes), np.int64)
    value, gains = np.zeros((trees, nodes, classes)), np.zeros((trees, width))
    active = [(t, 0) for t in range(trees)]
    per_node = tried * BINS * classes
    for level in range(depth + 1):
        following = []
        for first in range(0, len(active), max(1, MAX_CELLS // per_node)):
            group = np.array(active[first : first + max(1, MAX_CELLS // per_node)])
            order = np.argsort(_mix(np.arange(width)[None] + (group[:, :1] * nodes + group[:, 1:]) * width + seed * 7_919), axis=1)
            subset = np.sort(order[:, :tried], axis=1)
            split = level < depth

            def cells(block: _Block):
                for t in np.unique(group[:, 0]):
                    mine = np.flatnonzero(group[:, 0] == t)
                    place = np.full(nodes, -1)
                    place[group[mine, 1]] = mine
                    draws = np.searchsorted(_DRAWS, uniform(block.key, int(t), seed), "right")
                    at = place[walk(feature[t], cut[t], block.bins)]
                    use = np.flatnonzero((draws > 0) & (at >= 0))
                    at, n, y = at[use], draws[use].astype(float), block.y[use].astype(np.int64)
                    w = n * block.w[use]
                    for j in range(tried if split else 1):
                        bins = block.bins[subset[at, j], use].astype(np.int64)
                        yield ((at * tried + j) * BINS + bins) * classes + y, w, n

            sums = _summed(blocks, cells, len(group) * per_node).reshape(len(group), tried, BINS, classes, 2)
            total = sums[:, 0, :, :, 0].sum(axis=1)
            value[group[:, 0], group[:, 1]] = total / np.maximum(total.sum(axis=1, keepdims=True), 1)
            if not split:
                continue
            left = sums.cumsum(axis=2)
            right = left[:, :, -1:] - left
            enough = (left[..., 1].sum(axis=3) >= min_rows) & (right[..., 1].sum(axis=3) >= min_rows)
            a, b = left[..., 0].astype(float), right[..., 0].astype(float)
            pure = lambda s: (s**2).sum(axis=-1) / np.maximum(s.sum(axis=-1), 1)
            gain = np.where(enough, pure(a) + pure(b) - pure(total.astype(float))[:, None, None], -np.inf).reshape(len(group), -1)
            best = gain.argmax(axis=1)
            for k, (t, node) in enumerate(group.tolist()):
                if gain[k, best[k]] > 1e-9 * _POINT:
                    f = int(subset[k, best[k] // BINS])
                    feature[t, node], cut[t, node] = f, best[k] % BINS
                    gains[t, f] += gain[k, best[k]]
                    following += [(t, 2 * node + 1), (t, 2 * node + 2)]
        active = following
        if not active:
            break
    share = gains / np.maximum(gains.sum(axis=1, keepdims=True), 1e-300)
    return Ensemble(feature, _limits(blocks, feature, cut), value, np.zeros(classes), False, share.sum(axis=0) / max(share.sum(), 1e-300))


def _limits(blocks: Blocks, feature: np.ndarray, cut: np.ndarray) -> np.ndarray:
    """The raw value of each split: bins up to ``cut`` hold the values up to that edge."""
    out = np.zeros(feature.shape)
    for f, edges in enumerate(blocks.edges):
        here = feature == f
        out[here] = np.append(edges, np.inf)[np.minimum(cut[here], len(edges))]
    return out


# ---- boosting


def boost(
    blocks: Blocks, trees: int = 200, depth: int = 4, rate: float = 0.05, sampled: float = 0.8, together: int = 4,
    smoothing: float = 1.0, seed: int = 42,
) -> Ensemble:
    """Multiclass softmax boosting: ``trees`` trees per class, ``together`` of them per round.

    The trees of one round see the same gradients but samples of their own, so a round costs ``depth``
    jobs however many trees it grows.  Leaves take Newton steps.  Scores are written with the blocks every
    ``CHECKPOINT_ROUNDS`` rounds; in between tasks add the trees grown since.
    """
    width, classes = len(blocks.edges), blocks.classes
    nodes = 2 ** (depth + 1) - 1
    counts = _summed(blocks, lambda b: iter([(b.y.astype(np.int64), np.ones(len(b.y)), np.ones(len(b.y)))]), classes)[:, 0]
    start = np.log(np.maximum(counts, 1) / max(counts.sum(), 1))
    rounds = -(-trees // together)
    feature = np.full((trees, classes, nodes), -1, np.int64)
    cut, value, gains = np.zeros((trees, classes, nodes), np.int64), np.zeros((trees, classes, nodes)), np.zeros(width)
    written = 0  # trees whose part the stored scores hold

    def scores(block: _Block, known: int) -> np.ndarray:
        out = block.scores.reshape(classes, -1).copy() if written else np.repeat(start[:, None], len(block.y), axis=1)
        for t in range(written, known):
            for c in range(classes):
                out[c] += value[t, c, walk(feature[t, c], cut[t, c], block.bins)]
        return out

    for r in range(rounds):
        known, these = r * together, range(r * together, min((r + 1) * together, trees))
        if known - written >= CHECKPOINT_ROUNDS * together:
            blocks, written = _with_scores(blocks, lambda b, known=known: scores(b, known)), known
        for level in range(depth):
            first, here = 2**level - 1, 2**level

            def cells(block: _Block):
                p = softmax(scores(block, known))
                target = np.arange(classes)[:, None] == block.y[None]
                weight = block.w / _POINT
                g, h = np.rint((p - target) * weight * _POINT), np.rint(p * (1 - p) * weight * _POINT)
                offset = (np.arange(width) * BINS)[:, None] + block.bins
                for k, t in enumerate(these):
                    use = np.flatnonzero(uniform(block.key, t, seed) < sampled)
                    part = offset[:, use]
                    for c in range(classes):
                        node = walk(feature[t, c], cut[t, c], block.bins[:, use]) - first
                        inside = node >= 0
                        base = ((k * classes + c) * here + node[inside]) * width * BINS
                        cell = (base[None] + part[:, inside]).reshape(-1)
                        yield cell, np.tile(g[c, use][inside], width), np.tile(h[c, use][inside], width)

            shape = (len(these), classes, here, width, BINS, 2)
            sums = _summed(blocks, cells, int(np.prod(shape[:-1]))).reshape(shape) / _POINT
            left = sums.cumsum(axis=4)
            total = left[..., -1:, :]
            score = lambda s: s[..., 0] ** 2 / (s[..., 1] + smoothing)
            gain = score(left) + score(total - left) - score(total)
            gain[(left[..., 1] < 1e-3) | ((total - left)[..., 1] < 1e-3)] = -np.inf
            flat = gain.reshape(*shape[:3], -1)
            best, most = flat.argmax(axis=3), flat.max(axis=3)
            step = lambda s: -rate * (classes - 1) / classes * s[..., 0] / (s[..., 1] + smoothing)
            for k, t in enumerate(these):
                for c in range(classes):
                    for j in range(here):
                        node, whole = first + j, total[k, c, j, 0, 0]
                        if level and feature[t, c, (node - 1) // 2] < 0:
                            continue
                        if level == 0:
                            value[t, c, 0] = step(whole)
                        if most[k, c, j] <= 1e-9:
                            continue
                        f, b = divmod(int(best[k, c, j]), BINS)
                        feature[t, c, node], cut[t, c, node] = f, b
                        gains[f] += most[k, c, j]
                        side = left[k, c, j, f, b]
                        value[t, c, 2 * node + 1], value[t, c, 2 * node + 2] = step(side), step(whole - side)
    one = np.zeros((trees, classes, nodes, classes))
    for c in range(classes):
        one[:, c, :, c] = value[:, c]
    flat = feature.reshape(-1, nodes)
    limits = _limits(blocks, flat, cut.reshape(-1, nodes))
    return Ensemble(flat, limits, one.reshape(-1, nodes, classes), start, True, gains / max(gains.sum(), 1e-300))


def _with_scores(blocks: Blocks, scores: Callable[[_Block], np.ndarray]) -> Blocks:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            blobs = [scores(_Block(batch, row)).tobytes() for row in range(batch.num_rows)]
            columns = [batch.column(c) for c in ("bins", "y", "w", "key")] + [pa.array(blobs, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names)

    frame = blocks.frame.mapInArrow(run, blocks.frame.schema)
    return Blocks(cut_lineage(frame, "scores"), blocks.edges, blocks.classes, blocks.tasks)

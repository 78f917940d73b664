"""Tree ensembles against plain recursion, and the same model from every layout."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from mairie.plans import trees


def training(n=260, classes=3, seed=4):
    rng = np.random.default_rng(seed)
    x = np.column_stack([rng.normal(size=n), rng.integers(0, 6, n), np.round(rng.normal(size=n), 1), np.full(n, 7.0)])
    y = ((x[:, 0] > 0).astype(int) + (x[:, 1] > 3) + (rng.random(n) < 0.1)) % classes
    return x, y, np.arange(n) * 17 - 300


def frame(spark, x, y, keys, weights=None):
    weights = np.ones(len(y)) if weights is None else weights
    rows = [(v.tolist(), int(k), float(w), int(i)) for v, k, w, i in zip(x, y, weights, keys, strict=True)]
    return spark.createDataFrame(rows, "x array<double>, y int, w double, key bigint")


def test_quantile_edges_are_exact(spark):
    rng = np.random.default_rng(1)
    x = np.column_stack([
        rng.normal(size=501) * 10.0 ** rng.integers(-200, 200, 501), rng.integers(-3, 3, 501) * 0.0 + rng.integers(0, 2, 501),
        np.where(rng.random(501) < 0.1, np.nan, rng.choice([-np.inf, -1.5, 1.5, np.inf], 501)),
    ])
    got = trees.quantile_edges(frame(spark, x, np.zeros(501), range(501)).repartition(5), 3, 501, 10)
    ranks = [-(-501 * k // 10) - 1 for k in range(1, 10)]
    for f in range(3):
        want = np.unique(np.sort(x[:, f] + 0.0)[ranks])
        assert np.array_equal(got[f], want, equal_nan=True)


def test_edges_of_one_row(spark):
    blocks = trees.prepare(frame(spark, np.array([[2.0, -1.0]]), [0], [5]), 2, 1)
    assert [e.tolist() for e in blocks.edges] == [[2.0], [-1.0]]
    model = trees.grow_forest(blocks, 3, 2)
    assert model.probabilities(np.array([[0.0, 0.0]])).tolist() == [[1.0]]


def gini_tree(bins, y, w, n, classes, depth, least):
    """Best split over all features and bins by recursion; the first one on a tie."""
    share = np.bincount(y, w, classes)
    if depth == 0:
        return share
    pure = lambda s: (s**2).sum() / max(s.sum(), 1)
    best = (1e-9 * 2**24, None)
    for f in range(len(bins)):
        for b in range(trees.BINS):
            left = bins[f] <= b
            if n[left].sum() < least or n[~left].sum() < least:
                continue
            gain = pure(np.bincount(y[left], w[left], classes)) + pure(np.bincount(y[~left], w[~left], classes)) - pure(share)
            if gain > best[0]:
                best = (gain, (f, b))
    if best[1] is None:
        return share
    f, b = best[1]
    left = bins[f] <= b
    sides = [gini_tree(bins[:, side], y[side], w[side], n[side], classes, depth - 1, least) for side in (left, ~left)]
    return (f, b, *sides)


def follow(tree, bins):
    while isinstance(tree, tuple):
        f, b, left, right = tree
        tree = left if bins[f] <= b else right
    return tree / tree.sum()


def test_forest_against_recursion(spark):
    x, y, keys = training()
    weights = np.where(y == 0, 0.5, 1.25)
    blocks = trees.prepare(frame(spark, x, y, keys, weights), 4, 3)
    model = trees.grow_forest(blocks, 4, 3, 3, features=4, seed=9)
    bins = np.stack([np.searchsorted(e, x[:, f]) for f, e in enumerate(blocks.edges)])
    want = np.zeros((len(y), 3))
    for t in range(4):
        n = np.searchsorted(trees._DRAWS, trees.uniform(keys, t, 9), "right")
        use = n > 0
        grown = gini_tree(bins[:, use], y[use], n[use] * np.rint(weights[use] * 2**24), n[use], 3, 3, 3)
        want += np.array([follow(grown, bins[:, i]) for i in range(len(y))])
    np.testing.assert_allclose(model.probabilities(x), want / want.sum(axis=1, keepdims=True), rtol=1e-12)
    assert 0.6 < np.mean(trees.uniform(np.arange(20_000), 3, 1) < 0.632) < 0.66


def newton_round(bins, y, logits, depth, rate, classes):
    p = trees.softmax(logits)
    out = logits.copy()
    for c in range(classes):
        g, h = np.rint((p[c] - (y == c)) * 2**24) / 2**24, np.rint(p[c] * (1 - p[c]) * 2**24) / 2**24
        score = lambda s: g[s].sum() ** 2 / (h[s].sum() + 1.0)

        def grow(rows, left_depth):
            best = (1e-9, None)
            for f in range(len(bins) if left_depth else 0):
                for b in range(trees.BINS):
                    side = rows & (bins[f] <= b)
                    if h[side].sum() < 1e-3 or h[rows & ~side].sum() < 1e-3:
                        continue
                    gain = score(side) + score(rows & ~side) - score(rows)
                    if gain > best[0] + 1e-12:
                        best = (gain, side)
            if best[1] is None:
                out[c][rows] -= rate * (classes - 1) / classes * g[rows].sum() / (h[rows].sum() + 1.0)
            else:
                grow(best[1], left_depth - 1)
                grow(rows & ~best[1], left_depth - 1)

        grow(np.ones(len(y), bool), depth)
    return out


def test_boosting_against_recursion(spark):
    x, y, keys = training()
    blocks = trees.prepare(frame(spark, x, y, keys), 4, 3)
    model = trees.boost(blocks, 3, 2, 0.3, sampled=1.0, together=1)
    bins = np.stack([np.searchsorted(e, x[:, f]) for f, e in enumerate(blocks.edges)])
    logits = np.repeat(np.log(np.bincount(y) / len(y))[:, None], len(y), axis=1)
    for _ in range(3):
        logits = newton_round(bins, y, logits, 2, 0.3, 3)
    np.testing.assert_allclose(model.probabilities(x), trees.softmax(logits).T, rtol=1e-9)


@pytest.mark.parametrize("grow", [
    lambda b: trees.grow_forest(b, 12, 5, 3),
    lambda b: trees.boost(b, 12, 3, 0.1, 0.8, 3),
], ids=["forest", "boosting"])
def test_layout_does_not_matter(spark, monkeypatch, grow):
    x, y, keys = training()
    rows = frame(spark, x, y, keys)
    first = grow(trees.prepare(rows.repartition(4), 4, 3))
    monkeypatch.setattr(trees, "MAX_CELLS", 2_000)
    monkeypatch.setattr(trees, "CHECKPOINT_ROUNDS", 1)
    other = grow(trees.prepare(rows.orderBy(F.desc("key")).repartition(64), 4, 3, task_rows=30))
    for name in ("feature", "limit", "value", "start", "gains"):
        np.testing.assert_allclose(getattr(first, name), getattr(other, name), rtol=1e-12, err_msg=name)
    assert (first.feature == other.feature).all()
    assert (first.probabilities(x).argmax(axis=1) == y).mean() > 0.75


def test_tasks_follow_rows(spark):
    x, y, keys = training(1_000)
    blocks = trees.prepare(frame(spark, x, y, keys), 4, 3, task_rows=100)
    assert blocks.tasks == 10 and blocks.frame.count() >= 9


def test_nan_goes_right_in_training_and_scoring(spark):
    x = np.array([[v] for v in [1.0, 2.0, np.nan, np.nan] * 30])
    y = np.isnan(x[:, 0]).astype(int)
    model = trees.grow_forest(trees.prepare(frame(spark, x, y, range(120)), 1, 2), 5, 2)
    assert (model.probabilities(x).argmax(axis=1) == y).all()

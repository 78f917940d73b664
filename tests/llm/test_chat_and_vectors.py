"""Chat formatting round trips and vectors against brute force."""

import hashlib
import re
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

import oracle
from mairie.llm import chat, vectors
from mairie.llm.queries import ORACLES, QUERIES
from mairie.llm.tokens import encoder

SF = "/root/testdata/sf0.001"


def test_query_equals_sql(spark):
    got = QUERIES["op1_chat_formatting"](spark, SF).toArrow()
    assert oracle.compare(got, oracle.run_oracle(oracle.connect(SF), ORACLES["op1_chat_formatting"])) is None


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet=st.sampled_from(list("\\#/<>turn \nA:é")), max_size=40))
def test_escape_round_trip(text):
    escaped = chat.escape(text)
    assert chat.unescape(escaped) == text
    # Read from the left, every control string of the template stands behind a backslash.
    assert not re.search(r"###|</turn>", re.sub(r"\\(\\|###|</turn>)", "_", escaped))


def test_awkward_turns(spark):
    rows = [
        (1, 0, "user", None), (1, 1, "assistant", "a\\b ### </turn>"), (1, None, None, "first"), (2, 0, "tool: x", "y"),
        (2, 0, "tool: x", "y"), (None, 0, "assistant", "z" * 100_000), (3, 0, "assistant", ""),
    ]
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").selectExpr("*", "1 as ids")
    got = {r.conv_id: r for r in chat.conversation_digests(chat.format_turns(df)).collect()}
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    assert got[1].turns_sha256 == sha("\nfirst\nuser\n\nassistant\na\\b ### </turn>\n")
    assert (got[1].n_turns, got[1].loss_chars, got[1].loss_sha256) == (3, 15, sha("a\\b ### </turn>"))
    assert got[2].turns_sha256 == sha("tool: x\ny\n" * 2) and got[2].loss_sha256 == sha("")
    assert got[None].loss_chars == 100_000 and got[3].loss_chars == 0
    assert chat.conversation_digests(chat.format_turns(df.limit(0))).count() == 0


def test_mask_covers_the_assistants_text_only(spark):
    df = spark.createDataFrame([(1, 0, "user", "hi"), (1, 1, "assistant", "yes it is")], "conv_id bigint, turn bigint, role string, text string")
    rows = {r.turn: r for r in chat.format_turns(df).collect()}
    ids, mask = np.frombuffer(rows[1].ids, "<u4"), np.frombuffer(rows[1].loss_mask, np.int8)
    assert encoder().decode(ids[mask == 1]) == "yes it is" and not np.frombuffer(rows[0].loss_mask, np.int8).any()


def brute(ids, x, labels):
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    link = (u @ u.T >= 0.98) & (labels[:, None] == labels[None])
    np.fill_diagonal(link, False)
    low = ids.copy()
    for _ in ids:
        low = np.minimum(low, np.where(link, low[None], ids.max()).min(axis=1))
    return link.sum(axis=1), low


@pytest.mark.parametrize("block", [16, 1024])
def test_vectors_against_brute_force(spark, block):
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(40, 24))
    x = np.concatenate([centres, centres[rng.integers(0, 12, 260)] + rng.normal(scale=0.06, size=(260, 24)), np.repeat(centres[:1], 60, axis=0)])
    x, labels, ids = x.astype(np.float32).astype(float), rng.integers(0, 3, len(x)), np.arange(len(x)) * 3
    df = spark.createDataFrame([(int(i), v.tolist(), int(k)) for i, v, k in zip(ids, x, labels, strict=True)], "vec_id bigint, embedding array<float>, label int")
    got = sorted(map(tuple, vectors.near_vectors(df, block=block).collect()))
    links, low = brute(ids, x, labels)
    assert links.sum() > 1000
    assert [g[1] for g in got] == links.tolist() and [g[2] for g in got] == low.tolist()


def test_awkward_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, [1.0, 0.0], 1), (2, [1.0, 0.0], 1), (2, [1.0, 0.0], 1), (3, [1.0, 0.0], None), (4, None, 1), (5, [], 1), (6, [0.0, 0.0], 1),
        (7, [nan, 1.0], 1), (8, [inf, 1.0], 1), (9, [None, 1.0], 1), (None, [1.0, 0.0], 1), (10, [1.0, 0.0, 0.0], 1), (11, [2.0, 0.0], 1),
    ]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, label int").selectExpr("*", "1 as id", "2 as n")
    got = vectors.near_vectors(df)
    assert got.count() == 13
    by = {r.vec_id: r for r in got.collect()}
    assert (by[1].n_links, by[1].component_id, by[11].n_links, by[11].component_id) == (3, 1, 3, 1)
    assert all(by[k].n_links == 0 and by[k].kept for k in (3, 4, 5, 6, 7, 8, 9, 10, None))
    assert vectors.near_vectors(df.limit(0)).count() == 0


def test_cells_are_walked_nearest_first_up_to_the_limit():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(300, 8))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    index = vectors.MultiIndex(x, 12, 0.9)
    for row, cells, a, b in zip(x[:40], index.visits(x[:40]), *index.margins(x[:40]), strict=True):
        far = index.squares(np.repeat(row[None], 144, axis=0), np.arange(144))
        assert set(cells) == set(np.flatnonzero(far <= index.limit).tolist()) and len(set(cells)) == len(cells)
        assert (np.diff(far[cells]) >= 0).all()
        walk = [cell for _, cell in index._walk(a**2, b**2)]
        assert walk[: len(cells)] == cells and sorted(walk) == list(range(144))


def test_labels_and_components_keep_their_type(spark):
    rows = [(1, [1e-60, 0.0], "x"), (2, [2e-60, 0.0], "x"), (3, [1e-200, 1e-210], "x"), (4, [1e300, 0.0], "y"), (5, [0.0, 1e300], "y"), (6, [3e300, 0.0], "y")]
    got = {r.vec_id: (r.n_links, r.component_id) for r in vectors.near_vectors(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label string")).collect()}
    assert got == {1: (2, 1), 2: (2, 1), 3: (2, 1), 4: (1, 4), 5: (0, 5), 6: (1, 4)}
    rows = [(1, [1.0, 0.0], 1.2), (2, [2.0, 0.0], 1.9), (3, [3.0, 0.0], 1.2)]
    got = vectors.near_vectors(spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, label double"))
    assert {r.vec_id: r.component_id for r in got.collect()} == {1: 1, 2: 2, 3: 1}


def test_vectors_under_one_id_are_counted_apart(spark):
    rows = [(1, [1.0, 0.0], 1), (2, [1.0, 0.1], 1), (2, [1.0, 0.12], 1), (3, [0.0, 1.0], 1)]
    got = sorted(map(tuple, vectors.near_vectors(spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, label int")).collect()))
    assert got == [(1, 2, 1, True), (2, 2, 1, False), (2, 2, 1, False), (3, 0, 3, True)]


def unit(x):
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def near_block(n):
    """An index, ``n`` vectors that nearly all link, and the rows of the block in which each is home and visitor."""
    rng = np.random.default_rng(4)
    x = unit(unit(rng.normal(size=(1, 64))) + rng.normal(scale=0.015, size=(n, 64)))
    index = vectors.MultiIndex(np.concatenate([unit(rng.normal(size=(3000, 64))), x[:30]]), 64, 0.98)
    order = np.arange(n)
    rows = pa.table({
        "key": np.tile(order, 2), "label": ["a"] * (2 * n), "visitor": np.repeat([False, True], n), "cell": np.zeros(2 * n, np.int64),
        "strip": np.zeros(2 * n, np.int32), "cells": pa.array([[0]] * (2 * n), pa.list_(pa.int32())),
        "home_block": np.zeros(2 * n, np.int32), "visit_block": np.zeros(2 * n, np.int32), "id": np.tile(order * 2, 2), "n": np.tile(order % 3 + 1, 2),
        "embedding": pa.array([*x.tolist()] * 2),
    })
    return index, x, rows


def test_memory_of_a_block_whose_vectors_all_link():
    n = 700
    index, x, rows = near_block(n)
    link = x @ x.T >= 0.98
    np.fill_diagonal(link, False)
    assert link.mean() > 0.9
    visited = np.array([index.squares(x, np.full(n, cell)) <= index.limit for cell in index.home(x)])
    # A visitor counts the homes, and a home the visitors whose cells it does not visit.
    want = link @ (np.arange(n) % 3 + 1) + (link & ~visited.T) @ (np.arange(n) % 3 + 1)
    tracemalloc.start()
    found = pa.Table.from_batches(vectors._verify(index, 0.98)(rows.to_batches())).to_pylist()
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 60e6
    assert {r["key"]: r["links"] for r in found if r["key"] is not None} == {k: v for k, v in enumerate(want.tolist()) if v}
    edges = [(r["a"], r["b"]) for r in found if r["key"] is None]
    assert {a for a, _ in edges} == set(range(2, 2 * n, 2)) and {b for _, b in edges} == {0}


def test_parts_of_a_block_give_what_the_whole_gives():
    index, _, rows = near_block(150)
    whole, edges = vectors._links(index, 0.99, rows)
    assert whole.any()
    for part in (1, 7, 64):
        links, other = vectors._links(index, 0.99, rows, part)
        assert (links == whole).all() and sorted(other) == sorted(edges)


@pytest.mark.parametrize("share", [0.0, 0.01, 0.03, 0.1, 1.0])
def test_tree_connects_what_links_connect(share):
    rng = np.random.default_rng(int(share * 100))
    for shape in [(1, 1), (40, 60), (60, 3), (0, 4)]:
        link = rng.random(shape) < share
        a, b = vectors._tree(link)
        assert link[a, b].all()

        def groups(u, v):
            low = np.arange(sum(shape))
            for _ in range(len(low)):
                least = np.minimum(low[u], low[v + shape[0]])
                np.minimum.at(low, u, least)
                np.minimum.at(low, v + shape[0], least)
            return low

        assert (groups(a, b) == groups(*np.nonzero(link))).all()
        assert len(a) == sum(shape) - len(set(groups(a, b)))


def test_a_near_group_does_not_fill_the_codebooks():
    rng = np.random.default_rng(5)
    group = unit(unit(rng.normal(size=(1, 64))) + rng.normal(scale=0.0135, size=(600, 64)))
    index = vectors.MultiIndex(np.concatenate([unit(rng.normal(size=(1400, 64))), group]), 100, 0.98)
    # Else a third of the codewords lie among its vectors, and each of these visits hundreds of cells.
    assert [len(book) for book in index.books] == [100, 100]
    assert max(map(len, index.visits(group[:50]))) < 40


def test_sample_is_what_sorting_all_gives(spark, monkeypatch):
    monkeypatch.setattr(vectors, "SAMPLE", 50)
    rows = spark.createDataFrame([(i, [float(i)]) for i in range(3000)], "id bigint, embedding array<double>")
    for classes in (rows, rows.limit(49), rows.selectExpr("case when id < 2900 then 3001 else id end as id", "embedding")):
        got = [v for (v,) in vectors._sample(classes, classes.count())["embedding"].to_pylist()]
        want = classes.selectExpr("id", "xxhash64(id) as h", "embedding[0] as v").orderBy("h", "id").limit(50).collect()
        if classes.select("id").distinct().count() > 200:
            assert got == [r.v for r in want]
        assert len(got) == len(want)


def test_a_vector_goes_once_to_each_strip_it_visits():
    index, x, rows = near_block(30)
    x = np.concatenate([x, unit(np.random.default_rng(6).normal(size=(50, 64)))])
    batch = pa.record_batch({"key": np.arange(80), "embedding": pa.array(x.tolist())})
    (placed,) = vectors._places(index)(iter([batch]))
    across = len(index.books[1])
    for row, cells, home in zip(placed.to_pylist(), index.visits(x), index.home(x), strict=True):
        first, *rest = row["places"]
        assert first == {"visitor": False, "strip": home // across, "cells": [home]}
        assert all(p["visitor"] and {c // across for c in p["cells"]} == {p["strip"]} for p in rest)
        assert len({p["strip"] for p in rest}) == len(rest) and sorted(c for p in rest for c in p["cells"]) == sorted(cells)

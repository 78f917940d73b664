"""The pipeline stage by stage, each on what the one before kept, and the whole of ``run``."""

import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

import corpus_pipeline
from mairie.llm import lines, mixing, packing, pii
from mairie.llm.common import store
from mairie.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
WEIGHTS = (5, 2, 1)


@pytest.fixture(scope="module")
def stages(spark):
    """Input and output of each stage by name."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = {}
    for name, stage in corpus_pipeline.STAGES:
        made = store(stage(spark, docs, SF), name)
        out[name] = docs, made
        docs = made
    return out


def shingles(text, words):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    w = words(low)
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} or ({tuple(w)} if w else set())


def targets(sizes):
    """Targets by source from the sizes by source: shares by weight, full sources set aside until none is above."""
    order = sorted((s for s in sizes if s is not None), key=lambda s: s.encode("utf-32-be")) + [None] * (None in sizes)
    weight = {s: WEIGHTS[k % 3] for k, s in enumerate(order)}
    fixed = {}
    while True:
        open_ = [s for s in order if s not in fixed]
        rest = sum(sizes.values()) - sum(fixed.values())
        share = {s: rest * weight[s] / sum(weight[x] for x in open_) for s in open_}
        above = [s for s in open_ if share[s] > 3 * sizes[s]]
        if not above:
            return fixed | share
        fixed |= {s: 3.0 * sizes[s] for s in above}


def test_quality_rejects_what_its_rules_reject(spark, stages, words):
    before, after = stages["quality"]
    verdict = {r.doc_id: r for r in lines.judge_documents(before).collect()}
    texts = {r.doc_id: r.text for r in before.collect()}
    left = {r.doc_id: r.text for r in after.collect()}
    assert set(left) == {i for i, r in verdict.items() if r.kept} and after.columns == before.columns
    for i, text in texts.items():
        assert len(words(text)) >= 10 or i not in left
    assert all(len(words(texts[i])) - len(words(t)) == verdict[i].n_removed_words for i, t in left.items())


def test_one_document_of_each_group_stays(spark, stages, words):
    before, after = stages["near_dedup"]
    sets = {r.doc_id: shingles(r.text, words) for r in before.collect()}
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a in sets:
        for b in sets:
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                parent[max(root(a), root(b))] = min(root(a), root(b))
    assert {r.doc_id for r in after.collect()} == {i for i in sets if root(i) == i} and after.columns == before.columns


def test_no_personal_data_is_left(spark, stages):
    before, after = stages["pii"]
    texts = {r.doc_id: r.text for r in before.collect()}
    masked = {r.doc_id: r.text for r in after.collect()}
    assert set(texts) == set(masked) and after.columns == before.columns
    for i, text in texts.items():
        assert pii.base_spans(masked[i]) == []
        assert masked[i] == text or re.search("<(email|ip|card|phone)>", masked[i])


def test_mix_takes_each_sources_share(spark, stages, words):
    before, after = stages["mixing"]
    source, size = {}, {}
    for r in before.collect():
        source[r.doc_id], size[r.doc_id] = r.source, len(words(r.text))
    by = Counter()
    for i, n in size.items():
        by[source[i]] += n
    rows = after.collect()
    copies, taken = Counter(r.doc_id for r in rows), Counter()
    for i, n in copies.items():
        assert n <= 3
        taken[source[i]] += n * size[i]
    for s, target in targets(by).items():
        assert abs(taken[s] - target) <= max(size[i] for i in size if source[i] == s) / 2 + 1e-6
    assert after.columns == before.columns and set(rows) <= set(before.collect())


def test_packing_holds_every_document_whole(spark, stages):
    before, after = stages["packing"]
    whole = Counter(bytes(b"".join(r.ids for r in packing.cut_pieces(before.where(f"doc_id = {i}").limit(1)).orderBy("start").collect()))
                    for i in [r.doc_id for r in before.select("doc_id").distinct().limit(5).collect()])
    rows, places = after.collect(), defaultdict(list)
    for r in rows:
        places[r.sequence_id].append((r.offset, r.length))
        assert len(r.ids) == 4 * r.length
    for place in places.values():
        place.sort()
        assert [o for o, _ in place] == list(np.cumsum([0] + [n for _, n in place[:-1]])) and sum(place[-1]) <= 1024
    documents = defaultdict(list)
    for r in rows:
        documents[r.doc_id].append(r)
    copies = Counter(r.doc_id for r in before.collect())
    assert set(copies) == set(documents)
    for i, mine in documents.items():
        starts = Counter((r.start, r.length) for r in mine)
        assert set(starts.values()) == {copies[i]} and sum(n for _, n in starts) == mine[0].doc_tokens
        text = b"".join(bytes(next(r.ids for r in mine if r.start == s)) for s, _ in sorted(starts))
        assert np.frombuffer(text, "<u4")[-1] == 0
        whole.pop(text, None)
    assert not whole
    assert len(places) <= 1.1 * -(-sum(r.length for r in rows) // 1024) + 1


def test_run_equals_its_stages(spark, stages):
    got = corpus_pipeline.run(spark, SF)
    keys = ["doc_id", "start", "length", "doc_tokens"]
    count = lambda df: Counter((*(r[k] for k in keys), zlib.crc32(r.ids)) for r in df.collect())
    assert count(got) == count(stages["packing"][1])


def test_op7_targets(spark, words):
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    by = Counter()
    for r in docs:
        by[r.source] += len(words(r.text))
    want, source = targets(by), {r.doc_id: r.source for r in docs}
    for r in QUERIES["op7_source_mixing"](spark, SF).collect():
        assert r.source_size == by[source[r.doc_id]] and r.target == pytest.approx(want[source[r.doc_id]])


def test_shards_hold_what_the_tree_deals(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    options = {"block_words": 500, "shard_words": 4_000}
    rows = mixing.mix_documents(docs, **options).where("shard is not null").collect()
    shards = defaultdict(list)
    for r in rows:
        shards[r.shard].append(r)
    words = sum(r.size for r in rows)
    assert len(shards) == -(-words // 4_000)
    for mine in shards.values():
        assert sorted(r.position for r in mine) == list(range(len(mine)))
    # A random deal of blocks: no source is alone in a shard, and shards are about equally large.
    sizes = [sum(r.size for r in mine) for mine in shards.values()]
    assert max(sizes) < 3 * np.mean(sizes)
    laid = mixing.mixed_rows(docs, **options)
    order = [r.doc_id for p in laid.rdd.glom().collect() for r in p]
    assert Counter(order) == Counter(r.doc_id for r in rows)
    by_shard = {tuple(r.doc_id for r in sorted(mine, key=lambda r: r.position)) for mine in shards.values()}
    joined = ",".join(map(str, order))
    assert all(",".join(map(str, run)) in joined for run in by_shard)


def test_subtrees_deal_as_the_whole_tree(spark, monkeypatch):
    quotas = [900, 1, 0, 37, 250]
    dealt = mixing.split_quotas(np.array(quotas), 41, 3)
    for subtrees in (1, 4, 256):
        monkeypatch.setattr(mixing, "SUBTREES", subtrees)
        rows = mixing.block_shards(spark, quotas, 41, 3).collect()
        got = Counter((r.shard, r.source_no) for r in rows)
        assert got == Counter({(i, k): int(n) for (i, k), n in np.ndenumerate(dealt) if n})
        assert all(sorted(r["rank"] for r in rows if r.source_no == k) == list(range(n)) for k, n in enumerate(quotas))


def test_rows_that_share_id_and_text_share_their_copies(spark):
    rows = [(1, "a b c", "s", k) for k in range(10)] + [(None, "a b c", "s", k) for k in range(10)] + [(2, "d", "s", 1), (3, None, "s", 2), (4, "", None, 3)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string, n long").selectExpr("*", "7 as shard", "'x' as copy")
    got = Counter((r.doc_id, r.text, r.n) for r in mixing.mixed_rows(docs).collect())
    assert got == Counter({(i, t, n): 1 for i, t, _, n in rows if t})
    assert mixing.mixed_rows(docs).columns == docs.columns


def test_op6_columns_against_their_rules(spark):
    docs = {r.doc_id: r for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    langs = {r.lang for r in docs.values()}
    for r in QUERIES["op6_language_id"](spark, SF).collect():
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
        assert (r.lang_pred == "und") == (not any(c.isalpha() for c in docs[r.doc_id].text or "")) or r.lang_pred in langs

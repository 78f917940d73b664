"""Page text, manifest and hard negatives against brute force, and on awkward rows."""

import hashlib
import math
import zlib
from collections import defaultdict
from html.parser import HTMLParser

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import oracle
from mairie.llm import extraction, manifest, negatives
from mairie.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ["op12_merkle_manifest", "op13_hard_negatives"])
def test_query_equals_sql(spark, name):
    got = QUERIES[name](spark, SF).toArrow()
    assert oracle.compare(got, oracle.run_oracle(oracle.connect(SF), ORACLES[name])) is None


# ---- pages


class Article(HTMLParser):
    """The blocks inside <article>, by the standard library's parser."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.inside, self.blocks = 0, [""]

    def handle_starttag(self, tag, attrs):
        self.inside += tag == "article"
        if tag in ("p", "h1", "h2", "article"):
            self.blocks.append("")
        elif tag == "br":
            self.handle_data(" ")

    def handle_endtag(self, tag):
        self.inside -= tag == "article"
        if tag in ("p", "h1", "h2", "article"):
            self.blocks.append("")

    def handle_data(self, data):
        if self.inside:
            self.blocks[-1] += data


def test_pages_against_another_parser(spark):
    rows = spark.read.parquet(f"{SF}/pages.parquet").collect()
    got = {r.page_id: r for r in QUERIES["op11_html_extraction"](spark, SF).collect()}
    assert len(got) == len(rows)
    for r in rows:
        parser = Article()
        parser.feed(r.html)
        parser.close()
        text = "\n".join(t for t in (" ".join(b.split()) for b in parser.blocks) if t)
        assert (got[r.page_id].url, got[r.page_id].text, got[r.page_id].n_chars) == (r.url, text, len(text))


BODY = [
    "The mill by the weir has been sold to a family that wants to grind corn there again, as was done for centuries.",
    "Not yet.",
    "The wheel is broken, the roof leaks in two places and the race is full of mud, but the stones are said to be sound.",
]


@pytest.mark.parametrize("page", [
    "<nav><a href=/>Home</a></nav><article><h1>Mill sold</h1>{}</article><aside><p>The ten best mills of the valley, with photos and times of opening.</p></aside>",
    "<article><h1>Mill sold</h1>{}</article>",
    "<div class='cookie banner'><p>This site uses cookies so that it can show you what you like best.</p></div><main><h1>Mill sold</h1>{}</main><form><p>Sign up</p></form>",
    "<article><h1>Mill sold</h1>{}<section id=comments><p>My grandfather used to work there and he would have been glad to read this.</p></section></article><footer>End</footer>",
    "<header><p>The Valley Courier, since 1900</p></header><div class=content><h1>Mill sold</h1>{}</div><div id='side-bar' class='sidebar'>Most read this week in the valley</div>",
    "<ul><li><a href=/1>Home</a><li><a href=/2>All news</a></ul><h1>Mill sold</h1>{}<script>document.write('<p>buy</p>')</script><style>p{{}}</style><ul><li><a href=/3>Imprint</a></ul>",
])
def test_layouts_the_tree_has_not_seen(page):
    got = extraction.article_text(page.format("".join(f"<p>{b}</p>" for b in BODY)))
    assert got == "\n".join(["Mill sold", *BODY])


def test_markup_details():
    def page(inner):
        return [b.text for b in extraction.blocks(inner)]

    assert page("<p>a&nbsp;&amp;\n b<br>c</p>") == ["a & b c"]
    assert page("<p>a<b>b</b><!-- <p>x</p> -->c</p>d") == ["abc", "d"]
    assert page("<P TITLE='a>b'>x</P>1 < 2 &lt;p&gt; &#233;&am") == ["x", "1 < 2 <p> é&am"]
    assert page("<script>if (a</b>c) '</p>'</script>t<script>never closed <p>x") == ["t"]
    assert page("<p>x<a href=") == ["x"] and page("<!-- open <p>x") == [] and page("<p> \n </p>") == []
    assert [b.linked for b in extraction.blocks("<p>one <a href=x>two three</a></p>")] == [2]


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet=st.sampled_from(list("<>/!-ap&;\"'= x")), max_size=60))
def test_any_markup_is_read(text):
    assert "<p>" not in "".join(b.text for b in extraction.blocks(text + "<p>")) or "&" in text


def test_long_and_broken_pages_take_linear_time():
    for piece in ("<a ", "<!-- ", "<p class=\"", "</", "<script>", "&amp", "<p>x", "< "):
        extraction.blocks(piece * 100_000)


def test_awkward_pages(spark):
    rows = [(1, None, "u"), (2, "", None), (None, "<article><p>Some words of an article, and a few more to make it long.</article>", "u"), (2, "", None)]
    df = spark.createDataFrame(rows, "page_id bigint, html string, url string").selectExpr("*", "'clash' as text")
    got = sorted((tuple(r) for r in extraction.main_text(df).collect()), key=str)
    assert got == sorted([(1, "u", ""), (2, None, ""), (2, None, ""), (None, "u", "Some words of an article, and a few more to make it long.")], key=str)
    assert extraction.main_text(df.limit(0)).count() == 0


# ---- manifest


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(r, text):
    fields = (r.doc_id, r.source, r.lang, r.n_chars, text)
    return sha(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in fields])


def grown(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([sha(*levels[-1][k : k + 8]) for k in range(0, len(levels[-1]), 8)])
    return levels


def walk(levels, place):
    for level in levels[:-1]:
        run, slot = level[place // 8 * 8 : place // 8 * 8 + 8], place % 8
        yield "".join(run[:slot]), "".join(run[slot + 1 :])
        place //= 8


def brute_manifest(rows):
    by = defaultdict(list)
    for r in rows:
        by[r.lang].append((r.doc_id is not None, r.doc_id or 0, leaf_of(r, r.text), r))
    for group in by.values():
        group.sort(key=lambda x: x[:3])
    trees = {lang: grown([x[2] for x in group]) for lang, group in by.items()}
    langs = sorted(trees, key=lambda x: (x is not None, (x or "").encode()))
    top = grown([trees[lang][-1][0] for lang in langs])
    for lang, group in by.items():
        for place, (_, _, leaf, r) in enumerate(group):
            path = [*walk(trees[lang], place), *walk(top, langs.index(lang))]
            text = r.text
            if text is not None and r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 3 == 0:
                text = text.translate({c: c + 32 for c in range(65, 91)})
            root = leaf_of(r, text)
            for left, right in path:
                root = sha(left, root, right)
            yield r.doc_id, leaf, trees[lang][-1][0], top[-1][0], sha(*[a + b for a, b in path]), root, root == top[-1][0]


def checked(docs):
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    tree = manifest.build(docs, changed=manifest.lowered_leaf(tampered))
    got = manifest.verify(tree, F.coalesce("changed", "leaf"))
    return sorted((tuple(r) for r in got.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified").collect()), key=str)


def test_manifest_of_awkward_rows(spark, documents):
    """Null and repeated ids, null languages, equal rows and clashing columns."""
    more = spark.range(600).selectExpr(
        "case when id % 3 = 0 then null when id % 3 = 1 then 5 else id * 1000 - 300000 end as doc_id", "concat('Text ', id % 7) as text",
        "case when id % 5 = 0 then null when id = 1 then 'é' else 'en' end as lang", "'s' as source", "cast(1 as bigint) as n_chars",
    )
    edges = spark.sql("select explode(array(63, 64, -1, -64, 9223372036854775807, -9223372036854775807 - 1)) as doc_id, 'A' as text, 'en' as lang, 's' as source, cast(0 as bigint) as n_chars")
    both = documents.select("doc_id", "text", "lang", "source", "n_chars").union(more).union(edges).selectExpr("*", "1 as key", "2 as place", "'x' as leaf")
    assert checked(both) == sorted(brute_manifest(both.collect()), key=str)


def test_small_manifests(spark, documents):
    one = documents.where("doc_id = 1")
    ((_, leaf, subroot, root, proof, folded, ok),) = checked(one)
    assert leaf == subroot == root == folded and proof == sha("") and ok
    assert checked(documents.limit(0)) == []
    nine = spark.range(9).selectExpr("id as doc_id", "'t' as text", "'en' as lang", "'s' as source", "id as n_chars")
    assert checked(nine) == sorted(brute_manifest(nine.collect()), key=str)


def test_ranks_cross_slices(spark, monkeypatch):
    monkeypatch.setattr(manifest, "SLICE_ROWS", 7)
    docs = spark.range(500).selectExpr("id * 97 % 501 * 40 as doc_id", "'t' as text", "'en' as lang", "'s' as source", "id as n_chars")
    assert checked(docs) == sorted(brute_manifest(docs.collect()), key=str)


# ---- hard negatives


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 40), st.integers(1, 60), st.integers(0, 2**31), st.data())
def test_table_scores_are_inner_products(width, rows, seed, data):
    rng = np.random.default_rng(seed)
    size = data.draw(st.sampled_from([1, 3, 200, 2**20]))
    anchors, others = rng.integers(-size, size, (5, width)), rng.integers(-size, size + 1, (rows, width))
    got = negatives.exact_scores(negatives.subset_tables(anchors), negatives.plane_bytes(others))
    assert (got == others @ anchors.T).all()


def brute_negatives(rows):
    kept = [(i, label, [math.floor(256 * float(v)) for v in x]) for i, label, x in rows
            if label is not None and x is not None and all(v is not None and math.isfinite(v) for v in x)]
    last = lambda i: (i is None, i or 0)
    dot = lambda a, b: sum(p * q for p, q in zip(a, b))
    out, seen = [], set()
    for i, label, x in kept:
        if i is None or i % 100 or (i, label, tuple(x)) in seen:
            continue
        seen.add((i, label, tuple(x)))
        scored = sorted(((-dot(x, y), last(j), j, other) for j, other, y in kept), key=lambda t: t[:2])
        positives = [(j, -s) for s, _, j, other in scored if other == label and j != i][:5]
        for j, p in positives:
            near = [(k, -s) for s, _, k, other in scored if other != label and 30 * p <= -100 * s <= 90 * p][:10]
            out += [(i, j, rank + 1, k, p, s) for rank, (k, s) in enumerate(near)]
    return sorted(out, key=str)


def mined(spark, rows, label="int", **settings):
    df = spark.createDataFrame(rows, f"vec_id bigint, label {label}, embedding array<double>").selectExpr("*", "1 as x", "2 as anchor", "3 as slice")
    got = negatives.hard_negatives(df, F.col("vec_id") % 100 == 0, **settings)
    return sorted((tuple(r) for r in got.collect()), key=str)


def test_negatives_with_ties_repeats_and_odd_vectors(spark, monkeypatch):
    monkeypatch.setattr(negatives, "GROUP_ANCHORS", 3)
    monkeypatch.setattr(negatives, "TILE", 16)
    rng = np.random.default_rng(5)
    x = np.round(rng.normal(size=(300, 11)) * 4) / 4
    rows = [(k * 20, int(rng.integers(0, 3)), x[k].tolist()) for k in range(300)]
    rows += rows[:12] + [(100, 2, [4.0] * 11), (None, 1, x[0].tolist()), (None, 0, x[0].tolist()), (200, 1, [])]
    rows += [(300, 1, x[1, :5].tolist()), (400, None, x[2].tolist()), (500, 1, None), (600, 1, [None, 1.0]), (700, 1, [math.nan]), (800, 1, [math.inf])]
    got = mined(spark, rows)
    assert len(got) > 300 and got == brute_negatives(rows)


def test_negatives_of_text_labels_and_large_numbers(spark):
    rng = np.random.default_rng(6)
    rows = [(k * 50, "ab"[k % 2], (rng.normal(size=3) * 1e6).tolist()) for k in range(40)]
    assert mined(spark, rows, "string") == brute_negatives(rows) != []
    assert mined(spark, [(100, "a", [1.0])], "string") == [] and mined(spark, [(k, "a", [1e300]) for k in (100, 200)], "string") == []
    df = spark.createDataFrame([], "vec_id bigint, label int, embedding array<float>")
    assert negatives.hard_negatives(df, F.col("vec_id") % 100 == 0).count() == 0

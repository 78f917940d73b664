"""Removal of long repeated spans by compaction of a token De Bruijn graph.

A window of 13 words is an edge from its first 12 words to its last 12.  The graph holds the edges
that stand in two documents, each with its source: the smallest document that has it, and where.
Most text has no such edge, so candidates come first: every document names its anchors, the smallest
4-word hash of each window (equal windows have equal anchors, and neighbours mostly share one), and
anchors of two documents or more lead back to the windows to look at.  There, neighbouring edges
with one anchor form a run, and equal runs are one, whatever the number of documents that hold them.
Runs are noted by place and hash; what a run holds is read again in its source alone.

A node with one edge in and one edge out does not branch.  Edges that meet in such a node are joined
into one path if the source coordinates bear it out: same source document, next place there
(``compact``).  Each run is then read as pieces of paths, and pieces that follow each other in a
document and in the source at once are one repeated span (``repeated_spans``).

Edges are told apart by 96 bits of two independent hashes; nodes need 64, since a coordinate confirms
every link.  Anchors, runs, edges and degrees are counted with map-side combine, and joins have one
row per key on one side, so adaptive execution can split a passage found in a third of all documents.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from mairie.llm.common import discard, store
from mairie.llm.textbytes import buffer_of, hashed_words, mix, slices, tidy, window_hashes, word_spans
from mairie.session import broadcast_checked

WIDTH = 13
ANCHOR = 4
_U64 = np.uint64


def _anchors(words: np.ndarray) -> np.ndarray:
    """The anchor of each 13-word window of a run of words (rows not regarded)."""
    short = window_hashes(words, ANCHOR)
    n = len(words) - WIDTH + 1
    low = short[:n].copy()
    for k in range(1, WIDTH - ANCHOR + 1):
        np.minimum(low, short[k : k + n], out=low)
    return low


def _windows(texts: pa.Array) -> tuple[np.ndarray, ...]:
    """Words, row starts, and for each whole window its row, place in the row and anchor."""
    words, at = hashed_words(texts)
    n = len(words) - WIDTH + 1
    if n <= 0:
        empty = np.zeros(0, np.int64)
        return words, at, empty, empty, np.zeros(0, _U64)
    row = np.repeat(np.arange(len(at) - 1), np.diff(at))
    inside = np.flatnonzero(row[:n] == row[WIDTH - 1 :])
    return words, at, row[inside], inside, _anchors(words)[inside]


# Hashes hardly repeat, so a dictionary of them costs time and saves nothing.
HASHES = ("anchors.list.element", "anchor", "run", "edges.list.element", "checks.list.element", "nodes.list.element", "edge", "check", "pre", "post", "node")


def _store(df: DataFrame, name: str) -> DataFrame:
    return store(df, name, **{f"parquet.enable.dictionary#{c}": "false" for c in HASHES})


def _lists(counts: np.ndarray, values: pa.Array) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)), values)


def _anchor_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "_text", 4 << 20):
        _, at, row, _, anchor = _windows(batch.column("_text"))
        change = np.ones(len(row), bool)
        change[1:] = (row[1:] != row[:-1]) | (anchor[1:] != anchor[:-1])
        row, anchor = row[change], anchor[change]
        order = np.lexsort((anchor, row))
        row, anchor = row[order], anchor[order]
        first = np.ones(len(row), bool)
        first[1:] = (row[1:] != row[:-1]) | (anchor[1:] != anchor[:-1])
        counts = np.bincount(row[first], minlength=batch.num_rows)
        lists = _lists(counts, pa.array(anchor[first].view(np.int64)))
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), lists], names=["doc_id", "anchors"])


def _run_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of neighbouring windows with one wanted anchor: doc_id, start, n and run, a hash of their edges."""
    for batch in slices(batches, "_text", 4 << 20):
        words, at, row, place, anchor = _windows(batch.column("_text"))
        wanted = batch.column("wanted")
        many = np.diff(wanted.offsets.to_numpy())
        names = wanted.flatten().to_numpy().view(_U64)
        owner = np.repeat(np.arange(batch.num_rows), many).astype(_U64)
        # (row, anchor) pairs are looked up as one mixed number; a false match costs a look, no more.
        asked = np.sort(mix(names ^ mix(owner + _U64(1))))
        mine = mix(anchor ^ mix(row.astype(_U64) + _U64(1)))
        if not len(asked) or not len(mine):
            continue
        spot = np.minimum(np.searchsorted(asked, mine), len(asked) - 1)
        use = np.flatnonzero(asked[spot] == mine)
        if not len(use):
            continue
        row, place, anchor = row[use], place[use], anchor[use]
        edge = window_hashes(words, WIDTH)[place]
        new = np.ones(len(row), bool)
        new[1:] = (row[1:] != row[:-1]) | (place[1:] != place[:-1] + 1) | (anchor[1:] != anchor[:-1])
        first = np.flatnonzero(new)
        counts = np.diff(np.append(first, len(row)))
        step = mix(np.arange(len(row), dtype=_U64) - np.repeat(first, counts).astype(_U64) + _U64(7))
        run = mix(np.add.reduceat(mix(edge ^ step), first) + counts.astype(_U64))
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id").take(pa.array(row[first])),
                pa.array((place - at[row])[first].astype(np.int32)),
                pa.array(counts.astype(np.int32)),
                pa.array(run.view(np.int64)),
            ],
            names=["doc_id", "start", "n", "run"],
        )


def _edge_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The edges, checks and nodes of the runs that each text is the source of (``sources``)."""
    for batch in slices(batches, "_text", 4 << 20):
        words, at = hashed_words(batch.column("_text"))
        sources = batch.column("sources")
        many = np.diff(sources.offsets.to_numpy())
        listed = sources.flatten()
        doc = np.repeat(np.arange(batch.num_rows), many)
        start, counts = listed.field("start").to_numpy(), listed.field("n").to_numpy().astype(np.int64)
        # A run lies in its row; rows that repeat a doc_id with another text may be too short for it.
        fits = np.flatnonzero(at[doc] + start + counts + WIDTH - 1 <= at[doc + 1])
        if not len(fits):
            continue
        doc, start, counts = doc[fits], start[fits], counts[fits]
        begin = at[doc] + start
        ends = np.cumsum(counts)
        place = np.arange(ends[-1]) + np.repeat(begin - ends + counts, counts)
        edge = window_hashes(words, WIDTH)[place]
        check = (window_hashes(mix(words + _U64(0x632BE59BD9B4E019)), WIDTH)[place] >> _U64(32)).astype(np.uint32)
        step = mix(np.arange(len(place), dtype=_U64) - np.repeat(ends - counts, counts).astype(_U64) + _U64(7))
        run = mix(np.add.reduceat(mix(edge ^ step), ends - counts) + counts.astype(_U64))
        same = run.view(np.int64) == listed.field("run").to_numpy()[fits]
        node = window_hashes(words, WIDTH - 1)
        # A run's nodes are the first 12 words of each edge, and the last 12 of its last one.
        nodes = np.insert(node[place], ends, node[place[ends - 1] + 1])
        whole = pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id").take(pa.array(doc)),
                pa.array(start),
                listed.field("last_doc").take(pa.array(fits)),
                pa.array(run.view(np.int64)),
                _lists(counts, pa.array(edge.view(np.int64))),
                _lists(counts, pa.array(check.view(np.int32))),
                _lists(counts + 1, pa.array(nodes.view(np.int64))),
            ],
            names=["doc_id", "start", "last_doc", "run", "edges", "checks", "nodes"],
        )
        yield whole if same.all() else whole.filter(pa.array(same))


def _cut_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Whole texts without the words that the spans (``starts``, ``counts``) cover; words joined by one space."""
    for batch in slices(batches, "_text", 4 << 20):
        data, rows = buffer_of(batch.column("_text"))
        begin, end = word_spans(data, rows)
        at = np.searchsorted(begin, rows)
        starts = batch.column("starts")
        many = np.diff(starts.offsets.to_numpy()) if batch.num_rows else np.zeros(0, np.int64)
        low, high = np.repeat(at[:-1], many), np.repeat(at[1:], many)
        place = low + starts.flatten().to_numpy()
        upto = place + batch.column("counts").flatten().to_numpy() + WIDTH - 1
        depth = np.zeros(len(begin) + 1, np.int64)
        np.add.at(depth, np.minimum(place, high), 1)  # rows that share a doc_id may be shorter
        np.add.at(depth, np.minimum(upto, high), -1)
        kept = np.cumsum(depth)[: len(begin)] == 0
        total = np.concatenate([[0], np.cumsum(kept)])
        row = np.repeat(np.arange(batch.num_rows), np.diff(at))
        later = total[at[1:]][row] > total[1:]  # another kept word follows in the row
        edges = np.zeros(len(data) + 1, np.int64)
        edges[begin[kept]] += 1
        np.add.at(edges, end[kept], -1)
        keep = np.cumsum(edges)[: len(data)] > 0
        gap = end[kept & later]
        out = data.copy()
        out[gap] = 32
        keep[gap] = True
        sizes = np.concatenate([[0], np.cumsum(keep)])[rows]
        text = pa.LargeStringArray.from_buffers(batch.num_rows, pa.py_buffer(sizes.astype(np.int64)), pa.py_buffer(out[keep].tobytes()))
        n_words = np.diff(at)
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(n_words.astype(np.int64)), pa.array((n_words - np.diff(total[at])).astype(np.int64)), text.cast(pa.string())],
            names=["doc_id", "n_words", "n_removed", "text"],
        )


def compact(edges: DataFrame) -> DataFrame:
    """Paths of a De Bruijn graph: each edge with ``base``, the source place at which its path begins.

    The input has one row per edge: its name (edge, check), its nodes (pre, post) and its source
    (origin, at).  Two edges are linked where one's ``post`` is the other's ``pre``, this node has one
    edge in and one out, and the source holds them at neighbouring places.  An edge without a link to
    the one before it begins a path.  An empty table gives an empty one.
    """
    one, no, none = F.lit(1), F.lit(0), F.lit(None)
    into = edges.select(
        F.col("post").alias("node"), one.alias("ins"), no.alias("outs"), F.col("origin").alias("from"),
        (F.col("at") + 1).alias("upto"), none.cast("bigint").alias("origin"), none.cast("int").alias("at"),
    )
    out = edges.select(F.col("pre").alias("node"), no, one, none, none, "origin", "at")
    # With one edge in and one out, each maximum is that edge's own place.
    nodes = into.union(out).groupBy("node").agg(
        F.sum("ins").alias("ins"), F.sum("outs").alias("outs"), *[F.max(c).alias(c) for c in ("from", "upto", "origin", "at")]
    )
    linked = F.expr("ins = 1 and outs = 1 and `from` = origin and upto = at")
    # Most edges are linked, so the others are noted: the heads of paths.  A node with one edge out has that edge's
    # place; those with more are looked up.
    ends = store(nodes.where(F.col("outs") > 0).where(~F.coalesce(linked, F.lit(False))).select("node", "outs", "origin", "at"), "ends")
    several = broadcast_checked(ends.where("outs > 1").select("node"))
    heads = ends.where("outs = 1").select("origin", "at").union(
        edges.join(several, F.col("pre") == F.col("node"), "left_semi").select("origin", "at")
    )
    # A linked edge has its predecessor one place earlier, so its path begins at the last head before it.
    # A source's edges are no more than its words.
    names = ["edge", "check", "origin", "at"]
    marks = heads.select(none.cast("bigint"), none.cast("int"), "origin", "at", F.lit(True))
    both = edges.select(*names, F.lit(False).alias("mark")).union(marks).repartition("origin")
    head = F.when(F.col("mark"), F.col("at"))
    before = Window.partitionBy("origin").orderBy("at")  # rows at the same place included
    paths = both.withColumn("base", F.max(head).over(before)).where("not mark").select(*names, "base")
    paths = _store(paths, "paths")
    discard(ends)
    return paths


def _named_runs(docs: DataFrame) -> DataFrame:
    """Runs of windows whose anchor two documents have: doc_id, start, n, run."""
    texts = docs.select("doc_id", F.col("text").alias("_text")).where("doc_id is not null and _text is not null")
    anchors = _store(texts.mapInArrow(tidy(_anchor_rows), "doc_id bigint, anchors array<bigint>"), "anchors")
    each = anchors.select("doc_id", F.explode("anchors").alias("anchor"))
    shared = each.groupBy("anchor").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high"))
    shared = store(shared.where("low < high").select("anchor"), "shared")
    # At most one document's anchors meet here.  Rows are dealt by document before they become lists: a list begun
    # elsewhere would hold one or two.
    wanted = each.join(shared, "anchor").repartition("doc_id").groupBy("doc_id").agg(F.collect_set("anchor").alias("wanted"))
    wanted = store(wanted, "wanted")
    discard(anchors, shared)
    runs = _store(texts.join(wanted, "doc_id").mapInArrow(tidy(_run_rows), "doc_id bigint, start int, n int, run bigint"), "runs")
    discard(wanted)
    return runs


def _source_edges(docs: DataFrame, runs: DataFrame) -> DataFrame:
    """Each run once, where it first stands: run, doc_id, start, last_doc, edges, checks, nodes.

    The places of runs are small; what a run holds is read again in its source alone, so no copy of it is
    stored or shuffled.
    """
    first = runs.groupBy("run").agg(
        F.min(F.struct("doc_id", "start", "n")).alias("source"), F.max("doc_id").alias("last_doc")
    ).select("run", "source.*", "last_doc")
    # A document's runs are no more than its words.
    sources = first.repartition("doc_id").groupBy("doc_id").agg(F.collect_list(F.struct("start", "n", "last_doc", "run")).alias("sources"))
    sources = store(sources, "sources")
    texts = docs.select("doc_id", F.col("text").alias("_text")).where("doc_id is not null and _text is not null")
    schema = "doc_id bigint, start int, last_doc bigint, run bigint, edges array<bigint>, checks array<int>, nodes array<bigint>"
    # Rows that repeat a doc_id bring their runs again, which neither edges nor pieces mind.
    found = _store(texts.join(sources, "doc_id").mapInArrow(tidy(_edge_rows), schema), "distinct-runs")
    discard(sources)
    return found


def repeated_spans(docs: DataFrame) -> DataFrame:
    """(doc_id, start, n, origin, origin_start): ``n`` windows from word ``start`` on, as in the source.

    Each of them also starts in the smaller doc_id ``origin``, there from word ``origin_start`` on;
    ``origin`` is the smallest document that has the window.  Spans are as long as both texts agree
    under one source.
    """
    runs = _named_runs(docs)
    places = runs.select("doc_id", "start", "run")
    distinct = _source_edges(docs, runs)
    i = F.col("i")
    edges = distinct.select("*", F.posexplode("edges").alias("i", "edge")).select(
        "run", "doc_id", "last_doc", "i", (F.col("start") + i).alias("at"), "edge", F.get("checks", i).alias("check"),
        F.get("nodes", i).alias("pre"), F.get("nodes", i + 1).alias("post"),
    )
    graph = edges.groupBy("edge", "check").agg(
        F.min("doc_id").alias("origin"), F.min_by("at", "doc_id").alias("at"), F.max("last_doc").alias("last"),
        F.first("pre").alias("pre"), F.first("post").alias("post"),
    )
    graph = _store(graph.where("origin < last").drop("last"), "graph")
    paths = compact(graph)
    discard(graph)
    known = edges.select("run", "last_doc", "i", "edge", "check").join(paths, ["edge", "check"]).where("origin < last_doc")
    known = _store(known.select("run", "i", "origin", "base", (F.col("at") - F.col("i")).alias("shift")), "known")
    discard(distinct, paths)
    key = ["run", "origin", "base", "shift"]
    piece = F.col("i") - F.dense_rank().over(Window.partitionBy(*key).orderBy("i"))
    # What stands in one run is no more than a document's words, and serves each of the steps up to the lists.
    pieces = known.repartition("run").withColumn("piece", piece).groupBy(*key, "piece").agg(
        F.min("i").alias("from"), (F.max("i") - F.min("i") + 1).alias("n")
    )
    pieces = pieces.groupBy("run").agg(F.collect_list(F.struct("from", "n", "origin", "shift")).alias("pieces"))
    pieces = store(pieces, "pieces")
    discard(known)
    # ``off`` is how much farther a piece stands in the document than in its source.
    placed = places.join(pieces, "run").select("doc_id", "start", F.explode("pieces").alias("p")).where("p.origin < doc_id")
    placed = placed.select(
        "doc_id", "p.origin", (F.col("start") - F.col("p.shift")).alias("off"),
        (F.col("start") + F.col("p.from")).alias("start"), F.col("p.n").cast("int").alias("n"),
    )
    # A document's pieces are no more than its words; rows that repeat a document bring theirs again.
    key = ["doc_id", "origin", "off"]
    order = Window.partitionBy(*key).orderBy("start", "n")
    reach = F.max(F.col("start") + F.col("n")).over(order.rowsBetween(Window.unboundedPreceding, -1))
    new = (reach.isNull() | (F.col("start") > reach)).cast("int")
    spans = placed.repartition("doc_id").withColumn("new", new).withColumn("span", F.sum("new").over(order))
    spans = spans.groupBy(*key, "span").agg(
        F.min("start").alias("start"), (F.max(F.col("start") + F.col("n")) - F.min("start")).alias("n")
    )
    return spans.select("doc_id", "start", "n", "origin", (F.col("start") - F.col("off")).alias("origin_start"))


def remove_repeats(docs: DataFrame) -> DataFrame:
    """(doc_id, n_words, n_removed, text) of each row; text holds the kept words, one space between.

    Words covered by a 13-word window that also starts in a document with a smaller doc_id go;
    windows are judged on the input.  Null and empty texts have no words and give an empty text.
    Rows without doc_id are left whole and count as no source.  Rows that repeat a doc_id and text
    are treated alike; different texts under one doc_id are not supported as sources of each other,
    and each loses what its own windows repeat.  Other columns are not read.
    """
    # A document's spans are no more than its words.
    paths = repeated_spans(docs).groupBy(F.col("doc_id").alias("_d")).agg(
        F.collect_set(F.struct("start", "n")).alias("paths")
    ).select("_d", F.col("paths.start").alias("starts"), F.col("paths.n").alias("counts"))
    texts = docs.select("doc_id", F.col("text").alias("_text"))
    none = F.array().cast("array<int>")
    joined = texts.join(paths, F.col("doc_id") == F.col("_d"), "left").select(
        "doc_id", "_text", F.coalesce("starts", none).alias("starts"), F.coalesce("counts", none).alias("counts")
    )
    return joined.mapInArrow(tidy(_cut_rows), "doc_id bigint, n_words bigint, n_removed bigint, text string")

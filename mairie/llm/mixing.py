"""Mixing sources to target weights by a multivariate-hypergeometric splitting tree.

Sizes are words.  A source's documents stand in a seeded random order, the same in every run;
repeated as often as its target asks, they form the source's stream, cut into blocks of about
``block_words``.  The exact block quotas of all sources are then split among the output shards by a
binary tree: at each node the left half's share of every source's blocks is one multivariate
hypergeometric draw, so each shard's counts are those of a random deal of all blocks and add up
exactly.  A shard gets a disjoint run of each source's permuted blocks and is shuffled locally.

Running totals are taken in two levels (within slices of a source's random order, then over the
slices), so a source with a third of all rows is spread over many tasks.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import gcd

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from mairie.llm.common import discard, store
from mairie.llm.textbytes import buffer_of, slices, tidy, word_spans
from mairie.session import broadcast_checked

WEIGHTS = (5, 2, 1)
MOST = 3
SLICE_ROWS = 2_000
SUBTREES = 256  # of the splitting tree, drawn in tasks


def _sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "_text", 4 << 20):
        data, rows = buffer_of(batch.column("_text"))
        starts, _ = word_spans(data, rows)
        counts = np.diff(np.searchsorted(starts, rows))
        names = [n for n in batch.schema.names if n != "_text"]
        yield pa.RecordBatch.from_arrays(
            [*[batch.column(n) for n in names], pa.array(counts.astype(np.int64))], names=[*names, "size"]
        )


def source_targets(sizes: DataFrame, weights=WEIGHTS, most: int = MOST) -> DataFrame:
    """(source, source_size, weight, target) of each source; the input has source and source_size.

    Sources come by code point, null last, and take the weights in turn.  A target is its weight's
    share of all sizes, but at most ``most`` times its source's size; what is cut off goes to the
    others by weight.  That is one level L with target = least(most * size, L * weight): sources
    ordered by size per weight saturate first, so L follows from running sums over the sources.
    """
    order = Window.orderBy(F.col("source").isNull(), "source")
    turn = (F.row_number().over(order) - 1) % len(weights)
    weighted = sizes.withColumn("weight", F.get(F.array(*[F.lit(float(w)) for w in weights]), turn))
    total = Window.partitionBy()
    by_rank = Window.orderBy(F.col("source_size") / F.col("weight"), F.col("source").isNull(), "source")
    by_level = by_rank.rowsBetween(Window.unboundedPreceding, -1)
    full = F.coalesce(F.sum(F.lit(float(most)) * F.col("source_size")).over(by_level), F.lit(0.0))
    used = F.coalesce(F.sum("weight").over(by_level), F.lit(0.0))
    level = (F.sum("source_size").over(total) - full) / (F.sum("weight").over(total) - used)
    # The first source that does not saturate fixes the level; before it every source is full.
    found = weighted.withColumn("_level", level).withColumn("_rank", F.row_number().over(by_rank))
    opens = F.when(F.col("_level") * F.col("weight") <= F.lit(float(most)) * F.col("source_size"), F.col("_rank"))
    found = found.withColumn("_level", F.min_by("_level", opens).over(total))
    target = F.least(F.lit(float(most)) * F.col("source_size"), F.col("_level") * F.col("weight"))
    return found.select("source", "source_size", "weight", target.cast("double").alias("target"))


def _split(node: tuple[int, int, np.ndarray], seed: int, stop: int) -> Iterator[tuple[int, int, np.ndarray]]:
    """The nodes (low, high, blocks by source) of at most ``stop`` shards below ``node``, in order of their shards.

    A node's draw follows from the seed and its bounds only, so it does not matter where it is made.
    """
    todo = [node]
    while todo:
        low, high, here = todo.pop()
        if high - low <= stop:
            yield low, high, here
            continue
        middle = (low + high) // 2
        left = int(here.sum()) * (middle - low) // (high - low)
        rng = np.random.default_rng([seed, low, high])
        taken = rng.multivariate_hypergeometric(here, left, method="marginals") if len(here) else here
        todo += [(middle, high, here - taken), (low, middle, taken)]


def split_quotas(quotas: np.ndarray, shards: int, seed: int) -> np.ndarray:
    """(shards, sources) block counts: a random deal of all blocks, made by a splitting tree.

    ``quotas`` holds each source's exact number of blocks.  A node with s shards and n blocks gives
    its left half floor(n * (s // 2) / s) blocks, drawn without replacement over the sources.
    """
    return np.array([here for _, _, here in _split((0, shards, np.asarray(quotas, np.int64)), seed, 1)], np.int64).reshape(shards, -1)


def block_shards(spark: SparkSession, quotas: list[int], shards: int, seed: int) -> DataFrame:
    """(source_no, rank, shard): the shard that each rank of each source's permuted blocks is dealt to.

    The driver draws the top of the tree, at most ``2 * SUBTREES`` nodes whatever the number of shards; the
    subtrees are drawn in tasks.  A shard gets a run of ranks of each source, after those of the shards before it.
    """
    top, done = [], np.zeros(len(quotas), np.int64)
    for low, high, here in _split((0, shards, np.array(quotas, np.int64)), seed, -(-shards // SUBTREES)):
        top.append((low, high, here.tolist(), done.tolist()))
        done = done + here

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for node in batch.to_pylist():
                before = np.array(node["before"], np.int64)
                for low, _, here in _split((node["low"], node["high"], np.array(node["blocks"], np.int64)), seed, 1):
                    mine = np.flatnonzero(here)
                    columns = [mine, before[mine], before[mine] + here[mine] - 1, np.full(len(mine), low)]
                    before = before + here
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["source_no", "first", "last", "shard"])

    nodes = spark.createDataFrame(top, "low bigint, high bigint, blocks array<bigint>, before array<bigint>")
    runs = nodes.repartition(min(len(top), SUBTREES)).mapInArrow(run, "source_no bigint, first bigint, last bigint, shard bigint")
    return runs.select("source_no", F.explode(F.sequence("first", "last")).alias("rank"), "shard")


def _content():
    return F.xxhash64(F.coalesce(F.col("text"), F.lit("")))


def sized_documents(docs: DataFrame, seed: int, source: str = "source") -> DataFrame:
    """doc_id, source, size, content (a hash of the text) and place (a seeded random 64-bit order) of each row."""
    text = F.col("text").alias("_text")
    sized = docs.select("doc_id", F.col(source).cast("string").alias("source"), _content().alias("content"), text).mapInArrow(
        tidy(_sizes), "doc_id bigint, source string, content bigint, size bigint"
    )
    return sized.withColumn("place", F.xxhash64(F.lit(seed), F.coalesce(F.col("doc_id"), F.lit(-1)), "size", "content"))


def _running(rows: DataFrame, value, name: str, order: list[str], most: str | None = None) -> DataFrame:
    """``rows`` with the sum of ``value`` before each row in its source's order, in two levels: in its slice, then over slices.

    Slices before which the sum is above the column ``most`` already are left out.
    """
    sums = rows.groupBy("source", "slice").agg(F.sum(value).alias("_words"))
    earlier = Window.partitionBy("source").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(
        F.col("source").alias("_s"), F.col("slice").alias("_k"), F.coalesce(F.sum("_words").over(earlier), F.lit(0)).alias("_base")
    )
    rows = rows.join(sums, F.col("source").eqNullSafe(F.col("_s")) & (F.col("slice") == F.col("_k")))
    rows = rows.where(F.col("_base") <= F.col(most)) if most else rows
    inner = Window.partitionBy("source", "slice").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("_inner", F.coalesce(F.sum(value).over(inner), F.lit(0)))
    return rows.withColumn(name, F.col("_base") + F.col("_inner")).drop("_s", "_k", "_base", "_inner")


def _fill(rows: DataFrame) -> DataFrame:
    """(_s, steps): per source the runs [low, high) of ``before`` whose documents of at most ``cap`` words are taken once more.

    A document is taken when it fits what those before it in the order leave of ``rest``; others are passed
    over.  Each round goes on to the first document of more than half the gap that fits, or to the first of
    at most half that does not.  Either way half the gap is filled at least, so rounds grow with the
    logarithm of the largest remainder.  The driver holds three numbers per source and round.
    """
    spark = rows.sparkSession
    size = F.col("size")
    sources = rows.where(size > 0).groupBy("source").agg(F.first("rest").alias("rest")).collect()
    todo = {r.source: (0, r.rest) for r in sources if r.rest >= 1}
    steps: dict[str | None, list[tuple[int, int, float]]] = {}
    end = 2**62
    while todo:
        state = spark.createDataFrame([(k, *v) for k, v in todo.items()], "_t string, _at bigint, _gap double")
        here = rows.join(state, F.col("source").eqNullSafe(F.col("_t")))
        here = here.where((size > 0) & (F.col("before") >= F.col("_at")) & (size <= F.col("_gap")))
        small = size <= F.col("_gap") / 2
        here = here.select("source", "slice", "before", "size", "_gap", small.alias("_small"))
        filled = _running(here, F.when(F.col("_small"), size).otherwise(0), "_filled", ["before"], "_gap")
        fits = F.col("_filled") + size <= F.col("_gap")
        stop = F.struct("before", "size", "_filled", "_small")
        found = filled.where(fits != F.col("_small")).groupBy("source").agg(F.min(stop).alias("stop")).collect()
        stops = {r.source: r.stop for r in found}
        for source, (at, gap) in list(todo.items()):
            stop, mine = stops.get(source), steps.setdefault(source, [])
            mine.append((at, stop.before if stop else end, gap / 2))
            if stop and not stop["_small"]:
                mine.append((stop.before, stop.before + 1, gap))
            left = gap - stop["_filled"] - (0 if stop["_small"] else stop.size) if stop else 0
            if left >= 1:
                todo[source] = (stop.before + stop.size, left)
            else:
                del todo[source]
    return spark.createDataFrame(list(steps.items()), "_s string, steps array<struct<low bigint, high bigint, cap double>>")


def placed_documents(docs: DataFrame, seed: int = 7, weights=WEIGHTS, most: int = MOST) -> DataFrame:
    """Each document with source_size, target, ``before`` (words before it in its source's order), copies, times and ``again``.

    All documents are taken ``floor(target / size)`` times; each one of the order that fits what is left of
    the remainder is taken once more, until none fits, and so is the one whose size closes the last gap
    best.  ``again`` is the number of words before a document among those taken once more.  Texts without
    words, null and empty ones among them, have no copies; a null source is one of its own; rows that repeat
    are documents of their own; an empty table gives an empty one.  The result is stored.
    """
    sized = store(sized_documents(docs, seed), "sized")
    by_source = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("rows"))
    sources = store(
        source_targets(by_source.select("source", "source_size"), weights, most)
        .join(by_source.select(F.col("source").alias("_s"), "rows"), F.col("source").eqNullSafe(F.col("_s")))
        .drop("_s"),
        "sources",
    )
    s = sources.withColumnRenamed("source", "_s")
    # Slices of the random order hold about SLICE_ROWS rows whatever the source's size.
    rows = sized.join(s, F.col("source").eqNullSafe(F.col("_s"))).drop("_s")
    slices_of = F.ceil(F.col("rows") / SLICE_ROWS)
    unit = (F.col("place") / F.lit(2.0**64)) + F.lit(0.5)
    rows = rows.withColumn("slice", F.least(F.floor(unit * slices_of), slices_of - 1).cast("bigint"))
    rows = _running(rows, F.col("size"), "before", ["place", "doc_id", "size"])
    times = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    rest = F.col("target") - F.col("times") * F.col("source_size")
    rows = rows.withColumn("times", times.cast("bigint")).withColumn("rest", rest)
    rows = ordered = store(rows, "ordered")
    steps = _fill(rows.where(F.col("times") < most))
    taken = lambda x: (F.col("before") >= x["low"]) & (F.col("before") < x["high"]) & (F.col("size") <= x["cap"])
    more = F.coalesce(F.exists("steps", taken), F.lit(False)) & (F.col("size") > 0)
    rows = rows.join(steps, F.col("source").eqNullSafe(F.col("_s")), "left").withColumn("more", more.cast("bigint")).drop("_s", "steps")
    # The document that closes a source's remaining gap best, if taking it brings the sum nearer.
    gaps = rows.groupBy("source").agg((F.first("rest") - F.sum(F.col("size") * F.col("more"))).alias("gap"))
    gaps = gaps.withColumnRenamed("source", "_s")
    name = F.struct("place", "doc_id", "size", "before")
    off = F.abs(F.col("size") - F.col("gap"))
    closing = rows.where((F.col("more") == 0) & (F.col("times") < most) & (F.col("size") > 0))
    closing = closing.join(gaps, F.col("source").eqNullSafe(F.col("_s"))).where(off < F.col("gap"))
    closing = closing.groupBy("source").agg(F.min(F.struct(off.alias("off"), name.alias("name"))).alias("best"))
    closing = closing.select(F.col("source").alias("_s"), F.col("best.name").alias("_best"))
    rows = rows.join(closing, F.col("source").eqNullSafe(F.col("_s")), "left")
    last = F.coalesce(name == F.col("_best"), F.lit(False)) & (F.col("more") == 0)
    filled = store(rows.withColumn("more", F.col("more") + last.cast("bigint")).drop("_s", "_best"), "filled")
    rows = _running(filled, F.col("size") * F.col("more"), "again", ["before", "size"])
    copies = F.when(F.col("size") > 0, F.col("times") + F.col("more")).otherwise(0)
    placed = rows.withColumn("copies", copies).select(
        "doc_id", "source", "content", "size", "place", "source_size", "target", "before", "copies", "times", "again"
    )
    placed = store(placed, "placed")
    discard(sized, sources, ordered, filled)
    return placed


def mix_documents(
    docs: DataFrame, seed: int = 7, weights=WEIGHTS, most: int = MOST, block_words: int = 50_000, shard_words: int = 2_000_000
) -> DataFrame:
    """One row per taken copy, and one with null copy and shard per document that is not taken.

    Columns: doc_id, source, content (a hash of the text), size, source_size, target, copy, shard,
    position (the order in the shard, from 0).  Null source is a source of its own; null and empty texts have size 0 and are
    never taken, nor do they count.  Rows that repeat are each taken on their own.  Reruns agree.
    The driver holds the block counts of each source at the top of the splitting tree.
    """
    placed = placed_documents(docs, seed, weights, most)
    copies = placed.where("copies > 0").withColumn("copy", F.explode(F.sequence(F.lit(0), (F.col("copies") - 1).cast("int"))))
    # The last pass holds the documents taken once more only, so no block of it is empty.
    start = F.col("copy") * F.col("source_size") + F.when(F.col("copy") < F.col("times"), F.col("before")).otherwise(F.col("again"))
    copies = copies.withColumn("block", F.floor(start / block_words).cast("bigint"))
    found = copies.groupBy("source").agg((F.max("block") + 1).alias("blocks"), F.sum("size").alias("words"))
    quotas = found.orderBy(F.col("source").isNull(), "source").collect()
    shards = max(1, -(-sum(r.words for r in quotas) // shard_words))
    rules = []
    for k, r in enumerate(quotas):
        # A bijection of a source's blocks: block b has rank (b * step + shift) mod q.
        step = next(a for a in range(int(r.blocks * 0.6180339887) + 1, 2 * r.blocks + 2) if gcd(a, r.blocks) == 1)
        rules.append((r.source, k, int(r.blocks), step, (seed * 7919) % r.blocks))
    rules = docs.sparkSession.createDataFrame(rules, "_s string, source_no bigint, q bigint, step bigint, shift bigint")
    copies = copies.join(rules, F.col("source").eqNullSafe(F.col("_s")))
    copies = copies.withColumn("rank", (F.col("block") * F.col("step") + F.col("shift")) % F.col("q"))
    taken = copies.join(block_shards(docs.sparkSession, [r.blocks for r in quotas], shards, seed), ["source_no", "rank"])
    local = Window.partitionBy("shard").orderBy(F.xxhash64(F.lit(seed + 1), "place", "copy"), "doc_id", "copy", "size", "content")
    out = ["doc_id", "source", "content", "size", "source_size", "target", "copy", "shard", "position"]
    none = {"copy": F.lit(None).cast("int"), "shard": F.lit(None).cast("bigint"), "position": F.lit(None).cast("int")}
    taken = taken.withColumn("position", F.row_number().over(local) - 1).select(*out)
    return taken.union(placed.where("copies = 0").withColumns(none).select(*out))


def mixed_rows(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: each taken document's row as often as it is taken, with the columns of ``docs``.

    Rows are laid out as the mix deals them: a shard's rows stand together, in the shard's shuffled order.
    Rows that share a doc_id and a text share the copies taken of them evenly.  Nulls, rows without words
    and empty tables are as in ``mix_documents``; no column but doc_id, text and source is read.
    """
    key = [F.coalesce("doc_id", F.lit(0)).alias("_d"), F.col("doc_id").isNull().alias("_n")]
    names = ["_d", "_n", "_c"]
    mixed = store(
        mix_documents(docs, **options).select(
            *key, F.col("content").alias("_c"), "copy", F.col("shard").alias("_shard"), F.col("position").alias("_position")
        ),
        "mixed",
    )
    first = F.when(F.coalesce("copy", F.lit(0)) == 0, 1)  # one such row for each row of ``docs``
    repeated = store(mixed.groupBy(*names).agg(F.count(first).alias("_among")).where("_among > 1"), "repeated")
    taken = mixed.where("_shard is not null").drop("copy")
    rows = docs.select(*docs.columns, *key, _content().alias("_c"))
    single = rows.join(taken.join(repeated, names, "left_anti"), names).drop(*names)
    # Only rows that share id and text need ranks to tell who gets which copy.
    same = Window.partitionBy(*names)
    copies = taken.join(repeated, names).withColumn("_k", F.row_number().over(same.orderBy("_shard", "_position")) - 1)
    copies = copies.withColumn("_rank", (F.col("_k") % F.col("_among")).cast("int")).drop("_k", "_among")
    several = rows.join(broadcast_checked(repeated.drop("_among")), names, "left_semi")
    several = several.withColumn("_rank", F.row_number().over(same.orderBy(*names)) - 1)
    several = several.join(copies, [*names, "_rank"]).drop(*names, "_rank")
    laid = single.union(several.select(*single.columns))
    return laid.repartition("_shard").sortWithinPartitions("_shard", "_position").select(*docs.columns)

"""Merkle dataset manifest with leaf coordinates from bitmap ranks.

A leaf's place among the leaves of its language is the rank of its doc_id.  Ranks come from
bitmaps: ids are merged into 64-bit words by a bit-or with map-side combine, only words that hold
an id are kept (the compressed form), and a popcount directory holds how many ids come before each
word.  A rank is the directory's entry plus the popcount of the lower bits, so leaves are never
sorted.  Words in which an id repeats are told by their row count; only their rows are ordered.

Levels are then reduced by key: a node's parent is its place divided by eight, and a parent's
children are a slot array of at most eight digests.  Proofs go down the same arrays: a parent's
path is handed to its children, with the digests left and right of each.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mairie.llm.common import discard, store

FANOUT = 8
SLICE_ROWS = 200_000
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
_SALTS = 64


def digest(*parts) -> Column:
    """Lowercase hex SHA-256 of the concatenated parts."""
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def field_text(column) -> Column:
    """``-`` for null, else the UTF-8 byte count, a colon and the value."""
    value = column.cast("string")
    return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))


def leaf_digest(**changed: Column) -> Column:
    return digest(*[field_text(changed.get(c, F.col(c))) for c in FIELDS])


def _key(lang: str = "lang") -> Column:
    """Text that is never null and sorts as the language does, null first."""
    return F.coalesce(F.concat(F.lit("1"), F.col(lang)), F.lit("0"))


def running_before(df: DataFrame, group: list[str], order: list[str], value: str, name: str) -> DataFrame:
    """``df`` (stored) with ``name``: the sum of ``value`` over earlier rows of the group.

    Rows are laid out in range slices; slices are summed alone, and a slice's start is the sum of
    the slices before it, so no task holds a group whole.  Rows with equal keys must be one.
    """
    n = df.count()
    slices = -(-max(n, 1) // SLICE_ROWS)
    cut = store(df.repartitionByRange(slices, *group, *order).withColumn("_slice", F.spark_partition_id()), "ranges")
    totals = cut.groupBy(*group, "_slice").agg(F.sum(value).alias("_sum"))
    earlier = Window.partitionBy(*group).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select(*group, "_slice", F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_start"))
    local = Window.partitionBy(*group, "_slice").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    summed = cut.withColumn("_local", F.coalesce(F.sum(value).over(local), F.lit(0)))
    return summed.join(starts, [*group, "_slice"]).withColumn(name, F.col("_start") + F.col("_local")).drop("_slice", "_start", "_local")


def _tie_places(tied: DataFrame) -> DataFrame:
    """(row, tie): places among rows of one (key, doc_id), by leaf; equal leaves in any order.

    Leaves are counted before they are ordered, by their first digits and then inside them, and equal
    rows are numbered by salt, so an id that very many rows share is spread over many tasks.
    """
    # Null ids are a value here: they are tied with each other.
    tied = tied.withColumns({
        "_null": F.col("doc_id").isNull(), "doc_id": F.coalesce("doc_id", F.lit(0)),
        "head": F.substring("leaf", 1, 3), "salt": F.pmod(F.xxhash64("row"), F.lit(_SALTS)),
    })
    by = ["key", "_null", "doc_id"]
    salted = tied.groupBy(*by, "head", "leaf", "salt").agg(F.count(F.lit(1)).alias("n"))
    before = lambda part, order: Window.partitionBy(*part).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    sum_before = lambda part, order: F.coalesce(F.sum("n").over(before(part, order)), F.lit(0))
    leaves = salted.groupBy(*by, "head", "leaf").agg(F.sum("n").alias("n"))
    heads = leaves.groupBy(*by, "head").agg(F.sum("n").alias("n")).withColumn("a", sum_before(by, "head")).drop("n")
    leaves = leaves.withColumn("b", sum_before([*by, "head"], "leaf")).drop("n")
    salted = salted.withColumn("c", sum_before([*by, "head", "leaf"], "salt")).drop("n")
    d = F.row_number().over(Window.partitionBy(*by, "head", "leaf", "salt").orderBy("row")) - 1
    placed = tied.withColumn("d", d).join(heads, [*by, "head"]).join(leaves, [*by, "head", "leaf"]).join(salted, [*by, "head", "leaf", "salt"])
    return placed.select("row", (F.col("a") + F.col("b") + F.col("c") + F.col("d")).alias("tie"))


def rank_leaves(leaves: DataFrame) -> DataFrame:
    """``leaves`` (stored; columns key, doc_id, leaf, row) with ``place``, from 0, inside each key.

    Places ascend by doc_id, rows without doc_id first; rows that share key and doc_id follow each
    other by leaf.  ``row`` is a stored unique number.
    """
    word, bit = F.shiftright(F.col("doc_id"), 6), F.col("doc_id").bitwiseAND(F.lit(63)).cast("int")
    coded = leaves.withColumns({"word": word, "bit": bit})
    mask = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col("bit"))
    words = coded.groupBy("key", "word").agg(F.bit_or(mask).alias("bits"), F.count(F.lit(1)).alias("n"))
    # Rows without doc_id have no bit; as the word before all others they push every other rank up.
    words = store(words.withColumn("_null", F.col("word").isNotNull()), "words")
    words = store(running_before(words, ["key"], ["_null", "word"], "n", "base").drop("_null"), "directory")
    lower = F.bitwise_not(F.call_function("shiftleft", F.lit(-1).cast("bigint"), F.col("bit")))
    below = F.col("bits").bitwiseAND(lower)
    dense = words.where("bits is not null and n = bit_count(bits)")
    ranked = coded.join(dense, ["key", "word"]).withColumn("place", F.col("base") + F.bit_count(below))
    rest = words.where("bits is null or n > bit_count(bits)").select("key", F.col("word").alias("_w"), "base")
    tied = store(coded.join(rest, (coded["key"] == rest["key"]) & coded["word"].eqNullSafe(rest["_w"])).drop(rest["key"]).drop("bits"), "tied")
    # Inside such a word the rows of smaller ids are counted: at most 64 ids.
    ids = tied.groupBy("key", "_w", "doc_id").agg(F.count(F.lit(1)).alias("n"))
    lower = Window.partitionBy("key", "_w").orderBy("doc_id").rowsBetween(Window.unboundedPreceding, -1)
    ids = ids.select(F.col("key").alias("_k"), F.col("doc_id").alias("_d"), F.coalesce(F.sum("n").over(lower), F.lit(0)).alias("inside"))
    shared = tied.join(ids, (F.col("key") == F.col("_k")) & F.col("doc_id").eqNullSafe(F.col("_d")))
    shared = shared.join(_tie_places(tied), "row").withColumn("place", F.col("base") + F.col("inside") + F.col("tie"))
    columns = [*leaves.columns, "place"]
    return ranked.select(*columns).union(shared.select(*columns))


@dataclass
class Manifest:
    """The tree of a dataset: leaves with their places, slot arrays of each level, and the root."""

    leaves: DataFrame  # key, lang, doc_id, leaf, place and carried columns
    levels: list[DataFrame]  # key, parent, slots: level by level, of the languages' own trees
    top: list[DataFrame]  # the same over subroots; key is constant
    langs: DataFrame  # key, lang, size, subroot, position among the languages, from 0
    root: DataFrame  # one row, or none for an empty table


def _grow(nodes: DataFrame, name: str) -> tuple[list[DataFrame], DataFrame]:
    """Slot arrays of each level over nodes (key, place, digest, size), and the last nodes, one per key.

    ``size`` is how many nodes the key has on this level; a key with one node is done.
    """
    levels, done = [], []
    widest = nodes.agg(F.max("size")).first()[0] or 0
    while True:
        done.append(nodes.where("size = 1").select("key", "digest"))
        if widest <= 1:
            break
        slots = F.array_sort(F.collect_list(F.struct((F.col("place") % FANOUT).cast("int").alias("slot"), "digest")))
        grouped = nodes.where("size > 1").groupBy("key", F.floor(F.col("place") / FANOUT).alias("parent"), "size").agg(slots.alias("slots"))
        level = store(grouped.select("key", "parent", "size", F.col("slots.digest").alias("slots")), name)
        levels.append(level)
        nodes = level.select(
            "key", F.col("parent").alias("place"), digest(F.array_join("slots", "")).alias("digest"),
            F.ceil(F.col("size") / FANOUT).alias("size"),
        )
        widest = -(-widest // FANOUT)
    last = done[0]
    for other in done[1:]:
        last = last.union(other)
    return levels, last


def build(docs: DataFrame, **carried: Column) -> Manifest:
    """The manifest of ``docs`` (columns doc_id, source, lang, n_chars, text); others are not read.

    Every row is a leaf, null or repeated doc_ids included (see ``rank_leaves`` for their order).
    Trees of the languages grow apart, the null language first among them; an empty table has no
    root.  ``carried`` columns are computed with the leaf and stay with it.
    """
    rows = docs.select(_key().alias("key"), "lang", "doc_id", leaf_digest().alias("leaf"), *[c.alias(n) for n, c in carried.items()])
    rows = store(rows.withColumn("row", F.monotonically_increasing_id()), "leaves")
    placed = store(rank_leaves(rows).drop("row"), "placed")
    discard(rows)
    sizes = placed.groupBy("key").agg(F.count(F.lit(1)).alias("size"), F.first("lang").alias("lang"))
    langs = store(sizes, "langs")
    nodes = placed.select("key", "place", F.col("leaf").alias("digest")).join(langs.select("key", "size"), "key")
    levels, last = _grow(nodes, "level")
    subroots = store(langs.join(last.withColumnRenamed("digest", "subroot"), "key").withColumn("_one", F.lit(1)), "subroots")
    subroots = subroots.withColumn("_all", F.lit(0))
    langs = store(running_before(subroots, ["_all"], ["key"], "_one", "position").drop("_all", "_one"), "langs")
    n = langs.count()
    tops = langs.select(F.lit("").alias("key"), F.col("position").alias("place"), F.col("subroot").alias("digest"), F.lit(n).cast("bigint").alias("size"))
    top, root = _grow(tops, "top")
    return Manifest(placed, levels, top, langs, store(root.select(F.col("digest").alias("root")), "root"))


_PATH = "array<struct<left:string,right:string>>"


def _step(path: Column, slots: Column, slot: Column) -> Column:
    """A child's path: the digests left and right of its slot, then its parent's path."""
    left = F.array_join(F.slice(slots, F.lit(1), slot), "")
    right = F.array_join(F.slice(slots, slot + 2, F.size(slots)), "")
    return F.concat(F.array(F.struct(left.alias("left"), right.alias("right"))), path)


def _parents(level: DataFrame, paths: DataFrame) -> DataFrame:
    """(key, parent, slots, path): the slot arrays of a level with their nodes' own paths."""
    return level.select("key", "parent", "slots").join(paths.select("key", F.col("place").alias("parent"), "path"), ["key", "parent"])


def _children(level: DataFrame, paths: DataFrame) -> DataFrame:
    """(key, place, path) of the nodes below."""
    each = _parents(level, paths).select("key", "parent", "slots", "path", F.posexplode("slots").alias("slot", "digest"))
    place = F.col("parent") * FANOUT + F.col("slot")
    return each.select("key", place.alias("place"), _step(F.col("path"), F.col("slots"), F.col("slot")).alias("path"))


def proofs(manifest: Manifest) -> DataFrame:
    """``manifest.leaves`` with ``path``: steps (left, right) from a leaf's own run up to the root.

    Paths go down level by level; the last step joins the runs' paths, an eighth of the leaves, to
    the leaves, so no leaf's path is ever shuffled.
    """
    paths = manifest.root.select(F.lit("").alias("key"), F.lit(0).cast("bigint").alias("place"), F.array().cast(_PATH).alias("path"))
    for level in reversed(manifest.top):
        paths = _children(level, paths)
    paths = manifest.langs.join(paths.select(F.col("place").alias("position"), "path"), "position")
    heights = _heights(manifest.langs, len(manifest.levels))
    paths = store(paths.join(heights, "key").select("key", F.lit(0).cast("bigint").alias("place"), "path", "height"), "paths")
    above = paths.where("height < 0").select("key", "place", "path")
    for k in range(len(manifest.levels), 1, -1):
        # Keys enter at their own height: a small language's tree has fewer levels.
        entered = above.union(paths.where(F.col("height") == k).select("key", "place", "path"))
        above = store(_children(manifest.levels[k - 1], entered), "paths")
    lone = paths.where("height = 0").select("key", F.lit(0).cast("bigint").alias("parent"), F.lit(None).cast("array<string>").alias("slots"), "path")
    if manifest.levels:
        entered = above.union(paths.where("height = 1").select("key", "place", "path"))
        lone = lone.unionByName(_parents(manifest.levels[0], entered))
    runs = manifest.leaves.withColumn("parent", F.floor(F.col("place") / FANOUT)).join(lone, ["key", "parent"])
    slot = (F.col("place") % FANOUT).cast("int")
    whole = F.when(F.col("slots").isNull(), F.col("path")).otherwise(_step(F.col("path"), F.col("slots"), slot))
    return runs.withColumn("path", whole).drop("parent", "slots")


def _heights(langs: DataFrame, most: int) -> DataFrame:
    """(key, height): how many levels a key's own tree has."""
    height = F.lit(0)
    for k in range(most):
        height = height + F.when(F.col("size") > FANOUT**k, 1).otherwise(0)
    return langs.select("key", height.alias("height"))


def proof_digest(path: Column) -> Column:
    """Digest of all sibling digests of a path, from the leaf's run to the root's, left to right."""
    return digest(F.array_join(F.transform(path, lambda s: F.concat(s["left"], s["right"])), ""))


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf's digest and its path lead to."""
    return F.aggregate(path, leaf, lambda acc, s: digest(s["left"], acc, s["right"]))


def verify(manifest: Manifest, leaf: Column) -> DataFrame:
    """The leaves with subroot, root, proof_sha256, folded_root (from the digest ``leaf``) and verified."""
    named = proofs(manifest).join(manifest.langs.select("key", "subroot"), "key").withColumn("root", manifest.root.scalar())
    folded = named.withColumns({"proof_sha256": proof_digest(F.col("path")), "folded_root": fold(leaf, F.col("path"))})
    return folded.withColumn("verified", F.col("folded_root") == F.col("root")).drop("path")


def lowered_leaf(where: Column) -> Column:
    """The digest a row has once its text is lower-cased in A-Z, where that is asked for and changes it; else null."""
    lowered = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.when(where & (lowered != F.col("text")), leaf_digest(text=lowered))

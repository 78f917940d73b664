"""MinHash near-duplicates: one-permutation signatures, banded buckets, star-shaped candidate edges.

Documents with equal shingle sets are collapsed before anything is compared, by an aggregate with
map-side combine, so a group of copies of any size is one node.  Buckets of the remaining sets
yield one edge from each member to the bucket's smallest one (a star), not all pairs.  Every edge
is confirmed on the full sets.  Members that the star does not connect are then compared with the
bucket's members of other components, so a star's centre hides no link between others: every
banded pair ends up confirmed, refused, or inside one component already.  Only pairs whose
shingles leave room for the similarity are made: those that no other member has cannot be shared,
which is exact and spares the far copies of a large group.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mairie.llm.common import components, discard, gathered, store
from mairie.llm.shingles import band_rows, set_rows
from mairie.llm.textbytes import tidy
from mairie.session import broadcast_checked

WIDTH = 5
SET_ROWS = 500  # rows with a set that a task is given at least
# 42 bands of 6: a pair with similarity 0.85 shares no band with probability 2e-9, one at 0.8 with 3e-6.
BINS, BANDS = 252, 42


def _overlaps(percent: int):
    """mapInArrow function over (a, b, set_x, set_y): the pairs whose similarity reaches ``percent`` %."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("set_x"), batch.column("set_y"), strict=True):
                u, v = x.values.to_numpy(), y.values.to_numpy()
                both = np.concatenate([u, v])
                both.sort(kind="stable")
                shared = int((both[1:] == both[:-1]).sum())
                keep.append(100 * shared >= percent * (len(u) + len(v) - shared))
            mask = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays(
                [batch.column("a").filter(mask), batch.column("b").filter(mask)], names=["a", "b"]
            )

    return tidy(run)


def _sets(ids: DataFrame, docs: DataFrame) -> DataFrame:
    """The full sets of the documents in ``ids`` (distinct), made again from their texts in one pass.

    The list of ids is measured: up to the bound of ``broadcast_checked`` it goes to the texts, which
    then stay where they are; beyond it texts and ids are shuffled once.
    """
    wanted = docs.join(broadcast_checked(ids), "doc_id", "left_semi")
    return store(wanted.mapInArrow(set_rows(WIDTH), "doc_id bigint, shingles array<bigint>"), "sets")


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets reach the similarity."""
    x = sets.select(F.col("doc_id").alias("a"), F.col("shingles").alias("set_x"))
    y = sets.select(F.col("doc_id").alias("b"), F.col("shingles").alias("set_y"))
    # The second join ships each pair with one set to the other; a centre's set travels once.
    n = pairs.count()
    with_x = gathered(pairs.join(x, "a"), n, SET_ROWS)
    both = gathered(with_x.join(y, "b").select("a", "b", "set_x", "set_y"), n, SET_ROWS)
    return both.mapInArrow(_overlaps(percent), "a bigint, b bigint")


def _common(sets: DataFrame) -> DataFrame:
    """(rep, common): how many of a document's shingles some other document of ``sets`` has too."""
    each = sets.select("doc_id", F.explode("shingles").alias("shingle"))
    own = each.groupBy("shingle").agg(F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("doc_id")).where("n = 1")
    own = own.groupBy(F.col("doc_id").alias("_d")).agg(F.count(F.lit(1)).alias("own"))
    joined = sets.join(own, F.col("doc_id") == F.col("_d"), "left")
    return joined.select(F.col("doc_id").alias("rep"), (F.size("shingles") - F.coalesce("own", F.lit(0))).alias("common"))


def _fits(n: str, m: str, percent: int):
    """Sizes that allow the similarity at all."""
    return F.lit(100) * F.least(n, m) >= F.lit(percent) * F.greatest(n, m)


def near_duplicates(docs: DataFrame, percent: int = 85) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for each row of ``docs`` (columns doc_id, text).

    Words are lower-cased in A-Z; a set holds the distinct 5-word shingles of the whole text, or
    the whole sequence of a shorter one.  Rows with null or empty text have an empty set and stay
    alone.  Rows without doc_id are compared with nothing: component_id null, kept true.  Rows
    that repeat a doc_id are one node.  Other columns are not read.
    """
    texts = docs.select("doc_id", F.col("text").alias("_text"))
    named = store(
        texts.mapInArrow(
            band_rows(WIDTH, BINS, BANDS),
            "doc_id bigint, n_shingles bigint, set_a bigint, set_b bigint, bands array<bigint>",
        ),
        "signatures",
    )
    key = ["set_a", "set_b", "n_shingles"]
    usable = named.where("doc_id is not null and n_shingles > 0")
    n_rows = named.count()
    classes = store(gathered(usable.groupBy(*key).agg(F.min("doc_id").alias("rep")), n_rows), "classes")
    reps = classes.select(F.col("rep").alias("doc_id"), *key)
    members = gathered(usable.join(reps, ["doc_id", *key], "left_semi"), n_rows)
    banded = members.select(F.col("doc_id").alias("rep"), "set_a", "n_shingles", F.explode("bands").alias("key"))
    shared = banded.groupBy("key").agg(F.min("rep").alias("centre"), F.max("rep").alias("last"), F.min_by("n_shingles", "rep").alias("m"))
    shared = shared.where("centre < last").select("key", "centre", "m")
    inside = store(gathered(banded.join(shared, "key"), n_rows * BANDS), "buckets")  # members of buckets that hold two sets or more
    n_inside = inside.count()
    star = inside.where(F.col("rep") != F.col("centre")).where(_fits("n_shingles", "m", percent))
    star = star.select(F.col("rep").alias("a"), F.col("centre").alias("b")).distinct()
    star = store(gathered(star, n_inside), "stars")
    # One pass over the texts serves both rounds of comparison.
    ids = store(gathered(inside.select(F.col("rep").alias("doc_id")).distinct(), n_inside), "ids")
    sets = _sets(ids, texts)
    first = store(_confirmed(star, sets, percent), "links")

    # What the stars leave apart: members of other components in the same bucket.
    found = components(first)
    part = inside.join(found, inside["rep"] == found["node"], "left").select(
        "key", "rep", "set_a", "n_shingles", F.coalesce("component", "rep").alias("part")
    )
    part = gathered(part, n_inside)
    sizes = gathered(part.groupBy("key", "part").agg(F.count(F.lit(1)).alias("n")), n_inside)
    mixed = sizes.groupBy("key").agg(F.count(F.lit(1)).alias("parts"), F.max_by("part", F.struct("n", "part")).alias("main"))
    part = several = store(gathered(part.join(mixed.where("parts > 1").select("key", "main"), "key"), n_inside), "mixed")
    # A partner of a member is a member too, so shingles that no other member has bound what two can
    # share.  This rules most far copies of a large group out before a pair is made.
    n_part = part.count()
    left = store(gathered(part.select(F.col("rep").alias("doc_id")).distinct(), n_part), "ids")
    sets_left = sets.join(broadcast_checked(left), "doc_id", "left_semi")
    # A pair meets in every bucket it shares; it is made in the first one only, told by the keys before.
    # A repeated doc_id has the keys of each of its sets.
    bands = members.select(F.col("doc_id").alias("rep"), "set_a", "bands").dropDuplicates(["rep", "set_a"])
    part = gathered(part.join(_common(sets_left).distinct(), "rep"), n_part).join(bands, ["rep", "set_a"])
    before = F.greatest(F.array_position("bands", F.col("key")) - 1, F.lit(0))
    earlier = F.slice("bands", F.lit(1), before.cast("int"))
    part = store(gathered(part.withColumn("earlier", earlier).drop("bands"), n_part), "open")
    o, m = part.where("part <> main").alias("o"), part.alias("m")
    shared = F.least("o.common", "m.common")
    rest = o.join(m, "key").where(
        (F.col("o.part") != F.col("m.part"))
        & ((F.col("m.part") == F.col("m.main")) | (F.col("o.rep") < F.col("m.rep")))
        & ~F.arrays_overlap("o.earlier", "m.earlier")
        & (F.lit(100) * shared >= F.lit(percent) * (F.col("o.n_shingles") + F.col("m.n_shingles") - shared))
    ).select(F.greatest("o.rep", "m.rep").alias("a"), F.least("o.rep", "m.rep").alias("b")).distinct()
    rest = store(gathered(rest.join(star, ["a", "b"], "left_anti"), n_inside), "rest")
    second = store(_confirmed(rest, sets, percent), "links")

    # Each first component is a star already, which the further links join.
    found = components(found.select(F.col("node").alias("a"), F.col("component").alias("b")).union(second))
    joined = gathered(named.join(classes, key, "left"), n_rows).join(found, F.col("rep") == F.col("node"), "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "rep", "doc_id"))
    result = joined.select(
        "doc_id", "n_shingles", component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"),
    )
    result = store(gathered(result, n_rows), "near")
    discard(named, classes, inside, star, ids, sets, first, several, left, part, rest, second)
    return result


def drop_near_duplicates(docs: DataFrame, percent: int = 85) -> DataFrame:
    """``docs`` with one document of each group of near-duplicates.

    Rows without doc_id and those with null or empty text stay.  Rows that repeat a doc_id are one node:
    they stay or go together, so copies under one id all stay where that id does.  An empty table gives an empty one.
    """
    dropped = near_duplicates(docs, percent).where("not kept").select("doc_id").distinct()
    return docs.join(dropped, "doc_id", "left_anti").select(*docs.columns)

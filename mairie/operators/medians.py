"""Exact medians that never hold a whole large group in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from mairie.session import cut_lineage

# Rows of a group that may be ranked in one task, and how many parts a larger group is cut into per pass.
RANKED_ROWS = 200_000
PIVOTS = 255


def medians(
    df: DataFrame, columns: Sequence[str], keys: Sequence[str] = (), ranked_rows: int = RANKED_ROWS
) -> DataFrame:
    """One row per key with the exact, interpolating median of each column.

    A median is one or two ranks of a group.  Every pass cuts the part of a group that holds a wanted
    rank at ``PIVOTS`` of its values, counts the pieces and keeps the piece with the rank, until the
    rows left can be ranked in one task.  Only counts and pivots are shuffled in a pass and no copy of
    the values is stored; a group of ``n`` rows takes log(n / ``ranked_rows``) / log(``PIVOTS``)
    passes, none if it is small.  Copies of one value are one row.  NaN is larger than any number.
    """
    keys = list(keys)
    group = [*keys, "_column"]
    long = df.select(*keys, *[F.col(c).cast("double").alias(c) for c in columns]).unpivot(
        keys, list(columns), "_column", "_v"
    ).where("_v is not null")
    totals = long.groupBy(*group).agg(F.count(F.lit(1)).alias("_n"))
    # Each wanted rank with the open interval that holds it; null bounds are open to all values.
    ranks = F.array_distinct(F.array(F.floor((F.col("_n") + 1) / 2), F.floor(F.col("_n") / 2) + 1))
    wanted = totals.select(*group, "_n", F.posexplode(ranks).alias("_which", "_rank")).withColumns(
        {"_low": F.lit(None).cast("double"), "_high": F.lit(None).cast("double"), "_found": F.lit(None).cast("double")}
    )
    while (wanted.agg(F.max(F.when(F.col("_found").isNull(), F.col("_n")))).first()[0] or 0) > ranked_rows:
        wanted = cut_lineage(_narrowed(long, wanted, group, ranked_rows), "ranks")
    inside = _inside(long, wanted.where("_found is null"), group)
    counted = inside.groupBy(*group, "_which", "_rank", "_v").agg(F.count(F.lit(1)).alias("_c"))
    running = Window.partitionBy(*group, "_which").orderBy("_v").rowsBetween(Window.unboundedPreceding, 0)
    ranked = counted.withColumn("_upto", F.sum("_c").over(running)).where("_upto >= _rank")
    first = ranked.groupBy(*group, "_which").agg(F.min("_v").alias("_v"))
    values = first.select(*group, "_v").unionByName(wanted.where("_found is not null").select(*group, F.col("_found").alias("_v")))
    halves = [
        (F.min(F.when(F.col("_column") == c, F.col("_v"))) * 0.5 + F.max(F.when(F.col("_column") == c, F.col("_v"))) * 0.5).alias(c)
        for c in columns
    ]
    found = values.groupBy(*keys).agg(*halves)
    if not keys:
        return found
    # Groups without any value still get their row of nulls.
    every = df.select(*keys).distinct()
    found = found.withColumnsRenamed({k: "_" + k for k in keys})
    same = [F.col(k).eqNullSafe(F.col("_" + k)) for k in keys]
    return every.join(found, same, "left").select(*keys, *columns)


def _inside(long: DataFrame, wanted: DataFrame, group: list[str]) -> DataFrame:
    """(group, _which, _rank, _v): the values between the bounds of each wanted rank."""
    v, w = long.alias("v"), wanted.alias("w")
    same = [F.col(f"v.{k}").eqNullSafe(F.col(f"w.{k}")) for k in group]
    bounds = (F.col("_low").isNull() | (F.col("_v") > F.col("_low"))) & (F.col("_high").isNull() | (F.col("_v") < F.col("_high")))
    return v.join(w, same).where(bounds).select("v.*", "w._which", "w._rank")


def _narrowed(long: DataFrame, wanted: DataFrame, group: list[str], ranked_rows: int) -> DataFrame:
    """``wanted`` with the ranks of large intervals moved to a smaller one, or to a found value."""
    large = F.col("_found").isNull() & (F.col("_n") > ranked_rows)
    todo, done = wanted.where(large), wanted.where(~large)
    shares = [k / (PIVOTS + 1) for k in range(1, PIVOTS + 1)]
    by = [*group, "_which"]
    cut = _inside(long, todo, group).groupBy(*by).agg(F.percentile_approx("_v", shares, 10_000).alias("_pivots"))
    cut = cut.withColumn("_pivots", F.array_sort(F.array_distinct("_pivots")))
    t, c = todo.alias("t"), cut.alias("c")
    pivoted = t.join(c, [F.col(f"t.{k}").eqNullSafe(F.col(f"c.{k}")) for k in by]).select("t.*", "c._pivots")
    v, w = long.alias("v"), pivoted.alias("w")
    same = [F.col(f"v.{k}").eqNullSafe(F.col(f"w.{k}")) for k in group]
    bounds = (F.col("_low").isNull() | (F.col("_v") > F.col("_low"))) & (F.col("_high").isNull() | (F.col("_v") < F.col("_high")))
    # Piece 2k lies before pivot k, piece 2k + 1 is that pivot itself.
    below = F.size(F.filter("_pivots", lambda p: p < F.col("_v")))
    piece = 2 * below + F.array_contains("_pivots", F.col("_v")).cast("int")
    pieces = v.join(w, same).where(bounds).select(*[f"w.{c}" for c in by], "_rank", piece.alias("_piece"))
    counts = pieces.groupBy(*by, "_rank", "_piece").agg(F.count(F.lit(1)).alias("_c"))
    running = Window.partitionBy(*by).orderBy("_piece").rowsBetween(Window.unboundedPreceding, 0)  # 2 PIVOTS + 1 rows
    summed = counts.withColumn("_upto", F.sum("_c").over(running))
    hit = summed.where((F.col("_upto") >= F.col("_rank")) & (F.col("_upto") - F.col("_c") < F.col("_rank")))
    p, h = pivoted.alias("p"), hit.alias("h")
    both = p.join(h, [F.col(f"p.{c}").eqNullSafe(F.col(f"h.{c}")) for c in by])
    k = F.floor(F.col("_piece") / 2).cast("int")
    at = lambda i: F.get("_pivots", i)
    moved = both.select(
        *[F.col(f"p.{c}") for c in group], F.col("_c").alias("_n"), F.col("p._which"),
        (F.col("p._rank") - F.col("_upto") + F.col("_c")).alias("_rank"),
        F.when(k > 0, at(F.greatest(k - 1, F.lit(0)))).otherwise(F.col("_low")).alias("_low"),
        F.coalesce(at(k), F.col("_high")).alias("_high"),
        F.when(F.col("_piece") % 2 == 1, at(k)).alias("_found"),
    )
    return done.unionByName(moved)

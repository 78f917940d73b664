"""Grouped aggregates.  Everything pre-aggregates before its shuffle."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mairie.functions.mappings import BLOCS, dominant_bloc, share_column
from mairie.functions.numbers import exact_mean, round_half_up
from mairie.operators.medians import medians
from mairie.operators.windows import share_of_total, share_within


def group_sum(df: DataFrame, keys: Sequence[str], value: str, name: str | None = None) -> DataFrame:
    return df.groupBy(*keys).agg(F.sum(value).alias(name or value))


def bloc_shares(
    votes: DataFrame,
    keys: Sequence[str] = ("code_commune", "annee"),
    bloc: str = "bloc",
    value: str = "nb_voix",
) -> DataFrame:
    """Long form: votes, total and share of each bloc present in a group with votes."""
    grouped = group_sum(votes, [*keys, bloc], value)
    # At most one row per bloc and group is left here.
    shares = share_within(grouped, value, list(keys))
    return shares.where(F.col("pct").isNotNull())


def pivot_shares(
    votes: DataFrame,
    keys: Sequence[str] = ("code_commune", "annee"),
    bloc: str = "bloc",
    value: str = "nb_voix",
    blocs: Sequence[str] = BLOCS,
) -> DataFrame:
    """One row per group with the share of every bloc, 0 where absent.

    Sums, totals and pivot are conditional sums of a single aggregate, so the
    facts are shuffled once and already reduced.  Groups without votes vanish.
    """
    parts = {b: F.sum(F.when(F.col(bloc) == b, F.col(value)).otherwise(0)) for b in blocs}
    wide = votes.groupBy(*keys).agg(
        F.sum(value).alias("_total"), *[c.alias(f"_{b}") for b, c in parts.items()]
    )
    shares = [
        (F.col(f"_{b}").cast("double") / F.col("_total") * 100).alias(share_column(b)) for b in blocs
    ]
    return wide.where("_total > 0").select(*keys, *shares)


def with_dominant_bloc(shares: DataFrame) -> DataFrame:
    """The bloc is chosen on unrounded shares."""
    return shares.withColumn("bloc_dominant", dominant_bloc())


def count_by(df: DataFrame, keys: Sequence[str], name: str = "n") -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def averages(df: DataFrame, columns: Sequence[str], keys: Sequence[str] = (), prefix: str = "moy_") -> DataFrame:
    """Averages of typed columns, by key or overall."""
    return df.groupBy(*keys).agg(*[exact_mean(c).alias(prefix + c) for c in columns])


def median_and_average(
    df: DataFrame, median_of: str, average_of: str, keys: Sequence[str]
) -> DataFrame:
    m = medians(df, [median_of], keys).withColumnRenamed(median_of, "med_" + median_of)
    a = averages(df, [average_of], keys)
    return m.join(a, list(keys))


def overall_median(df: DataFrame, column: str) -> Column:
    """Median of a whole column as a scalar subquery."""
    return medians(df, [column], ()).scalar()


def summary(df: DataFrame, column: str) -> DataFrame:
    """Mean, median, minimum and maximum in one row."""
    stats = df.agg(
        exact_mean(column).alias("moyenne"), F.min(column).alias("min_val"), F.max(column).alias("max_val")
    )
    return stats.withColumn("mediane", overall_median(df, column))


def crosstab(df: DataFrame, row: str, column: str, values: Sequence[str]) -> DataFrame:
    """Counts of ``column`` values per ``row``, 0 where absent; one shuffle, no value scan."""
    return df.groupBy(row).agg(*[F.count_if(F.col(column) == v).alias(v) for v in values])


def level_counts(df: DataFrame, level: str, name: str = "n") -> DataFrame:
    return count_by(df, [level], name)


def yearly_averages(df: DataFrame, columns: dict[str, str], year: str = "annee", digits: int = 1) -> DataFrame:
    """Rows and rounded averages per year, in year order; ``columns`` is name -> source."""
    rounded = [round_half_up(exact_mean(c), digits).alias(n) for n, c in columns.items()]
    return df.groupBy(year).agg(F.count(F.lit(1)).alias("nb_communes"), *rounded).orderBy(year)


def distinct_by(df: DataFrame, key: str, counted: str, name: str) -> DataFrame:
    return df.groupBy(key).agg(F.count_distinct(counted).alias(name)).orderBy(F.desc(name), key)


def distribution_within(df: DataFrame, parent: str, category: str) -> DataFrame:
    """Count and percentage of each category inside its parent."""
    return share_within(count_by(df, [parent, category]), "n", [parent])


def distribution(df: DataFrame, category: str) -> DataFrame:
    return share_of_total(count_by(df, [category]), "n")


def correlations(
    df: DataFrame, indicators: Sequence[str], results: Sequence[str], digits: int | None = None
) -> DataFrame:
    """Pearson correlation of every indicator with every result, over the rows that have both.

    Each row is spread into its pairs, which are reduced before the shuffle to one
    small state per pair and task.  A constant column gives null.
    """
    cells = []
    for i in indicators:
        for r in results:
            both = F.col(i).isNotNull() & F.col(r).isNotNull()
            x, y = (F.when(both, F.col(c).cast("double")) for c in (i, r))
            cells.append(F.struct(F.lit(i).alias("indicateur"), F.lit(r).alias("resultat"), x.alias("x"), y.alias("y")))
    pairs = df.select(F.inline(F.array(*cells)))
    # The built-in corr raises on a constant column, so the quotient is guarded here.
    r = F.covar_pop("x", "y") / F.nullif(F.stddev_pop("x") * F.stddev_pop("y"), F.lit(0.0))
    if digits is not None:
        r = F.round(r.cast("decimal(20,12)"), digits)
    return pairs.groupBy("indicateur", "resultat").agg(r.alias("r"))

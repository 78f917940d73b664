"""Joins.

Where the left side is a fact table, the small side is measured before it is
broadcast, so the facts are neither shuffled needlessly nor joined to a side that
does not fit.  Between aggregated tables no hint is given: adaptive execution
broadcasts by the size it has seen and splits hot keys otherwise.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mairie.functions.mappings import CANDIDATES, contains_rule
from mairie.session import broadcast_checked


def left_enrich(
    df: DataFrame, dimension: DataFrame, keys: str | Sequence[str], facts: bool = False
) -> DataFrame:
    """Left equi-join that keeps every row of ``df``; ``facts`` marks a large left side."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    return df.join(broadcast_checked(dimension) if facts else dimension, keys, "left")


def with_group_total(grouped: DataFrame, keys: Sequence[str], value: str, name: str) -> DataFrame:
    """Total of each parent group beside its parts.

    ``grouped`` is already aggregated, so a parent has a handful of rows; a window
    replaces the join of totals back to their parts.
    """
    return grouped.withColumn(name, F.sum(value).over(Window.partitionBy(*keys)))


def natural_balance(births: DataFrame, deaths: DataFrame, keys=("code_commune", "annee")) -> DataFrame:
    """Births and deaths side by side, with the balance where a missing side counts as 0."""
    merged = births.join(deaths, list(keys), "full_outer")
    balance = F.coalesce("nb_naissances", F.lit(0)) - F.coalesce("nb_deces", F.lit(0))
    return merged.withColumn("solde_naturel", balance)


def nearest_year(years: Column, year: Column) -> Column:
    """Closest element of an array of years; the earlier one on a tie."""
    ranked = F.transform(years, lambda y: F.struct(F.abs(y - year).alias("d"), y.alias("y")))
    return F.array_min(ranked)["y"]


def nearest_year_join(
    df: DataFrame,
    features: DataFrame,
    columns: Sequence[str],
    key: str = "code_commune",
    year: str = "annee",
) -> DataFrame:
    """Left join on the key and the feature year nearest to the row's year.

    The candidate years are all years of the feature table, not those of one
    municipality: a municipality without data in the chosen year gets nulls.  The
    distinct years are few and travel as a scalar subquery.
    """
    years = features.agg(F.collect_set(year)).scalar()
    right = features.select(key, F.col(year).alias("_year"), *columns)
    left = df.withColumn("_years", years)
    left = left.withColumn("_year", nearest_year(F.col("_years"), F.col(year)))
    return left.join(right, [key, "_year"], "left").drop("_year", "_years")


def paired_years(
    df: DataFrame, first: int, second: int, columns: Sequence[str], key: str = "code_commune", year: str = "annee"
) -> DataFrame:
    """Self-join of two years: columns suffixed with the year they come from."""

    def side(value: int) -> DataFrame:
        named = [F.col(c).alias(f"{c}_{value}") for c in columns]
        return df.where(F.col(year) == value).select(key, *named)

    return side(first).join(side(second), key)


def actual_with_predicted(
    facts: DataFrame, predictions: DataFrame, fact_year: int, target_year: int, key: str = "code_commune"
) -> DataFrame:
    """Observed rows of one year joined to predictions for another."""
    p = predictions.where(F.col("annee") == target_year).select(
        key, "bloc_predit", *[c for c in predictions.columns if c.startswith("prob_")]
    )
    return facts.where(F.col("annee") == fact_year).join(p, key)


def difference_to(
    base: DataFrame,
    earlier: DataFrame,
    columns: Sequence[str],
    key: str = "code_commune",
    suffix: str = "_trend",
    default: float = 0.0,
) -> DataFrame:
    """``base - earlier`` per column: ``default`` when the key is unknown, null when a value is."""
    old = earlier.select(key, F.lit(True).alias("_found"), *[F.col(c).alias(f"_old_{c}") for c in columns])
    joined = base.join(old, key, "left")
    trends = {
        f"{c}{suffix}": F.when(
            F.col("_found"), F.col(c).cast("double") - F.col(f"_old_{c}").cast("double")
        ).when(F.col("_found").isNull(), F.lit(default))
        for c in columns
    }
    return joined.withColumns(trends).drop("_found", *[f"_old_{c}" for c in columns])


def for_each_year(df: DataFrame, years: Sequence[int], name: str) -> DataFrame:
    """Every row once per literal year, by exploding a constant array."""
    return df.withColumn(name, F.explode(F.array(*[F.lit(y).cast("smallint") for y in years])))


def dictionary_join(
    df: DataFrame, table: DataFrame, column: str | Column, key: str, label: str, name: str, default=None
) -> DataFrame:
    """Look ``column`` up in a dictionary table; ``default`` where it is absent."""
    column = F.col(column) if isinstance(column, str) else column
    lookup = table.select(F.col(key).alias("_key"), F.col(label).alias(name))
    joined = df.withColumn("_key", column).join(broadcast_checked(lookup), "_key", "left").drop("_key")
    return joined if default is None else joined.fillna({name: default})


def contains_map(df: DataFrame, column: str, name: str, rules=CANDIDATES) -> DataFrame:
    """First rule whose key contains the value or is contained in it."""
    return df.withColumn(name, contains_rule(column, rules))

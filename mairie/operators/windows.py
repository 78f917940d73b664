"""Previous-row features inside a municipality."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from mairie.functions.mappings import MAIN_BLOCS, share_column

MAIN_SHARES = [share_column(b) for b in MAIN_BLOCS]


def lag_features(
    df: DataFrame,
    key: str = "code_commune",
    year: str = "annee",
    shares: list[str] = MAIN_SHARES,
    bloc: str = "bloc_dominant",
) -> DataFrame:
    """Lag of every share, of the bloc and of the year.

    The lag is the previous row of the municipality, whatever its year.  A
    municipality has one row per election, so its window stays small.
    """
    w = Window.partitionBy(key).orderBy(year)
    lags = {f"{c}_lag1": F.lag(c, 1).over(w) for c in shares}
    lags["bloc_lag1"] = F.lag(bloc, 1).over(w)
    lags["annee_lag1"] = F.lag(year, 1).over(w)
    return df.withColumns(lags)


def trend_features(df: DataFrame, year: str = "annee", shares: list[str] = MAIN_SHARES) -> DataFrame:
    """Difference to the previous row, and the years in between."""
    trends = {f"{c}_trend": F.col(c) - F.col(f"{c}_lag1") for c in shares}
    trends["intervalle"] = F.col(year) - F.col("annee_lag1")
    return df.withColumns(trends)


def share_of_total(grouped: DataFrame, count: str, name: str = "pct") -> DataFrame:
    """Each group's count as a percentage of the grand total.

    The total is a scalar subquery over the grouped rows: no un-partitioned window.
    """
    total = grouped.agg(F.sum(count).cast("double")).scalar()
    return grouped.withColumn(name, F.col(count).cast("double") * 100 / F.nullif(total, F.lit(0.0)))


def share_within(grouped: DataFrame, count: str, keys: list[str], name: str = "pct") -> DataFrame:
    """Each group's count as a percentage of its parent group, over already grouped rows."""
    total = F.sum(count).over(Window.partitionBy(*keys)).cast("double")
    return grouped.withColumn(name, F.col(count).cast("double") * 100 / F.nullif(total, F.lit(0.0)))

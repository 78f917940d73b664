"""Profiles and data-quality checks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mairie.operators.harmonise import quoted


def validation_row(df: DataFrame, table: str, year: str | None, key: str) -> DataFrame:
    """Rows, first and last year, distinct keys of one table."""
    years = F.col(year).cast("bigint") if year else F.lit(None).cast("bigint")
    return df.agg(
        F.count(F.lit(1)).alias("n"),
        F.min(years).alias("annee_min"),
        F.max(years).alias("annee_max"),
        F.count_distinct(key).alias("cles"),
    ).select(F.lit(table).alias("table_name"), "*")


def coverage_row(df: DataFrame, column: str, digits: int = 2) -> DataFrame:
    """Rows, non-null values and the rounded mean, minimum and maximum."""
    value = F.col(column).cast("decimal(18,6)")
    mean = F.sum(value).cast("double") / F.nullif(F.count(value), F.lit(0))

    def shown(c: Column) -> Column:
        return F.round(c.cast("decimal(20,8)"), digits)

    return df.agg(
        F.count(F.lit(1)).alias("total"),
        F.count(value).alias("non_null"),
        shown(mean).alias("moyenne"),
        shown(F.min(value)).alias("min_val"),
        shown(F.max(value)).alias("max_val"),
    )


def count_non_null(df: DataFrame, column: str, name: str = "n") -> DataFrame:
    return df.agg(F.count_if(F.col(column).isNotNull()).alias(name))


def _null_counts(df: DataFrame) -> DataFrame:
    """(colonne, remplis, total) for every column, from a single aggregate."""
    counts = df.agg(
        F.count(F.lit(1)).alias("_total"), *[F.count(quoted(c)).alias(f"c{i}") for i, c in enumerate(df.columns)]
    )
    cells = [
        F.struct(F.lit(c).alias("colonne"), F.col(f"c{i}").alias("remplis"), F.col("_total").alias("total"))
        for i, c in enumerate(df.columns)
    ]
    return counts.select(F.inline(F.array(*cells)))


def fill_rates(df: DataFrame, digits: int = 1, only_incomplete: bool = False) -> DataFrame:
    """Percentage of non-null values per column."""
    rate = F.col("remplis").cast("double") * 100 / F.nullif(F.col("total"), F.lit(0))
    out = _null_counts(df).select("colonne", F.round(rate.cast("decimal(12,8)"), digits).alias("taux"))
    return out.where(F.col("taux") < 100) if only_incomplete else out


def missing_values(df: DataFrame) -> DataFrame:
    """Columns with missing values, worst first."""
    missing = F.col("total") - F.col("remplis")
    return (
        _null_counts(df)
        .select(
            "colonne",
            missing.alias("manquants"),
            (missing.cast("double") / F.col("total") * 100).alias("pourcentage"),
        )
        .where("manquants > 0")
        .orderBy(F.desc("pourcentage"), "colonne")
    )


def dataset_profile(df: DataFrame, name: str) -> DataFrame:
    """Rows, columns and the type of every column of a dataset."""
    types = [
        F.struct(F.lit(i).alias("position"), F.lit(c).alias("colonne"), F.lit(t).alias("type"))
        for i, (c, t) in enumerate(df.dtypes)
    ]
    return df.agg(F.count(F.lit(1)).alias("lignes")).select(
        F.lit(name).alias("jeu"),
        "lignes",
        F.lit(len(df.columns)).alias("nb_colonnes"),
        F.inline(F.array(*types)),
    )


def value_counts(df: DataFrame, column: str, by_value: bool = False) -> DataFrame:
    """Frequency of each non-null value, by frequency or by value."""
    counts = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    return counts.orderBy(column) if by_value else counts.orderBy(F.desc("n"), column)


def distinct_count(df: DataFrame, column: str, name: str = "n") -> DataFrame:
    return df.agg(F.count_distinct(column).alias(name))


def sorted_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct().orderBy(column)


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once; empty when the key is unique."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def null_violations(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Nulls of each required column, and whether the rule holds."""
    counts = df.agg(*[F.count_if(quoted(c).isNull()).alias(f"c{i}") for i, c in enumerate(columns)])
    cells = [
        F.struct(F.lit(c).alias("colonne"), F.col(f"c{i}").alias("nuls")) for i, c in enumerate(columns)
    ]
    return counts.select(F.inline(F.array(*cells))).withColumn("ok", F.col("nuls") == 0)


def load_check(source: DataFrame, written: DataFrame, table: str) -> DataFrame:
    """Row count of the written table, read back, against its source."""
    expected = source.agg(F.count(F.lit(1))).scalar()
    return written.agg(F.count(F.lit(1)).alias("ecrites")).select(
        F.lit(table).alias("table_name"),
        expected.alias("attendues"),
        "ecrites",
        (F.col("ecrites") == expected).alias("ok"),
    )


def coverage_check(
    df: DataFrame, column: str, min_fill: float, mean_range: tuple[float, float] | None = None
) -> DataFrame:
    """Coverage figures with one pass/fail flag per expectation."""
    value = F.col(column).cast("decimal(18,6)")
    stats = df.agg(
        F.count(F.lit(1)).alias("total"), F.count(value).alias("non_null"), F.sum(value).alias("_sum")
    )
    fill = F.col("non_null").cast("double") / F.nullif(F.col("total"), F.lit(0)) * 100
    mean = F.col("_sum").cast("double") / F.nullif(F.col("non_null"), F.lit(0))
    out = stats.select(
        F.lit(column).alias("colonne"), "total", "non_null",
        (fill >= min_fill).alias("couverture_ok"), mean.alias("moyenne"),
    )
    low, high = mean_range or (None, None)
    ok = F.col("moyenne").between(low, high) if mean_range else F.lit(True)
    return out.withColumn("moyenne_ok", ok)


def table_counts(tables: Mapping[str, DataFrame], layers: Mapping[str, str]) -> DataFrame:
    """Rows of every table with its layer; ``layers`` is table -> layer."""
    from mairie.operators.ordering import union_all

    return union_all(
        *[
            df.agg(F.count(F.lit(1)).alias("n")).select(
                F.lit(layers[name]).alias("couche"), F.lit(name).alias("table_name"), "n"
            )
            for name, df in tables.items()
        ]
    )


def layer_tables(spark: SparkSession, layers: Sequence[str]) -> DataFrame:
    """Number of catalogued tables in each layer's database."""
    from mairie.operators.ordering import union_all

    listed = [spark.sql(f"SHOW TABLES IN `{layer}`").where("not isTemporary") for layer in layers]
    return union_all(
        *[
            tables.agg(F.count(F.lit(1)).alias("tables")).select(F.lit(layer).alias("couche"), "tables")
            for layer, tables in zip(layers, listed)
        ]
    )

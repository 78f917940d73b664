"""Typed Parquet tables: scan, full refresh and keyed update."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mairie.operators.harmonise import enforce_schema
from mairie.sources import published
from mairie.sources.schemas import KEYS, PARTITIONS, REQUIRED, table_schema

OPEN_FILES = 32
_WRITERS = "spark.sql.maxConcurrentOutputFileWriters"


def scan_table(
    spark: SparkSession, path: str, columns: Sequence[str] | None = None, where: Column | str | None = None
) -> DataFrame:
    """Scan of a published table, or of a plain folder, with a column list and a predicate,
    both pushed into the Parquet reader."""
    df = published.scan(spark, path) if published.manifest(spark, path) else spark.read.parquet(path)
    if where is not None:
        df = df.where(where)
    return df.select(*columns) if columns else df


def write_table(
    df: DataFrame, path: str, partition_by: Sequence[str] = (), rebalance: bool = True
) -> DataFrame:
    """Full refresh: overwrite, then read back.

    Rows of a partitioned table are rebalanced on the partition columns first:
    small values share a task and a value holding most rows is split over many, so
    files come out near the advisory size.  Input that is already laid out by those
    columns can skip that shuffle with ``rebalance=False``; a task then keeps a file open for each of
    its first ``OPEN_FILES`` partition values and sorts only the rows of further ones.
    """
    if partition_by and rebalance:
        df = df.hint("rebalance", *partition_by)
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    conf = df.sparkSession.conf
    before = conf.get(_WRITERS, "0")
    if partition_by and not rebalance:
        conf.set(_WRITERS, str(OPEN_FILES))
    try:
        writer.parquet(path)
    finally:
        conf.set(_WRITERS, before)
    # The known schema keeps partition values in their declared type.
    return df.sparkSession.read.schema(df.schema).parquet(path).select(*df.columns)


def create_table(df: DataFrame, name: str, path: str, min_rows: int = 0) -> DataFrame:
    """Publish a table of the catalogue with its declared types, checked before anyone can read it.

    Repeated keys and nulls in required columns refuse the load and leave the published rows as they are.
    """
    typed = enforce_schema(df, table_schema(name))
    return published.refresh(
        typed, path, PARTITIONS.get(name, ()), KEYS.get(name, ()), REQUIRED.get(name, ()), min_rows=min_rows
    )


def register_table(spark: SparkSession, name: str, path: str) -> DataFrame:
    """Drop and recreate the catalogue entry of a written table, for SQL text queries.

    The entry of a published table names the data folder that is current now.
    """
    found = published.manifest(spark, path)
    if found and (len(found["parts"]) > 1 or found["parts"][0]["without"]):
        raise ValueError(f"{path} has several parts: refresh it before it is registered")
    path = f"{path}/{found['parts'][0]['folder']}" if found else path
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.catalog.createTable(name, path=path, source="parquet")
    if spark.sql(f"DESCRIBE {name}").where("col_name = '# Partition Information'").count():
        spark.catalog.recoverPartitions(name)
    return spark.table(name)


def update_by_key(df: DataFrame, updates: DataFrame, keys: Sequence[str], column: str) -> DataFrame:
    """New values of ``column`` for the keys in ``updates``; the others keep theirs.

    ``updates`` has unique keys.  Write the result to a new path: a Parquet folder
    must not be overwritten while it is read.
    """
    new = updates.select(*keys, F.col(column).alias("_new"), F.lit(True).alias("_hit"))
    joined = df.join(new, list(keys), "left")
    kind = df.schema[column].dataType
    value = F.when(F.col("_hit"), F.col("_new")).otherwise(F.col(column)).cast(kind)
    return joined.withColumn(column, value).select(*df.columns)

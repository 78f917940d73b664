"""Chunked load of a growing folder of result files.

A plain append repeats rows when a job is retried.  A file stream with an
available-now trigger reads each new file once, in bounded batches, and its
checkpoint makes the append exactly-once after the loss of any executor.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession

from mairie.sources.delimited import scan_delimited


def append_new_files(
    spark: SparkSession,
    folder: str,
    target: str,
    checkpoint: str,
    transform: Callable[[DataFrame], DataFrame],
    sep: str = ";",
    files_per_batch: int = 100,
    partition_by: Sequence[str] = (),
) -> DataFrame:
    """Append the rows of files not loaded before; returns the whole target table.

    Partitions are those of the batch table; a file whose header differs from the first one's raises.
    """
    # Header names only: all columns are strings, as in the batch scan.
    schema = scan_delimited(spark, folder, sep).schema
    stream = (
        spark.readStream.schema(schema)
        .option("sep", sep)
        .option("header", True)
        .option("enforceSchema", False)
        .option("quote", '"')
        .option("escape", '"')
        .option("maxFilesPerTrigger", files_per_batch)
        .csv(folder)
    )
    typed = transform(stream)
    query = (
        typed.writeStream.format("parquet")
        .outputMode("append")
        .partitionBy(*partition_by)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start(target)
    )
    query.awaitTermination()
    return spark.read.schema(typed.schema).parquet(target).select(*typed.columns)

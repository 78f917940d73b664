"""Delimited text: every column is read as a string and nothing is inferred."""

from __future__ import annotations

import csv
import re
from collections import Counter
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mairie.operators.harmonise import quoted


def scan_delimited(
    spark: SparkSession, path: str, sep: str = ";", encoding: str = "UTF-8", multiline: bool = False
) -> DataFrame:
    """Splittable scan of a delimited file or folder.

    Large files are read in ``spark.sql.files.maxPartitionBytes`` slices by all
    executors; ``multiline`` gives that up for quoted line breaks.  Files of a folder
    must have one header; a file with other names or another order raises (``scan_folder`` takes such folders).
    """
    return (
        spark.read.option("sep", sep)
        .option("header", True)
        .option("enforceSchema", False)  # a file whose header differs raises
        .option("inferSchema", False)
        .option("encoding", encoding)
        .option("multiLine", multiline)
        .option("quote", '"')
        .option("escape", '"')
        .csv(path)
    )


FILE_ORDER = "_ordre"


def with_file_order(df: DataFrame, name: str = FILE_ORDER) -> DataFrame:
    """Position of each row in its file, right after a scan.

    File, slice offset and the running number inside the slice sort as the lines
    do, so "the first row of a key" means the first line, however the file is split.
    """
    return df.withColumn(
        name,
        F.struct(
            F.col("_metadata.file_path").alias("fichier"),
            F.col("_metadata.file_block_start").alias("debut"),
            F.monotonically_increasing_id().alias("ligne"),
        ),
    )


def peek(df: DataFrame, n: int = 5) -> tuple[list[str], DataFrame]:
    """Column names, which need no data pass, and a lazy sample of ``n`` rows."""
    return df.columns, df.limit(n)


def _lines(spark: SparkSession, path: str, encoding: str) -> DataFrame:
    """(value, file, start): undivided lines, decoded, in the order of their slice; blank ones are left out."""
    whole = (
        spark.read.option("sep", "\u0001").option("quote", "").option("encoding", encoding).option("header", False).schema("value string")
    )
    return whole.csv(path).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start")
    )


def _names(line: str, sep: str) -> list[str]:
    """Column names of a header line; empty ones by position, repeated ones with their position."""
    cells = [n.strip() for n in next(csv.reader([line.lstrip("\ufeff").rstrip("\r")], delimiter=sep))]
    times = Counter(n.lower() for n in cells)
    return [f"_c{i}" if not n else f"{n}{i}" if times[n.lower()] > 1 else n for i, n in enumerate(cells)]


def headers(spark: SparkSession, path: str, sep: str = ";", encoding: str = "UTF-8", marker: str | None = None) -> dict[str | None, list[str]]:
    """The files of each header line: a file's first line or, with ``marker``, its first line with such a cell.

    One distributed pass over the lines; the driver receives the distinct headers and the file names.
    Files that hold lines but no such one are listed under None.
    """
    lines = _lines(spark, path, encoding).withColumn("line", F.struct("start", F.monotonically_increasing_id(), "value"))
    if marker is None:
        is_header = F.col("start") == 0
    else:
        edge = re.escape(sep)
        is_header = F.col("value").rlike(f'(^\ufeff?|{edge})"?\\s*{re.escape(marker)}\\s*"?({edge}|\\r?$)')
    first = lines.groupBy("file").agg(F.min(F.when(is_header, F.col("line"))).alias("line"))
    found = first.groupBy("line.value").agg(F.sort_array(F.collect_list("file")).alias("files")).orderBy(F.col("files")[0])
    return {r["value"]: [unquote(f) for f in r["files"]] for r in found.collect()}


def _read(spark: SparkSession, files, names: list[str], sep: str, encoding: str, header: bool) -> DataFrame:
    return (
        spark.read.option("sep", sep)
        .option("header", header)
        .option("mode", "PERMISSIVE")
        .option("encoding", encoding)
        .option("quote", '"')
        .option("escape", '"')
        .schema(T.StructType([T.StructField(n, T.StringType()) for n in names]))
        .csv(files)
    )


def _united(spark: SparkSession, found: dict[str, list[str]], sep: str, encoding: str, header: bool, order: str | None, keep=None) -> DataFrame:
    """The files of each header read with its own columns, then put together by name; a column that a file lacks is null."""
    parts = []
    for line, files in found.items():
        literal = [re.sub(r"([{}\[\]*?\\])", r"\\\1", f) for f in files]
        part = _read(spark, literal, _names(line, sep), sep, encoding, header)
        part = with_file_order(part, order) if order else part
        parts.append(part.where(keep) if keep is not None else part)
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def scan_folder(spark: SparkSession, path: str, sep: str = ";", encoding: str = "UTF-8", order: str | None = None) -> DataFrame:
    """Scan of a folder whose files differ in the names or the order of their columns.

    Files are grouped by header, each group is one splittable scan, and columns meet by name: one that
    a file lacks is null.  ``order`` names a column for the rows' place in their files (``with_file_order``).
    Finding the headers costs a pass over the lines, so folders with one header are for ``scan_delimited``.
    """
    found = headers(spark, path, sep, encoding)
    if not found:
        raise ValueError(f"no header line in {path}")
    return _united(spark, found, sep, encoding, True, order)


def scan_sheet(
    spark: SparkSession, path: str, marker: str, code_pattern: str = "^[0-9][0-9ABab]?[0-9]*$", sep: str = ";",
    encoding: str = "UTF-8", order: str | None = None,
) -> DataFrame:
    """Sheets exported as delimited text, with free-form lines above their headers.

    A file's header is its first line with a cell equal to ``marker``; data rows are those whose marker
    column matches ``code_pattern``.  Files may differ in the names and the order of their columns, which
    meet by name.  Files without a header line go on with that of the others, if those agree on one.
    ``order`` names a column for the rows' place in their files (``with_file_order``).
    """
    found = headers(spark, path, sep, encoding, marker)
    without = found.pop(None, [])
    if not found:
        raise ValueError(f"no header line with {marker!r} in {path}")
    code = F.trim(quoted(marker)).rlike(code_pattern)
    if len(found) == 1:
        names = _names(next(iter(found)), sep)
        rows = _read(spark, path, names, sep, encoding, False)
        return (with_file_order(rows, order) if order else rows).where(code)
    if without:
        raise ValueError(f"several headers with {marker!r}, but none in {without[0]}")
    return _united(spark, found, sep, encoding, False, order, code)

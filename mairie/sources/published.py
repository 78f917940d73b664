"""Published tables: data folders that one small manifest names.

A load writes a new folder beside the table, checks it, and only then replaces the manifest by a
rename, so readers see the old rows or the new ones and a refused load leaves the table as it was.
The manifest also holds the row count, and the files an append has read, which makes a repeated
append do nothing.

    root/_current.json      {"columns", "partition_by", "rows", "parts": [...], "sources": {...}}
    root/data-<id>/...      Parquet files, in partition folders where the table has them

A part is a folder and the partitions of it that later updates have replaced.  Folders that the manifest
no longer names are kept for running readers until ``vacuum``.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mairie.session import broadcast_checked

CURRENT = "_current.json"
FILE_BYTES = 128 * 1024 * 1024
SPARE_FILES = 16  # small files that a partition may have beyond those its bytes need


class LoadRefused(ValueError):
    """A check failed; the published table is unchanged."""


# ---- small files on the table's file system


def _fs(spark: SparkSession, path: str):
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    where = hadoop.Path(path)
    return hadoop, where, where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _read_text(spark: SparkSession, path: str) -> str | None:
    _, where, fs = _fs(spark, path)
    if not fs.exists(where):
        return None
    stream = fs.open(where)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def _replace_text(spark: SparkSession, path: str, text: str) -> None:
    """Write beside ``path`` and rename over it in one step."""
    beside = f"{path}.{uuid.uuid4().hex}"
    hadoop, where, fs = _fs(spark, beside)
    stream = fs.create(where, False)
    stream.write(bytearray(text.encode()))
    stream.close()
    context = hadoop.FileContext.getFileContext(where.toUri(), spark.sparkContext._jsc.hadoopConfiguration())
    options = spark.sparkContext._gateway.new_array(hadoop.Options.Rename, 1)
    options[0] = hadoop.Options.Rename.OVERWRITE
    context.rename(where, hadoop.Path(path), options)


def delete(spark: SparkSession, path: str) -> None:
    _, where, fs = _fs(spark, path)
    fs.delete(where, True)


def list_files(spark: SparkSession, folder: str) -> dict[str, tuple[int, int]]:
    """Path -> (bytes, time of change) of every visible file below ``folder``, or of the file it names.

    Spark lists large folders in tasks; the files' content is not read.
    """
    found = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder)
    rows = found.select("path", "length", F.unix_millis("modificationTime").alias("changed")).collect()
    return {r["path"]: (r["length"], r["changed"]) for r in rows}


# ---- manifest


def manifest(spark: SparkSession, root: str) -> dict | None:
    """What is published at ``root``, or None."""
    text = _read_text(spark, f"{root}/{CURRENT}")
    return json.loads(text) if text is not None else None


def _same(column: str, value) -> Column:
    return F.col(column).eqNullSafe(F.lit(value))


def _of_partitions(partition_by: Sequence[str], values: Sequence[Sequence]) -> Column:
    each = [reduce(lambda a, b: a & b, [_same(c, v) for c, v in zip(partition_by, row, strict=True)]) for row in values]
    return reduce(lambda a, b: a | b, each)


def scan(spark: SparkSession, root: str) -> DataFrame:
    """The published rows; partition filters reach the folders."""
    found = manifest(spark, root)
    if found is None:
        raise FileNotFoundError(f"nothing is published at {root}")
    schema, by = T.StructType.fromJson(found["columns"]), found["partition_by"]
    frames = []
    for part in found["parts"]:
        df = spark.read.schema(schema).parquet(f"{root}/{part['folder']}").select(*schema.fieldNames())
        frames.append(df.where(~_of_partitions(by, part["without"])) if part["without"] else df)
    return reduce(DataFrame.unionAll, frames)


def _publish(spark: SparkSession, root: str, seen: dict | None, new: dict) -> None:
    """Name ``new`` current, unless another load was published since ``seen`` was read."""
    now = manifest(spark, root)
    if (now or {}).get("version") != (seen or {}).get("version"):
        raise LoadRefused(f"{root} was changed by another load")
    _replace_text(spark, f"{root}/{CURRENT}", json.dumps({**new, "version": uuid.uuid4().hex}))


def vacuum(spark: SparkSession, root: str) -> list[str]:
    """Delete the data folders that the manifest does not name; call when no reader uses older versions."""
    found = manifest(spark, root)
    named = {part["folder"] for part in found["parts"]} if found else set()
    _, where, fs = _fs(spark, root)
    gone = [s.getPath().getName() for s in fs.listStatus(where) if s.isDirectory()]
    gone = [name for name in gone if name.startswith("data-") and name not in named]
    for name in gone:
        delete(spark, f"{root}/{name}")
    return gone


# ---- writing


def write_folder(df: DataFrame, folder: str, partition_by: Sequence[str] = (), file_bytes: int = FILE_BYTES) -> None:
    """Write rows from the tasks that made them, then join small files of a partition.

    No row is shuffled: a task of a scan holds few partition values, as result files come by
    election, and sorts its own rows by them.
    """
    writer = df.write
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(folder)
    if partition_by:
        kept = [f for f in df.schema.fields if f.name not in partition_by]
        join_small_files(df.sparkSession, folder, T.StructType(kept), file_bytes)


def join_small_files(
    spark: SparkSession, folder: str, schema: T.StructType, file_bytes: int = FILE_BYTES, parallel: int = 16
) -> int:
    """Rewrite, folder by folder, the files under half of ``file_bytes`` where ``SPARE_FILES`` or more are too many.

    A folder ends with at most its bytes / half of ``file_bytes`` + ``SPARE_FILES`` + 1 files.  Files of a good size are not touched, so what is rewritten stays small however large the table is.
    Returns the number of folders rewritten.  For folders that nobody reads yet; ``schema`` is that of the files.
    """
    small: dict[str, list[str]] = {}
    sizes: dict[str, int] = {}
    large: set[str] = set()
    for path, (length, _) in list_files(spark, folder).items():
        parent = path.rsplit("/", 1)[0]
        if length < file_bytes / 2:
            small.setdefault(parent, []).append(path)
            sizes[parent] = sizes.get(parent, 0) + length
        else:
            large.add(parent)
    work = [(parent, paths, -(-sizes[parent] // file_bytes)) for parent, paths in small.items() if len(paths) > SPARE_FILES - (-sizes[parent] // file_bytes)]
    hadoop, _, fs = _fs(spark, folder)

    def rewrite(job) -> None:
        parent, paths, files = job
        beside = f"{folder}-joined-{uuid.uuid4().hex}"
        spark.read.schema(schema).parquet(*paths).coalesce(int(files)).write.parquet(beside)
        source, target = hadoop.Path(beside), hadoop.Path(parent)
        if parent not in large:  # every file is joined: the folder itself is replaced
            fs.delete(target, True)
            fs.rename(source, target)
            return
        for path in list_files(spark, beside):
            fs.rename(hadoop.Path(path), target)
        for path in paths:
            fs.delete(hadoop.Path(path), False)
        fs.delete(source, True)

    if work:
        with ThreadPoolExecutor(parallel) as pool:
            list(pool.map(rewrite, work))
    return len(work)


def _loaded(
    df: DataFrame, root: str, partition_by: Sequence[str], required: Sequence[str], min_rows: int,
    rules: Mapping[str, Column], file_bytes: int,
) -> tuple[str, dict]:
    """Write a checked folder; its name and the figures counted while it was written."""
    spark, name = df.sparkSession, f"data-{uuid.uuid4().hex}"
    watch = Observation()
    figures = [F.count(F.lit(1)).alias("rows")]
    figures += [F.count_if(F.col(f"`{c}`").isNull()).alias(f"null_{i}") for i, c in enumerate(required)]
    figures += [F.count_if(~F.coalesce(rule, F.lit(False))).alias(f"rule_{i}") for i, rule in enumerate(rules.values())]
    folder = f"{root}/{name}"
    try:
        write_folder(df.observe(watch, *figures), folder, partition_by, file_bytes)
        seen = watch.get
        faults = [f"{seen[f'null_{i}']} nulls in {c}" for i, c in enumerate(required) if seen[f"null_{i}"]]
        faults += [f"{seen[f'rule_{i}']} rows break {r!r}" for i, r in enumerate(rules) if seen[f"rule_{i}"]]
        if seen["rows"] < min_rows:
            faults.append(f"{seen['rows']} rows instead of {min_rows} or more")
        # The count in the files' footers, against the rows that went into the write.
        stored = spark.read.schema(df.schema).parquet(folder).count()
        if stored != seen["rows"]:
            faults.append(f"{stored} rows stored of {seen['rows']}")
        if faults:
            raise LoadRefused(f"{root}: " + "; ".join(faults))
    except Exception:
        delete(spark, folder)
        raise
    return name, seen


def _unique(df: DataFrame, keys: Sequence[str]) -> None:
    if keys and df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1").limit(1).count():
        raise LoadRefused(f"more than one row for a value of {', '.join(keys)}")


def refresh(
    df: DataFrame, root: str, partition_by: Sequence[str] = (), keys: Sequence[str] = (), required: Sequence[str] = (),
    rules: Mapping[str, Column] | None = None, min_rows: int = 0, file_bytes: int = FILE_BYTES,
) -> DataFrame:
    """Replace the table: write, check, publish; the published rows.

    Refused, with the table unchanged, are nulls in ``required``, rows for which a rule is not true,
    fewer than ``min_rows`` rows, and repeated ``keys``.  Counts come from the write itself; only the
    key check reads the new folder, and of it the key columns.
    """
    spark, before = df.sparkSession, manifest(df.sparkSession, root)
    name, seen = _loaded(df, root, partition_by, required, min_rows, rules or {}, file_bytes)
    try:
        _unique(spark.read.schema(df.schema).parquet(f"{root}/{name}"), keys)
        new = {
            "columns": df.schema.jsonValue(), "partition_by": list(partition_by), "rows": seen["rows"],
            "parts": [{"folder": name, "without": []}], "sources": {},
        }
        _publish(spark, root, before, new)
    except Exception:
        delete(spark, f"{root}/{name}")
        raise
    return scan(spark, root)


def append_files(
    spark: SparkSession, root: str, folder: str, read: Callable[[list[str]], DataFrame], partition_by: Sequence[str] = (),
    required: Sequence[str] = (), rules: Mapping[str, Column] | None = None, file_bytes: int = FILE_BYTES,
) -> DataFrame:
    """Append the files of ``folder`` that the table has not read yet; the published rows.

    ``read`` makes typed rows of a list of files.  The files' names are published with their rows, so an
    append that is repeated, or was cut off at any point, counts each file once.  A file that changed
    after it was read, and rows of other columns or partitions than the table's, are refused.
    """
    before = manifest(spark, root)
    known = before["sources"] if before else {}
    files = list_files(spark, folder)
    changed = [path for path, mark in files.items() if path in known and known[path] != list(mark)]
    if changed:
        raise LoadRefused(f"changed since they were read: {', '.join(sorted(changed))}")
    new = sorted(path for path in files if path not in known)
    if not new:
        if before is None:
            raise LoadRefused(f"no file in {folder}")
        return scan(spark, root)
    df = read(new)
    if before and (T.StructType.fromJson(before["columns"]) != df.schema or before["partition_by"] != list(partition_by)):
        raise LoadRefused(f"{root} has other columns or partitions")
    name, seen = _loaded(df, root, partition_by, required, 0, rules or {}, file_bytes)
    parts = (before["parts"] if before else []) + [{"folder": name, "without": []}]
    fresh = {
        "columns": df.schema.jsonValue(), "partition_by": list(partition_by), "parts": parts,
        "rows": seen["rows"] + (before["rows"] if before else 0),
        "sources": {**known, **{path: list(files[path]) for path in new}},
    }
    try:
        _publish(spark, root, before, fresh)
    except Exception:
        delete(spark, f"{root}/{name}")
        raise
    return scan(spark, root)


def update(spark: SparkSession, root: str, updates: DataFrame, keys: Sequence[str], column: str, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Set ``column`` to the value in ``updates`` for its keys; the published rows.

    Only partitions that hold a changed key are written again, to a new folder; the others keep their
    files.  Keys that the table does not have change nothing; repeated keys in ``updates`` are refused.
    The number of partitions, not of rows, is what the driver sees.
    """
    before = manifest(spark, root)
    if before is None:
        raise FileNotFoundError(f"nothing is published at {root}")
    _unique(updates, keys)
    table, by = scan(spark, root), before["partition_by"]
    if column in by or column in keys:
        raise LoadRefused(f"{column} decides where a row belongs")
    new = broadcast_checked(updates.select(*keys, F.col(column).alias("_new"), F.lit(True).alias("_hit")))
    touched = [list(row) for row in table.join(new, list(keys), "left_semi").select(*by).distinct().collect()] if by else [[]]
    if not touched:
        return table
    rows = table.where(_of_partitions(by, touched)) if by else table
    kind = table.schema[column].dataType
    value = F.when(F.col("_hit"), F.col("_new").cast(kind)).otherwise(F.col(column))
    written = rows.join(new, list(keys), "left").withColumn(column, value).select(*table.columns)
    name, _ = _loaded(written, root, by, (), 0, {}, file_bytes)
    if by:
        parts = [{**part, "without": part["without"] + touched} for part in before["parts"]]
    else:
        parts = []
    try:
        _publish(spark, root, before, {**before, "parts": [*parts, {"folder": name, "without": []}]})
    except Exception:
        delete(spark, f"{root}/{name}")
        raise
    return scan(spark, root)


def listed(spark: SparkSession, out: str, layers: Sequence[str]) -> DataFrame:
    """(couche, table_name, n) of every table published below ``out/<layer>``; no table is scanned."""
    found = []
    for layer in layers:
        _, where, fs = _fs(spark, f"{out}/{layer}")
        for entry in fs.listStatus(where) if fs.exists(where) else []:
            name = entry.getPath().getName()
            known = manifest(spark, f"{out}/{layer}/{name}")
            if known:
                found.append((layer, name, known["rows"]))
    return spark.createDataFrame(found, "couche string, table_name string, n bigint")

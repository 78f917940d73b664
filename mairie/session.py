"""Session defaults, the shared work folder, lineage cuts and checked broadcasts."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# A side is broadcast only when its measured size stays under this bound.
BROADCAST_BYTES = 64 * 1024 * 1024


def build_session(app: str = "mairie", master: str | None = None, **conf: str) -> SparkSession:
    """Session with the settings the library expects; ``conf`` overrides them.

    Shuffle partitions are left to the cluster unless given: adaptive execution
    merges small ones and splits skewed ones.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
    }
    settings.update(conf)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local session without that setting gets a temporary folder of its own.
    """
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="run-"))
    return context.getCheckpointDir().rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    """Fresh path in the shared folder; nothing is created or overwritten."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame, name: str = "cut") -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Later steps reuse the written rows and survive the loss of any executor.
    """
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def measured_bytes(df: DataFrame) -> int:
    """Upper estimate of the in-memory size: string bytes plus 16 bytes per cell."""
    strings = [
        F.octet_length(F.col(f"`{f.name}`").cast("string"))
        for f in df.schema.fields
        if f.dataType.simpleString() in ("string", "binary")
    ]
    text = F.lit(0)
    for s in strings:
        text = text + F.coalesce(s, F.lit(0))
    rows, chars = df.agg(F.count(F.lit(1)), F.coalesce(F.sum(text), F.lit(0))).first()
    return int(rows) * 16 * len(df.columns) + int(chars)


def broadcast_checked(df: DataFrame, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """``df`` with a broadcast hint if its measured size allows it, else ``df`` as it is.

    Without the hint the join shuffles and adaptive execution splits hot keys.
    """
    return F.broadcast(df) if measured_bytes(df) <= max_bytes else df

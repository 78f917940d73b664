"""Reading, storing and connecting: what several operators of this package need."""

from __future__ import annotations

from contextlib import contextmanager
from math import ceil

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mairie.session import new_path

_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
WORD = r"[^\x20\x09-\x0D]+"
TASK_ROWS = 50_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@contextmanager
def _shuffles_removed(spark: SparkSession):
    """Shuffle files of the executions inside go when they end, so disk holds one step at a time."""
    before = spark.conf.get(_CLEANUP, "false")
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(_CLEANUP, before)


def store(df: DataFrame, name: str, **options: str) -> DataFrame:
    """Write ``df`` to the shared folder (``spark.checkpoint.dir``) and read it back.

    Cuts the lineage: a lost executor costs at most the step being run, and the step's own
    shuffle files are removed once its rows are written.
    """
    spark = df.sparkSession
    path = new_path(spark, name)
    with _shuffles_removed(spark):
        df.write.options(**options).parquet(path)
    stored = spark.read.schema(df.schema).parquet(path)
    stored.stored_path = path
    return stored


def gathered(df: DataFrame, rows: int, each: int = TASK_ROWS) -> DataFrame:
    """``df``, which has up to ``rows`` rows, in no more partitions than these need: one for ``each``, one a core at least.

    Nothing is shuffled.  Where partitions are many and rows few, tasks cost more than what they do;
    with many rows this changes nothing.
    """
    return df.coalesce(max(df.sparkSession.sparkContext.defaultParallelism, ceil(rows / each)))


def discard(*frames: DataFrame) -> None:
    """Delete what ``store`` wrote for frames that no later step reads."""
    for df in frames:
        context = df.sparkSession.sparkContext
        path = context._jvm.org.apache.hadoop.fs.Path(df.stored_path)
        path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of ``links`` (columns ``a``, ``b``); component is the smallest node.

    Alternates large-star and small-star steps until the edges no longer change; the number
    of rounds grows with the logarithm of a chain's length.  Every step is an aggregate with
    map-side combine (the smallest neighbour) and a join with that one row per node, which
    adaptive execution splits where a node has very many neighbours.  Self links and repeated
    links are dropped; an empty table gives an empty one.
    """
    a, b = F.col("a"), F.col("b")
    edges = links.where("a <> b").select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b"))
    edges = store(gathered(edges.distinct(), links.count()), "edges")
    seen = None
    while True:
        mark = edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first()
        if tuple(mark) == seen or not mark[0]:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
                edges.select("b", "b").distinct()
            )
        seen, n = tuple(mark), mark[0]
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = gathered(gathered(large.where("a <> b"), n).distinct(), n)
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        small = gathered(small, n).union(gathered(low.select("a", F.col("m").alias("b")), n))
        before, edges = edges, store(gathered(small.distinct(), n), "edges")
        discard(before)

"""From raw documents to packed training sequences, stage by stage.

Each stage takes what the one before wrote.  The first four keep the columns of documents; the
last returns the packed pieces with their token ids.  Null columns, rows that repeat and empty
tables are no errors in any of them: an empty table gives an empty one, and each stage says what
becomes of the others.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from mairie.llm import lines, minhash, mixing, packing, pii
from mairie.llm.common import discard, store, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents by the line-frequency rules and takes frequent lines out of the others.

    Null and empty texts are rejected; rows that repeat are each judged.
    """
    return lines.clean_documents(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays: word shingles with a similarity of 0.8 or more.

    Rows without doc_id or text stay; rows that repeat a doc_id stay or go together.
    """
    return minhash.drop_near_duplicates(docs, percent=80)


def private(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced by its kind, in every row; null and empty texts stay as they are."""
    return pii.mask_private(docs, pii.fit(docs.select("doc_id", "text")))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their source's target weight takes them, laid out shard by shard in shuffled order.

    A null source is one of its own; texts without words are never taken; rows that repeat are each taken.
    """
    return mixing.mixed_rows(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces and their places in sequences of 1024; null and empty texts give their end alone."""
    return packing.pack_documents(docs)


STAGES = [("quality", quality), ("near_dedup", near_dedup), ("pii", private), ("mixing", mix), ("packing", pack)]
# Near-duplicate search, learnt spans and token ids are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = before = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = store(stage(spark, docs, sf_dir), name)
        if name != STAGES[0][0]:
            discard(before)  # read for the last time; the documents themselves stay
        before = docs
    return STAGES[-1][1](spark, docs, sf_dir)

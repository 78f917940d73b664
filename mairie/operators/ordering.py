"""Ordering, top-k, samples and unions."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mairie.operators.aggregates import count_by


def top_groups(df: DataFrame, key: str, k: int, name: str = "n") -> DataFrame:
    """The ``k`` most frequent keys; equal counts are ordered by key."""
    return count_by(df, [key], name).orderBy(F.desc(name), key).limit(k)


def first_rows(df: DataFrame, n: int, order: Sequence[Column | str]) -> DataFrame:
    """First ``n`` rows in an explicit order (each task keeps ``n`` at most)."""
    return df.orderBy(*order).limit(n)


def sample_rows(df: DataFrame, n: int, keys: Sequence[str], seed: int = 42) -> DataFrame:
    """``n`` rows in a seeded random order.

    The order comes from a hash of the row's keys and the seed, so a retried task
    and a differently partitioned run draw the same rows.
    """
    salted = F.concat_ws("|", F.lit(str(seed)), *[F.col(k).cast("string") for k in keys])
    return df.orderBy(F.md5(salted), *keys).limit(n)


def union_all(*frames: DataFrame) -> DataFrame:
    """Union by column name, duplicates kept; absent columns become null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)

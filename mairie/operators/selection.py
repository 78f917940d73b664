"""Row selection."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mairie.functions.codes import _col
from mairie.session import broadcast_checked

# Department prefixes of the metropolitan area and overseas, kinds of
# municipality that are kept, and priority lists of the births and deaths measures.
METROPOLITAN_RANGE = ("01", "95")
CORSICA = ["2A", "2B"]
OVERSEAS = ["97", "98", "99"]
COMMUNE_KINDS = ["COM", "COMD", "ARM"]
BIRTH_MEASURES = ["LVB", "NOMBRE", "T", "TOTAL"]
DEATH_MEASURES = ["LDB", "NOMBRE", "T", "TOTAL"]
PILOT_BIRTH_MEASURES = ["NOMBRE", "T", "TOTAL", "NAIS"]


def keep_in(df: DataFrame, column: str, values: Sequence) -> DataFrame:
    return df.where(F.col(column).isin(list(values)))


def semi_filter(df: DataFrame, reference: DataFrame, key: str, reference_key: str | None = None) -> DataFrame:
    """Rows whose key occurs in the reference table.

    The reference keys are broadcast when their measured size allows it, so the
    big side is filtered where it is scanned.
    """
    keys = reference.select(F.col(reference_key or key).alias(key)).distinct()
    return df.join(broadcast_checked(keys), key, "left_semi")


def is_metropolitan(code: Column | str) -> Column:
    prefix = F.substring(_col(code), 1, 2)
    return (prefix.between(*METROPOLITAN_RANGE) | prefix.isin(CORSICA)) & ~prefix.isin(OVERSEAS)


def member_or_null(column: Column | str, values: Sequence = COMMUNE_KINDS) -> Column:
    column = _col(column)
    return column.isin(list(values)) | column.isNull()


def prefer_measure(df: DataFrame, column: str, priority: Sequence[str]) -> DataFrame:
    """Keep the first measure of the priority list that occurs; keep all when none does.

    The choice is a scalar subquery: one partial aggregate, no driver round trip.
    """
    rank = F.when(F.lit(False), F.lit(None).cast("int"))
    for i, measure in enumerate(priority):
        rank = rank.when(F.col(column) == measure, i)
    best = df.agg(F.min(rank)).scalar()
    chosen = F.get(F.array(*[F.lit(m) for m in priority]), best)
    return df.where(F.col(column).eqNullSafe(F.coalesce(chosen, F.col(column))))


def first_round_presidential(elections: DataFrame) -> DataFrame:
    return elections.where(
        (F.col("type_election") == "pres") & (F.col("tour") == 1) & F.col("nb_voix").isNotNull()
    )


def temporal_split(
    df: DataFrame, last_train_year: int, test_year: int, lag: str = "bloc_lag1", year: str = "annee"
) -> tuple[DataFrame, DataFrame]:
    """Train up to a year, test on a later one; rows without a previous election are left out."""
    usable = df.where(F.col(lag).isNotNull())
    return usable.where(F.col(year) <= last_train_year), usable.where(F.col(year) == test_year)


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """First row of each key in an explicit order.

    The rank filter is applied before the shuffle as well (Catalyst's window group
    limit), so a key with very many copies sends one row per task.
    """
    w = Window.partitionBy(*keys).orderBy(*[_col(o) for o in order])
    return df.withColumn("_rank", F.row_number().over(w)).where("_rank = 1").drop("_rank")


def drop_nulls(df: DataFrame, *columns: str) -> DataFrame:
    return df.dropna(subset=list(columns))

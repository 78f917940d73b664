"""Two-level median imputation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mairie.operators.medians import medians
from mairie.session import cut_lineage


def spread_group_median(
    df: DataFrame, columns: Sequence[str], group: str, suffix: str = "_median"
) -> DataFrame:
    """Group medians beside every row; rows of a null group get null."""
    m = medians(df.where(F.col(group).isNotNull()), columns, [group])
    m = m.select(group, *[F.col(c).alias(c + suffix) for c in columns])
    return df.join(m, group, "left")


def impute_medians(
    df: DataFrame, columns: Sequence[str], group: str = "code_dep"
) -> DataFrame:
    """Nulls become the group median, then the overall median of the filled column.

    All group medians come from one aggregate, all overall medians from a second
    one.  The group-filled rows are written once between the two.
    """
    order = df.columns
    spread = spread_group_median(df, columns, group, "_median")
    filled = spread.withColumns(
        {c: F.coalesce(F.col(c).cast("double"), F.col(c + "_median")) for c in columns}
    ).select(*order)
    filled = cut_lineage(filled, "filled")
    overall = medians(filled, columns, ())
    national = overall.select(F.struct(*columns)).scalar()
    return filled.withColumns({c: F.coalesce(F.col(c), national[c]) for c in columns})

"""Territory typology and its ordinal code."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from mairie.functions.codes import _col

# Labels in ordinal order and the lower bounds of the two upper classes.
TERRITORY_TYPES = ["rural", "periurbain", "urbain"]
THRESHOLDS = {"population": (2_000, 10_000), "density": (50, 1_500)}


def territory_type(
    measure: Column | str, mode: str = "population", thresholds: tuple[float, float] | None = None
) -> Column:
    """``urbain`` / ``periurbain`` / ``rural`` from population (default) or density."""
    measure = _col(measure)
    middle, upper = thresholds or THRESHOLDS[mode]
    return (
        F.when(measure >= upper, "urbain").when(measure >= middle, "periurbain").otherwise("rural")
    )


def territory_rank(label: Column | str) -> Column:
    """rural 0, periurbain 1, urbain 2; anything else 0."""
    label = _col(label)
    return F.when(label == "urbain", 2).when(label == "periurbain", 1).otherwise(0)

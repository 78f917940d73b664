"""Estimated poverty rate of a municipality from its median income and Gini index."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from mairie.functions.codes import _col
from mairie.functions.numbers import clamp, interpolate

# Constants of the estimation rule.
POVERTY_SHARE = 0.6            # threshold as a share of the national median
FIXED_NATIONAL_MEDIAN = 22810.0
RATE_LIMITS = (0.0, 50.0)
POOR_GINI = (35.0, 0.25, 80.0)      # base, origin, slope below the threshold
USUAL_GINI = (-5.0, 0.20, 100.0)    # base, origin, slope above it
POOR_RATIO, POOR_FACTOR = 0.75, 1.4
RICH_RATIO, RICH_FACTOR = 1.25, 0.6
LOW_INCOME = 0.80                   # share of the threshold under which the rate is flat
LOW_RATE, THRESHOLD_RATE = 40.0, 25.0
INCOME_STEPS = [(0.90, 15.0), (1.10, 10.0), (1.30, 6.0)]
TOP_RATE = 3.0
RATE_BINS = [0, 5, 10, 15, 20, 30, 50]
RATE_BIN_LABELS = ["<5%", "5-10%", "10-15%", "15-20%", "20-30%", ">30%"]


def poverty_rate(
    median: Column | str,
    gini: Column | str,
    national_median: Column | float = FIXED_NATIONAL_MEDIAN,
    digits: int | None = None,
) -> Column:
    """Three-level rule: Gini and income, income alone, or null without income.

    ``national_median`` is a number or a column (usually a scalar subquery);
    ``digits`` rounds half-even.
    """
    m, g = _col(median).cast("double"), _col(gini).cast("double")
    n = national_median if isinstance(national_median, Column) else F.lit(float(national_median))
    n = n.cast("double")
    line = n * POVERTY_SHARE

    def slope(rule):
        base, origin, factor = rule
        return F.lit(base) + (g - F.lit(origin)) * F.lit(factor)

    usual = slope(USUAL_GINI)
    ratio = m / n
    usual = (
        F.when(ratio < POOR_RATIO, usual * POOR_FACTOR)
        .when(ratio > RICH_RATIO, usual * RICH_FACTOR)
        .otherwise(usual)
    )
    with_gini = clamp(F.when(m < line, slope(POOR_GINI)).otherwise(usual), *RATE_LIMITS)

    low = line * LOW_INCOME
    income_only = F.when(m < low, LOW_RATE).when(
        m < line, interpolate(m, low, line, LOW_RATE, THRESHOLD_RATE)
    )
    for share, rate in INCOME_STEPS:
        income_only = income_only.when(m < n * share, rate)
    income_only = income_only.otherwise(TOP_RATE)

    rate = F.when(m.isNotNull(), F.when(g.isNotNull(), with_gini).otherwise(income_only))
    return rate if digits is None else F.bround(rate, digits)


def poverty_level(median: Column | str, gini: Column | str) -> Column:
    """1: income and Gini, 2: income alone, 3: no income."""
    m, g = _col(median), _col(gini)
    return F.when(m.isNull(), 3).when(g.isNotNull(), 1).otherwise(2)

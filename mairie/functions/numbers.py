"""Numeric parsing, rounding and guarded arithmetic."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from mairie.functions.codes import _col

def to_number(c: Column | str) -> Column:
    """Text to double; anything that is not a plain decimal number becomes null.

    The cast itself also takes ``12d``, ``1f``, ``NaN`` and hexadecimal floats: those
    end in a letter or hold an ``x``, which is cheaper to test than a pattern.
    """
    text = F.trim(_col(c).cast("string"))
    plain = F.right(text, F.lit(1)).isin(list("0123456789.")) & ~F.contains(F.lower(text), F.lit("x"))
    return F.when(plain, text.try_cast("double"))


def to_integer(c: Column | str, dtype: str = "bigint") -> Column:
    """Text to a nullable integer; ``'12.0'`` is 12, ``'12.5'`` and out-of-range values are null.

    Plain digits take the direct cast; only other texts go through double.
    """
    text, number = F.trim(_col(c).cast("string")), to_number(c)
    return F.coalesce(
        text.try_cast(dtype), F.when(number == F.floor(number), number.try_cast(dtype))
    )


def decimal_comma(c: Column | str, dtype: str = "double") -> Column:
    """Text with a decimal comma to double, or straight to a decimal type.

    Text that is no number, or does not fit the decimal type, becomes null.
    """
    text = F.replace(_col(c).cast("string"), F.lit(","), F.lit("."))
    return to_number(text) if dtype == "double" else F.trim(text).try_cast(dtype)


def sum_ignoring_nulls(*cols: Column | str) -> Column:
    """Row-wise sum where null counts as 0 (all null gives 0)."""
    parts = [F.coalesce(_col(c), F.lit(0)) for c in cols]
    return reduce(lambda a, b: a + b, parts)


def percentage(part: Column | str, total: Column | str, digits: int | None = 3) -> Column:
    """``part / total * 100``, null unless ``total > 0``; rounded half-even to ``digits``."""
    total = _col(total).cast("double")
    value = _col(part).cast("double") / total * 100
    if digits is not None:
        value = F.bround(value, digits)
    return F.when(total > 0, value)


def clamp(c: Column | str, low: float, high: float) -> Column:
    """``c`` limited to ``[low, high]``; null stays null."""
    c = _col(c)
    return F.when(c.isNotNull(), F.greatest(F.lit(low), F.least(F.lit(high), c)))


def interpolate(x: Column | str, x0, x1, y0: float, y1: float) -> Column:
    """Straight line through ``(x0, y0)`` and ``(x1, y1)``."""
    x = _col(x)
    x0 = x0 if isinstance(x0, Column) else F.lit(float(x0))
    x1 = x1 if isinstance(x1, Column) else F.lit(float(x1))
    return F.lit(float(y0)) + (x - x0) / (x1 - x0) * F.lit(float(y1 - y0))


def round_half_even(c: Column | str, digits: int) -> Column:
    return F.bround(_col(c), digits)


def round_half_up(c: Column | str, digits: int) -> Column:
    """Report rounding: through an exact decimal, halves away from zero."""
    return F.round(_col(c).cast("decimal(28,10)"), digits)


def bin_label(c: Column | str, edges: list[float], labels: list[str]) -> Column:
    """Label of the right-closed interval holding ``c``; null outside every interval."""
    if len(edges) != len(labels) + 1:
        raise ValueError("one more edge than labels is needed")
    c = _col(c)
    out = F.when(F.lit(False), F.lit(None).cast("string"))
    for low, high, label in zip(edges, edges[1:], labels):
        out = out.when((c > low) & (c <= high), label)
    return out


def exact_mean(c: Column | str) -> Column:
    """Average of a decimal or integer column as one exact sum and one division.

    The result does not depend on how rows were split over tasks, unlike an
    average of doubles.
    """
    c = _col(c)
    return F.sum(c).cast("double") / F.nullif(F.count(c), F.lit(0))

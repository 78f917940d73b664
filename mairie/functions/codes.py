"""Municipality, department and election identifiers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Metropolitan departments (01-95 without 20, plus both Corsicas),
# the four departments of the pilot area, and its department names.
METROPOLITAN_DEPARTMENTS = [f"{n:02d}" for n in range(1, 96) if n != 20] + ["2A", "2B"]
PILOT_DEPARTMENTS = ["75", "92", "93", "94"]
PILOT_DEPARTMENT_NAMES = {
    "75": "Paris",
    "92": "Hauts-de-Seine",
    "93": "Seine-Saint-Denis",
    "94": "Val-de-Marne",
}


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def zfill(c: Column | str, width: int) -> Column:
    """Left-pad with zeros to ``width``; longer values are kept whole (``lpad`` would cut them)."""
    c = _col(c)
    return F.when(F.length(c) < width, F.lpad(c, width, "0")).otherwise(c)


def commune_code(c: Column | str) -> Column:
    return zfill(F.trim(_col(c).cast("string")), 5)


def department_code(c: Column | str, style: str = "national") -> Column:
    """Normalised department.

    ``national``: trim, upper-case, pad to two characters only when all digits.
    ``pilot``: strip every leading zero first, so ``075`` and ``75`` agree.
    """
    c = F.trim(_col(c).cast("string"))
    if style == "pilot":
        return zfill(F.ltrim(c, F.lit("0")), 2)
    if style != "national":
        raise ValueError(f"unknown department style {style!r}")
    c = F.upper(c)
    return F.when(c.rlike("^[0-9]+$"), zfill(c, 2)).otherwise(c)


def composite_code(department: Column | str, commune: Column | str) -> Column:
    """Municipality code from a department part (2) and a local part (3)."""
    return F.concat(
        zfill(F.upper(F.trim(_col(department))), 2), zfill(F.trim(_col(commune)), 3)
    )


def department_of(code: Column | str) -> Column:
    return F.substring(_col(code), 1, 2)


def department_name(code: Column | str) -> Column:
    """Name of a pilot-area department, the code itself elsewhere.

    The code is trimmed and stripped of leading zeros before the lookup, so
    ``75``, ``75 `` and ``092`` all find their name.
    """
    code = _col(code)
    key = department_code(code, "pilot")
    name = F.when(F.lit(False), F.lit(None).cast("string"))
    for value, label in PILOT_DEPARTMENT_NAMES.items():
        name = name.when(key == value, label)
    return F.coalesce(name, F.trim(code))


def election_year(election_id: Column | str) -> Column:
    """First run of four digits, null when there is none.

    Identifiers usually start with the year, which needs no pattern.
    """
    c = _col(election_id)
    leading = F.substring(c, 1, 4).try_cast("smallint")
    anywhere = F.regexp_substr(c, F.lit("[0-9]{4}")).try_cast("smallint")
    return F.when(leading >= 1000, leading).otherwise(anywhere)


def election_type(election_id: Column | str) -> Column:
    """Second ``_``-separated token, null when there is only one."""
    c = _col(election_id)
    token = F.substring_index(F.substring_index(c, "_", 2), "_", -1)
    return F.when(F.contains(c, F.lit("_")), token)


def election_round(election_id: Column | str) -> Column:
    """Digit after the first ``t`` that is followed by a digit."""
    digit = F.regexp_extract(_col(election_id), "t([0-9])", 1)
    return F.nullif(digit, F.lit("")).try_cast("smallint")


def is_presidential_first_round_id(election_id: Column | str) -> Column:
    """Identifier pattern of the alternative election filter (``PR...T1``)."""
    return _col(election_id).like("PR%T1")


def upper_trim(c: Column | str) -> Column:
    """Upper-case and strip; accents are kept."""
    return F.upper(F.trim(_col(c)))

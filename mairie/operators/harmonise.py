"""Schema harmonisation: projections built from column names only, no data is read."""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mairie.functions.numbers import decimal_comma

# Aliases of the municipality referential and its target columns.
REFERENTIAL_ALIASES = [
    ("COM", "code_insee"), ("CODGEO", "code_insee"), ("LIBELLE", "libelle"), ("NCC", "libelle"),
    ("DEP", "code_dep"), ("REG", "code_reg"), ("STATUT", "statut"), ("ARR", "arr"),
]
# Income measures and the keywords that find their columns.
INCOME_KEYWORDS_ALL = {
    "mediane_revenu_disp": [["DISP", "DIAN"], ["DISP", "MEDI"]],
    "q1_revenu_disp": [["DISP", "QUARTILE", "1"], ["DISP", "D1"]],
    "q9_revenu_disp": [["DISP", "QUARTILE", "3"], ["DISP", "D9"]],
    "gini": [["DISP", "GINI"]],
    "taux_pauvrete": [["DISP", "PAUVR"], ["DISP", "PAUV"]],
    "mediane_revenu_dec": [["DEC", "DIAN"], ["DEC", "MEDI"]],
}
INCOME_KEYWORDS_ANY = {
    "mediane_revenu_disp": ["D5", "MED", "MEDI"],
    "q1_revenu_disp": ["D1"],
    "q9_revenu_disp": ["D9"],
    "gini": ["GINI"],
    "taux_pauvrete": ["TPAUV", "PAUVRE", "PAUV"],
    "mediane_revenu_dec": ["DEC"],
}


def quoted(name: str) -> Column:
    """Column by exact name, whatever spaces, dots or brackets it holds."""
    return F.col("`" + name.replace("`", "``") + "`")


def rename_aliases(df: DataFrame, aliases: Sequence[tuple[str, str]]) -> DataFrame:
    """Case-insensitive alias rename; of several columns with one target, the first in the file stays."""
    targets = {source.upper(): target for source, target in aliases}
    taken: set[str] = set()
    out = []
    for name in df.columns:
        target = targets.get(name.upper(), name)
        if target not in taken:
            taken.add(target)
            out.append(quoted(name).alias(target))
    return df.select(*out)


def keep_existing(df: DataFrame, wanted: Iterable[str]) -> DataFrame:
    """The wanted columns that exist, in the wanted order."""
    return df.select(*[quoted(c) for c in wanted if c in df.columns])


def add_missing(df: DataFrame, wanted: Mapping[str, str]) -> DataFrame:
    """Append each absent column as a typed null."""
    absent = {c: F.lit(None).cast(t) for c, t in wanted.items() if c not in df.columns}
    return df.withColumns(absent) if absent else df


def find_all_keywords(columns: Sequence[str], *alternatives: Sequence[str]) -> str | None:
    """First column holding every keyword of the first alternative that matches at all."""
    for keywords in alternatives:
        for name in columns:
            if all(k.upper() in name.upper() for k in keywords):
                return name
    return None


def find_any_keyword(columns: Sequence[str], keywords: Sequence[str], token: str) -> str | None:
    """First column with ``token`` and the first keyword that occurs beside it."""
    for keyword in keywords:
        for name in columns:
            if token in name and keyword.upper() in name.upper():
                return name
    return None


def find_key_column(columns: Sequence[str], style: str = "national") -> str:
    """Municipality code column.

    ``national``: 'code' together with 'geo', or a known name, else the second column.
    ``pilot``: 'géographique', 'codgeo' or exactly 'code', else the first column.
    """
    for name in columns:
        low = name.lower()
        if style == "pilot":
            if "géographique" in low or "codgeo" in low or low == "code":
                return name
        elif "code" in low and ("géo" in low or "geo" in low):
            return name
        elif low in ("codgeo", "code_insee", "code_commune"):
            return name
    return columns[0 if style == "pilot" else min(1, len(columns) - 1)]


def geographic_columns(columns: Sequence[str]) -> list[str]:
    """Names that mention a code, a commune or the statistical office's code."""
    return [c for c in columns if re.search("code|commune|insee", c, re.IGNORECASE)]


def map_columns(
    df: DataFrame, mapping: Mapping[str, str], convert=None, keep: Sequence[str] = ()
) -> DataFrame:
    """Fixed-name projection ``source -> target``; absent sources become null columns."""
    convert = convert or (lambda c: c)
    out = [quoted(c) for c in keep]
    for source, target in mapping.items():
        value = quoted(source) if source in df.columns else F.lit(None).cast("string")
        out.append(convert(value).alias(target))
    return df.select(*out)


def columns_with_prefix(df: DataFrame, prefix: str) -> list[str]:
    return [c for c in df.columns if c.startswith(prefix)]


def columns_with_tag(df: DataFrame, tag: str) -> list[str]:
    return [c for c in df.columns if tag in c]


def wide_to_long(
    df: DataFrame,
    keys: Sequence[str],
    measures: Mapping[str, Sequence[str]] = INCOME_KEYWORDS_ANY,
    default_year: int = 2022,
    convert=decimal_comma,
) -> DataFrame:
    """One row per (keys, year found in a column name).

    A single pass: every input row is exploded into one struct per year.  Without
    any year in the names each key gets one row of nulls for ``default_year``.
    """
    others = [c for c in df.columns if c not in keys]
    years = sorted({int(m.group()) for c in others if (m := re.search(r"\d{4}", c))})
    rows = []
    for year in years or [default_year]:
        fields = [F.lit(year).cast("smallint").alias("annee")]
        for target, keywords in measures.items():
            source = find_any_keyword(others, keywords, str(year)) if years else None
            value = convert(quoted(source)) if source else F.lit(None).cast("double")
            fields.append(value.alias(target))
        rows.append(F.struct(*fields))
    return df.select(*[quoted(k) for k in keys], F.inline(F.array(*rows)))


def enforce_schema(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Cast and order the columns of ``schema``; absent ones become null.

    Fractions are rounded half away from zero before they land in an integer
    column, as a typed SQL table does; a plain cast would cut them off.
    """
    out = []
    for field in schema.fields:
        if field.name not in df.columns:
            value = F.lit(None)
        else:
            value = quoted(field.name)
            source = df.schema[field.name].dataType
            if isinstance(field.dataType, T.IntegralType) and isinstance(
                source, (T.FractionalType, T.DecimalType)
            ):
                value = F.round(value, 0)
        out.append(value.cast(field.dataType).alias(field.name))
    return df.select(*out)


def with_constants(df: DataFrame, stamp: str | None = None, **values) -> DataFrame:
    """Constant columns, plus an optional load timestamp column."""
    columns = {name: F.lit(value) for name, value in values.items()}
    if stamp:
        columns[stamp] = F.current_timestamp()
    return df.withColumns(columns)


def rename_drop(df: DataFrame, renames: Mapping[str, str] = {}, drop: Sequence[str] = ()) -> DataFrame:
    return df.withColumnsRenamed(dict(renames)).drop(*drop)

"""Bronze frames (all strings) to typed silver tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mairie.functions import codes
from mairie.functions.numbers import decimal_comma, sum_ignoring_nulls, to_integer, to_number
from mairie.functions.poverty import FIXED_NATIONAL_MEDIAN, poverty_rate
from mairie.functions.territory import territory_type
from mairie.operators import harmonise as h
from mairie.operators import selection as s
from mairie.operators.aggregates import overall_median
from mairie.sources.delimited import FILE_ORDER
from mairie.sources.schemas import table_schema

# Source columns of the silver tables.
ELECTION_COLUMNS = {
    "nuance": "nuance_liste",
    "liste": "nom_liste",
    "nom": "nom_candidat",
    "prenom": "prenom_candidat",
    "sexe": "sexe",
    "voix": "nb_voix",
    "ratio_voix_inscrits": "pct_voix_ins",
    "ratio_voix_exprimes": "pct_voix_exp",
}
OCCUPATIONS = ["agriculteurs", "artisans", "cadres", "prof_interm", "employes", "ouvriers"]
OCCUPATION_COLUMNS = {
    f"csx_rec{i}taxtypac_rec{j}rpop2022": f"{name}_{state}"
    for i, name in enumerate(OCCUPATIONS, start=1)
    for j, state in enumerate(["emploi", "chomeurs"], start=1)
}
DIPLOMA_COLUMNS = {
    "P22_NSCOL15P": "nscol15p",
    "P22_NSCOL15P_DIPLMIN": "sans_diplome",
    "P22_NSCOL15P_BEPC": "bepc_brevet",
    "P22_NSCOL15P_CAPBEP": "cap_bep",
    "P22_NSCOL15P_BAC": "bac",
    "P22_NSCOL15P_SUP2": "sup_bac2",
    "P22_NSCOL15P_SUP34": "sup_bac34",
    "P22_NSCOL15P_SUP5": "sup_bac5",
}
POPULATION_PREFIX = "P22_POP"
SNAPSHOT_YEAR = 2022


def referential(
    raw: DataFrame,
    departments: Sequence[str] | None = None,
    style: str = "national",
    keep_raw_department: bool = False,
) -> DataFrame:
    """Municipalities of the wanted departments, with normalised codes."""
    wanted = departments or (
        codes.PILOT_DEPARTMENTS if style == "pilot" else codes.METROPOLITAN_DEPARTMENTS
    )
    schema = table_schema("referentiel_communes")
    named = h.rename_aliases(raw, h.REFERENTIAL_ALIASES)
    kept = h.keep_existing(named, [*schema.fieldNames(), "TYPECOM", FILE_ORDER])
    department = codes.department_code("code_dep", style)
    kept = kept.withColumn("code_insee", codes.commune_code("code_insee")).where(
        department.isin(list(wanted))
    )
    if style == "national" and "TYPECOM" in kept.columns:
        kept = kept.where(s.member_or_null("TYPECOM"))
        # One row per code: a commune before a delegated one before a district, then line order.
        rank = F.when(F.col("TYPECOM") == "COM", 0).when(F.col("TYPECOM") == "COMD", 1).otherwise(2)
        order = [F.col(FILE_ORDER)] if FILE_ORDER in kept.columns else [F.col(c).asc_nulls_last() for c in kept.columns]
        kept = s.keep_first(kept, ["code_insee"], [rank, *order])
    if not keep_raw_department:
        kept = kept.withColumn("code_dep", department)
    return h.enforce_schema(kept, schema)


def named_departments(ref: DataFrame) -> DataFrame:
    """The municipality view of the pilot area: code, name and department name."""
    return ref.select(
        "code_insee", "libelle", "code_dep", codes.department_name("code_dep").alias("nom_departement")
    )


def elections(raw: DataFrame, ref: DataFrame | None = None) -> DataFrame:
    """Result rows of known municipalities.

    One splittable scan, one semi filter against the referential and projections:
    no shuffle of the results when the referential fits the broadcast bound.
    """
    df = raw.withColumn("code_commune", codes.commune_code("code_commune"))
    if ref is not None:
        df = s.semi_filter(df, ref, "code_commune", "code_insee")
    df = df.withColumns(
        {
            "annee": codes.election_year("id_election"),
            "type_election": codes.election_type("id_election"),
            "tour": codes.election_round("id_election"),
        }
    )
    keys = ["code_commune", "id_election", "annee", "type_election", "tour"]
    df = h.map_columns(df, ELECTION_COLUMNS, keep=keys)
    df = df.withColumns(
        {
            "nb_voix": to_integer("nb_voix", "int"),
            "pct_voix_ins": decimal_comma("pct_voix_ins", "decimal(6,3)"),
            "pct_voix_exp": decimal_comma("pct_voix_exp", "decimal(6,3)"),
        }
    )
    return h.enforce_schema(df, table_schema("elections"))


def vital_events(
    raw: DataFrame,
    ref: DataFrame | None,
    value: str,
    priority: Sequence[str],
    order: Sequence[str] | None = None,
) -> DataFrame:
    """Births (``nb_naissances``) or deaths (``nb_deces``): one row per municipality and year.

    Of several rows of one key the first in ``order`` stays: the line order when
    the scan recorded it, else the smallest value.
    """
    df = s.prefer_measure(raw, "EC_MEASURE", priority) if "EC_MEASURE" in raw.columns else raw
    df = df.withColumn("code_commune", codes.commune_code("GEO"))
    if ref is not None:
        df = s.semi_filter(df, ref, "code_commune", "code_insee")
    df = df.withColumns(
        {"annee": to_integer("TIME_PERIOD", "smallint"), value: to_integer("OBS_VALUE", "int")}
    )
    table = "naissances" if value == "nb_naissances" else "deces"
    return h.enforce_schema(_first_of_year(df, order or [value]), table_schema(table))


def _first_of_year(df: DataFrame, fallback: Sequence[str]) -> DataFrame:
    """First row per municipality and year: in line order if recorded, else by value."""
    order = [F.col(FILE_ORDER)] if FILE_ORDER in df.columns else []
    order += [F.col(c).asc_nulls_last() for c in fallback]
    return s.keep_first(df, ["code_commune", "annee"], order)


def income(
    raw: DataFrame,
    ref: DataFrame | None = None,
    layout: str = "snapshot",
    year: int = SNAPSHOT_YEAR,
    national_median: float | None = None,
    digits: int | None = 1,
    prefer_source: bool = False,
) -> DataFrame:
    """Income table with the estimated poverty rate.

    ``snapshot``: one year for the file.  ``by_year``: years are read from the column
    names.  ``national_median`` None takes the median of the data; ``prefer_source``
    keeps a poverty rate that the file already holds.
    """
    key = h.find_key_column(raw.columns, "national")
    df = raw.withColumnRenamed(key, "code_commune")
    df = df.withColumn("code_commune", codes.commune_code("code_commune"))
    if ref is not None:
        df = s.semi_filter(df, ref, "code_commune", "code_insee")
    keys = ["code_commune"] + [c for c in (FILE_ORDER,) if c in df.columns]
    if layout == "by_year":
        out = h.wide_to_long(df, keys, default_year=year)
    else:
        found = {
            target: h.find_all_keywords(df.columns, *keywords)
            for target, keywords in h.INCOME_KEYWORDS_ALL.items()
        }
        out = df.select(
            *keys,
            F.lit(year).cast("smallint").alias("annee"),
            *[
                (decimal_comma(h.quoted(c)) if c else F.lit(None).cast("double")).alias(target)
                for target, c in found.items()
            ],
        )
    out = _first_of_year(out, list(h.INCOME_KEYWORDS_ALL))
    if layout == "snapshot":
        median = (
            F.lit(national_median)
            if national_median is not None
            else overall_median(out, "mediane_revenu_disp")
        )
        rate = poverty_rate("mediane_revenu_disp", "gini", median, digits)
        out = out.withColumn(
            "taux_pauvrete", F.coalesce("taux_pauvrete", rate) if prefer_source else rate
        )
    return h.enforce_schema(out, table_schema("revenus"))


def update_poverty(table: DataFrame, national_median: float = FIXED_NATIONAL_MEDIAN) -> DataFrame:
    """Recompute the rate of a stored income table; rows without income keep theirs."""
    rate = poverty_rate("mediane_revenu_disp", "gini", national_median)
    kind = table.schema["taux_pauvrete"].dataType
    return table.withColumn("taux_pauvrete", F.coalesce(rate.cast(kind), F.col("taux_pauvrete")))


def occupations(raw: DataFrame, ref: DataFrame | None = None, year: int = SNAPSHOT_YEAR) -> DataFrame:
    df = raw.withColumn("code_commune", codes.composite_code("DR", "CR"))
    return _statistics(df, ref, OCCUPATION_COLUMNS, "csp", year)


def diplomas(raw: DataFrame, ref: DataFrame | None = None, year: int = SNAPSHOT_YEAR) -> DataFrame:
    df = raw.withColumn("code_commune", codes.commune_code("CODGEO"))
    return _statistics(df, ref, DIPLOMA_COLUMNS, "diplomes", year)


def _statistics(df, ref, mapping, table, year) -> DataFrame:
    if ref is not None:
        df = s.semi_filter(df, ref, "code_commune", "code_insee")
    keys = ["code_commune"] + [c for c in (FILE_ORDER,) if c in df.columns]
    out = h.with_constants(h.map_columns(df, mapping, to_number, keep=keys), annee=year)
    return h.enforce_schema(_first_of_year(out, list(mapping.values())), table_schema(table))


def population_typology(
    raw: DataFrame,
    thresholds: tuple[float, float] | None = None,
    mode: str = "population",
    metropolitan: bool = True,
) -> DataFrame:
    """Population (sum of every age band present) and typology, of metropolitan
    municipalities unless told otherwise."""
    bands = h.columns_with_prefix(raw, POPULATION_PREFIX)
    df = raw.select(
        codes.commune_code("CODGEO").alias("code_commune"), *[to_number(h.quoted(c)).alias(c) for c in bands]
    )
    if metropolitan:
        df = df.where(s.is_metropolitan("code_commune"))
    return df.select("code_commune", sum_ignoring_nulls(*bands).alias("population_totale")).withColumn(
        "typologie_territoire", territory_type("population_totale", mode, thresholds)
    )

"""Silver tables to the gold feature table: one row per municipality and election year."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mairie.functions.codes import department_of
from mairie.functions.mappings import bloc_of
from mairie.functions.numbers import percentage, sum_ignoring_nulls
from mairie.operators import joins
from mairie.operators.aggregates import pivot_shares, with_dominant_bloc
from mairie.operators.harmonise import enforce_schema
from mairie.operators.imputation import impute_medians
from mairie.operators.selection import first_round_presidential
from mairie.plans.silver import OCCUPATIONS, SNAPSHOT_YEAR
from mairie.session import cut_lineage
from mairie.sources.schemas import table_schema

INCOME_FEATURES = ["mediane_revenu_disp", "gini", "taux_pauvrete"]
VITAL_FEATURES = ["nb_naissances", "nb_deces", "solde_naturel"]
OCCUPATION_FEATURES = ["cadres_pct", "ouvriers_pct", "employes_pct", "artisans_pct"]
DIPLOMA_FEATURES = ["pct_bac_plus", "pct_sans_diplome"]
IMPUTED = VITAL_FEATURES + INCOME_FEATURES + OCCUPATION_FEATURES + DIPLOMA_FEATURES


def votes_by_bloc(elections: DataFrame, scope: str = "national") -> DataFrame:
    """First-round presidential rows with their bloc."""
    return first_round_presidential(elections).select(
        "code_commune", "annee", bloc_of("nuance_liste", "nom_candidat", scope).alias("bloc"), "nb_voix"
    )


def election_results(elections: DataFrame, scope: str = "national") -> DataFrame:
    """Shares and dominant bloc per municipality and year: one shuffle of reduced rows."""
    return with_dominant_bloc(pivot_shares(votes_by_bloc(elections, scope)))


def occupation_shares(csp: DataFrame, year: int = SNAPSHOT_YEAR, digits: int | None = 3) -> DataFrame:
    total = sum_ignoring_nulls(*[f"{o}_emploi" for o in OCCUPATIONS])
    return csp.where(F.col("annee") == year).select(
        "code_commune",
        *[
            percentage(f.replace("_pct", "_emploi"), total, digits).alias(f)
            for f in OCCUPATION_FEATURES
        ],
    )


def diploma_shares(diplomas: DataFrame, year: int = SNAPSHOT_YEAR, digits: int | None = 3) -> DataFrame:
    higher = sum_ignoring_nulls("sup_bac2", "sup_bac34", "sup_bac5")
    none = sum_ignoring_nulls("sans_diplome")
    return diplomas.where(F.col("annee") == year).select(
        "code_commune",
        percentage(higher, "nscol15p", digits).alias("pct_bac_plus"),
        percentage(none, "nscol15p", digits).alias("pct_sans_diplome"),
    )


def join_sources(
    silver: Mapping[str, DataFrame],
    typology: DataFrame | None = None,
    scope: str = "national",
    snapshot_year: int = SNAPSHOT_YEAR,
) -> DataFrame:
    """Election results with every other source joined on, before imputation."""
    ref = silver["referentiel_communes"].select(F.col("code_insee").alias("code_commune"), "libelle", "code_dep")
    gold = joins.left_enrich(election_results(silver["elections"], scope), ref, "code_commune")
    vital = joins.natural_balance(silver["naissances"], silver["deces"])
    gold = joins.nearest_year_join(gold, vital, VITAL_FEATURES)
    gold = joins.nearest_year_join(gold, silver["revenus"], INCOME_FEATURES)
    gold = joins.left_enrich(gold, occupation_shares(silver["csp"], snapshot_year), "code_commune")
    gold = joins.left_enrich(gold, diploma_shares(silver["diplomes"], snapshot_year), "code_commune")
    if typology is None:
        return gold
    gold = joins.left_enrich(gold, typology.select("code_commune", "typologie_territoire"), "code_commune")
    return gold.fillna({"typologie_territoire": "rural"})


def department_fallback(df: DataFrame) -> DataFrame:
    """The code prefix replaces a department column that is null everywhere."""
    known = df.agg(F.count("code_dep")).scalar()
    return df.withColumn(
        "code_dep", F.when(known == 0, department_of("code_commune")).otherwise(F.col("code_dep"))
    )


def features_communes(
    silver: Mapping[str, DataFrame],
    typology: DataFrame | None = None,
    scope: str = "national",
    snapshot_year: int = SNAPSHOT_YEAR,
) -> DataFrame:
    """The typed gold table.

    The joined rows are written once to the shared folder, because the department
    check and both imputation levels read them again.
    """
    joined = cut_lineage(join_sources(silver, typology, scope, snapshot_year), "gold-joined")
    filled = impute_medians(department_fallback(joined), IMPUTED, "code_dep")
    return enforce_schema(filled, table_schema("features_communes"))

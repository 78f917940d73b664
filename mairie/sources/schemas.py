"""Column contracts of the silver and gold tables (fixed values)."""

from __future__ import annotations

from pyspark.sql import types as T

_DDL = {
    "referentiel_communes": """code_insee string, libelle string, code_dep string,
        code_reg string, statut string, arr string""",
    "elections": """code_commune string, id_election string, annee smallint,
        type_election string, tour smallint, nuance_liste string, nom_liste string,
        nom_candidat string, prenom_candidat string, sexe string, nb_voix int,
        pct_voix_ins decimal(6,3), pct_voix_exp decimal(6,3), inscrits int, votants int,
        exprimes int""",
    "naissances": "code_commune string, annee smallint, nb_naissances int",
    "deces": "code_commune string, annee smallint, nb_deces int",
    "revenus": """code_commune string, annee smallint, mediane_revenu_disp decimal(10,2),
        q1_revenu_disp decimal(10,2), q9_revenu_disp decimal(10,2), gini decimal(6,4),
        taux_pauvrete decimal(6,3), mediane_revenu_dec decimal(10,2)""",
    "csp": """code_commune string, annee smallint,
        agriculteurs_emploi decimal(12,4), artisans_emploi decimal(12,4),
        cadres_emploi decimal(12,4), prof_interm_emploi decimal(12,4),
        employes_emploi decimal(12,4), ouvriers_emploi decimal(12,4),
        agriculteurs_chomeurs decimal(12,4), artisans_chomeurs decimal(12,4),
        cadres_chomeurs decimal(12,4), prof_interm_chomeurs decimal(12,4),
        employes_chomeurs decimal(12,4), ouvriers_chomeurs decimal(12,4)""",
    "diplomes": """code_commune string, annee smallint, nscol15p decimal(12,4),
        sans_diplome decimal(12,4), bepc_brevet decimal(12,4), cap_bep decimal(12,4),
        bac decimal(12,4), sup_bac2 decimal(12,4), sup_bac34 decimal(12,4),
        sup_bac5 decimal(12,4)""",
    "features_communes": """code_commune string, libelle string, code_dep string,
        annee smallint, pct_gauche decimal(6,3), pct_centre decimal(6,3),
        pct_droite decimal(6,3), pct_extremedroite decimal(6,3), pct_divers decimal(6,3),
        bloc_dominant string, cadres_pct decimal(6,3), ouvriers_pct decimal(6,3),
        employes_pct decimal(6,3), artisans_pct decimal(6,3), pct_bac_plus decimal(6,3),
        pct_sans_diplome decimal(6,3), nb_naissances int, nb_deces int, solde_naturel int,
        mediane_revenu_disp decimal(10,2), gini decimal(6,4), taux_pauvrete decimal(6,3),
        typologie_territoire string""",
    "predictions": """code_commune string, libelle string, code_dep string, annee smallint,
        bloc_predit string, prob_gauche decimal(6,4), prob_centre decimal(6,4),
        prob_droite decimal(6,4), prob_extremedroite decimal(6,4), modele string,
        typologie_territoire string""",
}

KEYS = {
    "referentiel_communes": ["code_insee"],
    "naissances": ["code_commune", "annee"],
    "deces": ["code_commune", "annee"],
    "revenus": ["code_commune", "annee"],
    "csp": ["code_commune", "annee"],
    "diplomes": ["code_commune", "annee"],
    "features_communes": ["code_commune", "annee"],
    "predictions": ["code_commune", "annee"],
}
REQUIRED = {
    "referentiel_communes": ["code_insee", "libelle", "code_dep"],
    "elections": ["code_commune", "id_election", "annee"],
    "predictions": ["code_commune", "annee", "bloc_predit"],
}
LAYERS = {
    name: "gold" if name in ("features_communes", "predictions") else "silver" for name in _DDL
}
# Folder layout of the results table: questions read one type and few years.
PARTITIONS = {"elections": ["type_election", "annee"]}


def table_schema(name: str) -> T.StructType:
    return T.StructType.fromDDL(_DDL[name])

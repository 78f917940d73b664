"""JN and AGG queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from mairie.catalogue.adapters import BASE, EARLIER, FUTURE
from mairie.catalogue.registry import query
from mairie.catalogue.sql import FIVE, IMPUTED, LABELS4, MAIN, dec, mean, med, with_views
from mairie.functions import codes, mappings
from mairie.functions.poverty import poverty_level
from mairie.operators import aggregates as a
from mairie.operators import imputation, joins, medians, quality
from mairie.plans import gold

# ---- joins


@query("jn01_left_enrich", with_views("select code_commune, annee, bloc_dominant, libelle, code_dep from v_results left join v_ref using (code_commune)"))
def jn01(t):
    ref = t.referential().select(F.col("code_insee").alias("code_commune"), "libelle", "code_dep")
    df = joins.left_enrich(t.results(), ref, "code_commune")
    return df.select("code_commune", "annee", "bloc_dominant", "libelle", "code_dep")


@query(
    "jn02_group_total",
    with_views(
        """select code_commune, annee, bloc, v.voix nb_voix, total from
        (select code_commune, annee, bloc, cast(sum(voix) as bigint) voix from v_votes group by 1, 2, 3) v
        join (select code_commune, annee, cast(sum(voix) as bigint) total from v_votes group by 1, 2) using (code_commune, annee)"""
    ),
)
def jn02(t):
    grouped = a.group_sum(t.votes(), ["code_commune", "annee", "bloc"], "nb_voix")
    return joins.with_group_total(grouped, ["code_commune", "annee"], "nb_voix", "total")


@query("jn03_full_outer", with_views("select code_commune, annee, nb_naissances, nb_deces, solde_naturel from v_vital"))
def jn03(t):
    return joins.natural_balance(t.births(), t.deaths())


@query(
    "jn04_nearest_year",
    with_views(
        """select r.code_commune, r.annee, nb_naissances, nb_deces, solde_naturel from v_results r join v_near n using (annee)
        left join v_vital v on v.code_commune = r.code_commune and v.annee = n.fy"""
    ),
)
def jn04(t):
    vital = joins.natural_balance(t.births(), t.deaths())
    df = t.results().select("code_commune", "annee")
    return joins.nearest_year_join(df, vital, gold.VITAL_FEATURES)


@query(
    "jn05_paired_years",
    with_views(
        """select a.code_commune, a.bloc_predit bloc_predit_2004, b.bloc_predit bloc_predit_2006
        from v_pred a join v_pred b on a.code_commune = b.code_commune where a.annee = 2004 and b.annee = 2006"""
    ),
)
def jn05(t):
    return joins.paired_years(t.predictions(), FUTURE[0], FUTURE[-1], ["bloc_predit"])


@query(
    "jn06_actual_with_predicted",
    with_views(
        """select f.code_commune, f.bloc_dominant, p.bloc_predit, p.prob_extremedroite from v_gold f
        join v_pred p on p.code_commune = f.code_commune where f.annee = 2001 and p.annee = 2006"""
    ),
)
def jn06(t):
    df = joins.actual_with_predicted(t.gold(), t.predictions(), BASE, FUTURE[-1])
    return df.select("code_commune", "bloc_dominant", "bloc_predit", "prob_extremedroite")


@query("jn07_difference_with_default", with_views("select distinct code_commune, " + ", ".join(f"d_{b} pct_{b}_trend" for b in MAIN) + " from v_scen"))
def jn07(t):
    g = t.gold()
    columns = [f"pct_{b}" for b in MAIN]
    df = joins.difference_to(g.where(F.col("annee") == BASE), g.where(F.col("annee") == EARLIER), columns)
    return df.select("code_commune", *[f"{c}_trend" for c in columns])


@query("jn08_literal_years", with_views("select code_commune, cast(y as smallint) cible from v_gold, v_future where annee = 2001"))
def jn08(t):
    base = t.gold().where(F.col("annee") == BASE).select("code_commune")
    return joins.for_each_year(base, FUTURE, "cible")


@query(
    "jn09_dictionary_join",
    with_views(
        """select annee, bloc, count(*) n, cast(sum(voix) as bigint) voix from (
        select cast(substring(id_election, 1, 4) as smallint) annee, voix,
        coalesce(case nuance when 'SOC' then 'Gauche' when 'REM' then 'Centre' when 'LR' then 'Droite' when 'RN' then 'ExtremeDroite' end, 'Divers') bloc
        from v_elections) group by 1, 2"""
    ),
)
def jn09(t):
    table = mappings.dictionary(t.spark, mappings.nuance_table(), "nuance", "bloc")
    df = joins.dictionary_join(t.elections(), table, "nuance_liste", "nuance", "bloc", "bloc", "Divers")
    return df.groupBy("annee", "bloc").agg(F.count(F.lit(1)).alias("n"), F.sum("nb_voix").alias("voix"))


_RULES = "case " + " ".join(
    f"when contains(x, upper('{k}')) or contains(upper('{k}'), x) then '{b}'" for k, b in mappings.CANDIDATES
) + " end"


@query("jn10_contains_map", with_views(f"select x, {_RULES} bloc, count(*) n from (select upper(trim('Mr ' || coalesce(nom, nuance))) x from v_elections) group by 1, 2"))
def jn10(t):
    label = F.concat(F.lit("Mr "), F.coalesce("nom", "nuance"))
    names = t.bronze_elections().select(codes.upper_trim(label).alias("x"))
    return joins.contains_map(names, "x", "bloc").groupBy("x", "bloc").agg(F.count(F.lit(1)).alias("n"))


# ---- aggregates


@query("agg01_group_sum", with_views("select code_commune, annee, bloc, cast(sum(voix) as bigint) nb_voix from v_votes group by 1, 2, 3"))
def agg01(t):
    return a.group_sum(t.votes(), ["code_commune", "annee", "bloc"], "nb_voix")


@query(
    "agg02_share_of_group",
    with_views(
        """select code_commune, annee, bloc, v nb_voix, cast(v as double) * 100 / tot pct
        from (select code_commune, annee, bloc, cast(sum(voix) as bigint) v from v_votes group by 1, 2, 3) join v_sums using (code_commune, annee) where tot > 0"""
    ),
)
def agg02(t):
    return a.bloc_shares(t.votes())


@query("agg03_pivot_shares", with_views("select code_commune, annee, " + ", ".join(f"pct_{b}" for b in FIVE) + " from v_results"))
def agg03(t):
    return a.pivot_shares(t.votes())


@query("agg04_count_by", with_views("select annee, bloc_dominant, count(*) n from v_results group by 1, 2"))
def agg04(t):
    return a.count_by(t.results(), ["annee", "bloc_dominant"])


@query("agg05_averages", with_views("select annee, " + ", ".join(f"{mean(f'pct_{b}')} moy_pct_{b}" for b in FIVE) + " from v_gold group by 1"))
def agg05(t):
    return a.averages(t.gold(), [f"pct_{b}" for b in FIVE], ["annee"])


@query(
    "agg06_median_and_average",
    with_views(
        f"""select bloc_dominant, {med('cast(mediane_revenu_disp as double)')} med_mediane_revenu_disp,
        {mean('taux_pauvrete')} moy_taux_pauvrete from v_gold group by 1"""
    ),
)
def agg06(t):
    return a.median_and_average(t.gold(), "mediane_revenu_disp", "taux_pauvrete", ["bloc_dominant"])


@query("agg07_overall_average", with_views("select " + ", ".join(f"{mean(f'prob_{b}')} moy_prob_{b}" for b in MAIN) + " from v_pred"))
def agg07(t):
    return a.averages(t.predictions(), [f"prob_{b}" for b in MAIN])


@query("agg08_overall_median", f"select {med('c_acctbal')} c_acctbal, {med('cast(c_nationkey as double)')} c_nationkey from customer")
def agg08(t):
    return medians.medians(t.read("customer"), ["c_acctbal", "c_nationkey"])


@query(
    "agg09_spread_group_median",
    with_views(
        f"""select j.code_commune, j.annee, m.solde_naturel_median, m.gini_median from v_joined j left join (
        select code_dep, {med('cast(solde_naturel as double)')} solde_naturel_median, {med('cast(gini as double)')} gini_median
        from v_joined where code_dep is not null group by 1) m using (code_dep)"""
    ),
)
def agg09(t):
    df = imputation.spread_group_median(t.joined(), ["solde_naturel", "gini"], "code_dep")
    return df.select("code_commune", "annee", "solde_naturel_median", "gini_median")


@query("agg10_impute_medians", with_views("select code_commune, annee, " + ", ".join(IMPUTED) + " from v_gold2"))
def agg10(t):
    df = imputation.impute_medians(t.unfilled(), IMPUTED)
    return df.select("code_commune", "annee", *IMPUTED)


@query(
    "agg11_validation_row",
    with_views(
        """select 'resultats' table_name, count(*) n, cast(min(annee) as bigint) annee_min, cast(max(annee) as bigint) annee_max, count(distinct code_commune) cles from v_votes
        union all select 'naissances', count(*), cast(min(annee) as bigint), cast(max(annee) as bigint), count(distinct code_commune) from v_births"""
    ),
)
def agg11(t):
    return quality.validation_row(t.votes(), "resultats", "annee", "code_commune").unionByName(
        quality.validation_row(t.births(), "naissances", "annee", "code_commune")
    )


@query(
    "agg12_coverage_row",
    with_views(
        f"""select count(*) total, count(taux_pauvrete) non_null,
        cast(round({dec(mean('taux_pauvrete'), 20, 8)}, 2) as decimal(15,2)) moyenne,
        cast(min(taux_pauvrete) as decimal(15,2)) min_val, cast(max(taux_pauvrete) as decimal(15,2)) max_val from v_income"""
    ),
)
def agg12(t):
    return quality.coverage_row(t.income(), "taux_pauvrete")


@query("agg13_conditional_count", with_views("select cast(sum(case when mediane is not null then 1 else 0 end) as bigint) n from v_income_raw"))
def agg13(t):
    return quality.count_non_null(t.income(), "mediane_revenu_disp")


def _rates(columns, source, digits=1):
    return " union all ".join(
        f"select '{c}' colonne, cast(round({dec(f'cast(count({c}) as double) * 100 / count(*)', 12, 8)}, {digits}) as decimal(6,1)) taux from {source}"
        for c in columns
    )


_JOINED = ["code_commune", "annee", "nb_naissances", "mediane_revenu_disp", "gini", "taux_pauvrete"]


@query("agg14_fill_rates", with_views(_rates(_JOINED, "v_joined")))
def agg14(t):
    return quality.fill_rates(t.joined().select(*_JOINED)).withColumn("taux", F.col("taux").cast("decimal(6,1)"))


@query(
    "agg15_missing_values",
    with_views(
        "select * from ("
        + " union all ".join(
            f"select '{c}' colonne, count(*) - count({c}) manquants, cast(count(*) - count({c}) as double) / count(*) * 100 pourcentage from v_joined"
            for c in _JOINED
        )
        + ") where manquants > 0"
    ),
)
def agg15(t):
    return quality.missing_values(t.joined().select(*_JOINED))


_EVENT_TYPES = ["bigint", "timestamp_ntz", "bigint", "string", "double", "string"]
_EVENT_COLUMNS = ["event_id", "ts", "user_id", "event_type", "value", "props"]


@query(
    "agg16_dataset_profile",
    "select 'events' jeu, lignes, cast(6 as int) nb_colonnes, cast(position as int) position, colonne, type from (select count(*) lignes from events), (values "
    + ", ".join(f"({i}, '{c}', '{k}')" for i, (c, k) in enumerate(zip(_EVENT_COLUMNS, _EVENT_TYPES)))
    + ") v(position, colonne, type)",
)
def agg16(t):
    return quality.dataset_profile(t.read("events"), "events")


@query("agg17_value_counts", "select event_type, count(*) n from events where event_type is not null group by 1")
def agg17(t):
    return quality.value_counts(t.read("events"), "event_type")


@query("agg18_distinct_count", "select count(distinct user_id) n from events")
def agg18(t):
    return quality.distinct_count(t.read("events"), "user_id")


@query("agg19_crosstab", with_views("select annee, " + ", ".join(f"count(case when bloc_dominant = '{b}' then 1 end) \"{b}\"" for b in LABELS4) + " from v_results group by 1"))
def agg19(t):
    return a.crosstab(t.results(), "annee", "bloc_dominant", mappings.MAIN_BLOCS)


_YEARLY = {"moy_gauche": "pct_gauche", "moy_centre": "pct_centre", "moy_droite": "pct_droite", "moy_xd": "pct_extremedroite", "moy_cadres_pct": "cadres_pct", "moy_bac_plus": "pct_bac_plus"}


@query(
    "agg20_yearly_averages",
    with_views("select annee, count(*) nb_communes, " + ", ".join(f"cast(round({dec(mean(c), 28, 10)}, 1) as decimal(20,1)) {n}" for n, c in _YEARLY.items()) + " from v_gold group by 1"),
)
def agg20(t):
    df = a.yearly_averages(t.gold(), _YEARLY)
    return df.select("annee", "nb_communes", *[F.col(c).cast("decimal(20,1)").alias(c) for c in _YEARLY])


@query("agg21_distinct_by", with_views("select typologie_territoire, count(distinct code_commune) nb_communes from v_gold group by 1"))
def agg21(t):
    return a.distinct_by(t.gold(), "typologie_territoire", "code_commune", "nb_communes")


@query(
    "agg22_distribution_within",
    with_views("select annee, bloc_predit, n, cast(n as double) * 100 / cast(sum(n) over (partition by annee) as double) pct from (select annee, bloc_predit, count(*) n from v_pred group by 1, 2)"),
)
def agg22(t):
    return a.distribution_within(t.predictions(), "annee", "bloc_predit")


@query(
    "agg23_summary",
    with_views(f"select {mean('taux_pauvrete')} moyenne, {med('cast(taux_pauvrete as double)')} mediane, min(taux_pauvrete) min_val, max(taux_pauvrete) max_val from v_income"),
)
def agg23(t):
    return a.summary(t.income(), "taux_pauvrete")


@query("agg24_votes_per_bloc", with_views("select bloc, cast(sum(voix) as bigint) nb_voix from v_votes group by 1"))
def agg24(t):
    return a.group_sum(t.votes(), ["bloc"], "nb_voix").orderBy(F.desc("nb_voix"), "bloc")


_INDICATORS = ["cadres_pct", "pct_sans_diplome", "mediane_revenu_disp", "taux_pauvrete", "solde_naturel"]
_RESULTS = [f"pct_{b}" for b in FIVE]


@query(
    "agg25_correlations",
    with_views(
        " union all ".join(
            f"select '{i}' indicateur, '{r}' resultat, cast(round({dec(f'corr(cast({i} as double), cast({r} as double))', 20, 12)}, 6) as decimal(15,6)) r from v_gold"
            for i in _INDICATORS
            for r in _RESULTS
        )
    ),
)
def agg25(t):
    df = a.correlations(t.gold(), _INDICATORS, _RESULTS, digits=6)
    return df.withColumn("r", F.col("r").cast("decimal(15,6)"))


@query("agg26_level_counts", with_views("select case when mediane is null then 3 when gini is not null then 1 else 2 end niveau, count(*) n from v_income_raw group by 1"))
def agg26(t):
    return a.level_counts(t.income().withColumn("niveau", poverty_level("mediane_revenu_disp", "gini")), "niveau")


@query("agg27_sorted_values", with_views("select distinct annee from v_votes"))
def agg27(t):
    return quality.sorted_values(t.votes(), "annee")

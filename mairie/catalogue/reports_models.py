"""Report questions and ML queries."""

from __future__ import annotations

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Window
from pyspark.sql import functions as F

from mairie.catalogue.adapters import BASE, Tables
from mairie.catalogue.registry import query
from mairie.catalogue.sql import MAIN, dec, mean, med, with_views
from mairie.functions.numbers import exact_mean
from mairie.operators.medians import medians
from mairie.operators.selection import temporal_split
from mairie.plans import modelling as m
from mairie.plans.questions import question

# ---- questions; 2001 stands for the last election, 2004 and 2006 for the first and last forecast

_NOW = "from v_gold where annee = 2001"
_THEN = "from v_pred where annee = 2006"


def _means(*columns):
    return ", ".join(f"{mean(c)} moy_{c}" for c in columns)


_TOP = "select code_dep, count(*) n {source} and {bloc} = '{name}' group by 1 order by n desc, code_dep limit {k}"
QUESTIONS = {
    "q01": "select annee, " + _means(*[f"pct_{b}" for b in MAIN]) + " from v_gold group by 1",
    "q02": "select annee, bloc_dominant, count(*) n from v_gold group by 1, 2",
    "q03a": f"select bloc_dominant, count(*) n {_NOW} group by 1",
    "q03b": f"select code_commune, libelle, code_dep, bloc_dominant {_NOW}",
    "q04": f"select bloc_dominant, {_means('cadres_pct', 'ouvriers_pct', 'employes_pct', 'artisans_pct')} {_NOW} group by 1",
    "q05": f"select bloc_dominant, {_means('pct_bac_plus', 'pct_sans_diplome')} {_NOW} group by 1",
    "q06": f"select bloc_dominant, {med('cast(mediane_revenu_disp as double)')} med_mediane_revenu_disp, {_means('taux_pauvrete')} {_NOW} group by 1",
    "q07": f"select typologie_territoire, bloc_dominant, count(*) n {_NOW} group by 1, 2",
    "q08": f"select typologie_territoire, {_means('pct_bac_plus', 'cadres_pct', 'mediane_revenu_disp')} {_NOW} group by 1",
    "q09": _TOP.format(source=_NOW, bloc="bloc_dominant", name="Gauche", k=10),
    "q10": _TOP.format(source=_NOW, bloc="bloc_dominant", name="ExtremeDroite", k=10),
    "q11": "select annee, bloc_predit, count(*) n from v_pred group by 1, 2",
    "q12a": f"select bloc_predit, typologie_territoire, count(*) n {_THEN} group by 1, 2",
    "q12b": f"select code_commune, libelle, code_dep, bloc_predit, typologie_territoire {_THEN}",
    "q13": f"select {_means(*[f'prob_{b}' for b in MAIN])} {_THEN}",
    "q14": f"select typologie_territoire, bloc_predit, count(*) n {_THEN} group by 1, 2",
    "q15": f"select typologie_territoire, {_means('prob_extremedroite')} {_THEN} group by 1",
    "q16": _TOP.format(source=_THEN, bloc="bloc_predit", name="ExtremeDroite", k=20),
    "q17": """select a.code_dep, count(*) nb_bascules from v_pred a join v_pred b on a.code_commune = b.code_commune
        where a.annee = 2004 and a.bloc_predit = 'ExtremeDroite' and b.annee = 2006 and b.bloc_predit = 'Centre'
        group by 1 order by nb_bascules desc, a.code_dep limit 10""",
    "q18": f"""select 'Reel 2001' source, code_dep, bloc_dominant bloc, count(*) nb {_NOW} and code_dep in ('01', '03', '05', '07', '09') group by 2, 3
        union all select 'Predit 2006', code_dep, bloc_predit, count(*) {_THEN} and code_dep in ('01', '03', '05', '07', '09') group by 2, 3""",
    "q19": f"""select bloc_predit, n nb_communes, cast(round({dec('cast(n as double) * 100 / cast(sum(n) over () as double)', 28, 10)}, 1) as decimal(20,1)) pct
        from (select p.bloc_predit, count(*) n from v_gold f join v_pred p on f.code_commune = p.code_commune
        where f.annee = 2001 and f.bloc_dominant = 'ExtremeDroite' and p.annee = 2006 group by 1)""",
    "q20": f"""select f.typologie_territoire, f.bloc_dominant bloc_2022, p.bloc_predit bloc_2027, count(*) nb_communes,
        cast(round({dec(mean('p.prob_extremedroite'), 28, 10)}, 3) as decimal(22,3)) prob_xd_moy
        from v_gold f join v_pred p on f.code_commune = p.code_commune where f.annee = 2001 and p.annee = 2006
        and f.typologie_territoire = 'rural' and f.bloc_dominant = 'Gauche' group by 1, 2, 3""",
}
_TITLES = {
    "q01": "bloc_shares_over_time", "q02": "dominant_bloc_by_year", "q03a": "dominant_bloc_counts",
    "q03b": "commune_list", "q04": "occupations_by_bloc", "q05": "diplomas_by_bloc", "q06": "income_by_bloc",
    "q07": "typology_by_bloc", "q08": "profile_by_typology", "q09": "top_departments_gauche",
    "q10": "top_departments_extremedroite", "q11": "predicted_blocs", "q12a": "predicted_counts",
    "q12b": "predicted_commune_list", "q13": "mean_probabilities", "q14": "predicted_typology",
    "q15": "probability_by_typology", "q16": "top_predicted_departments", "q17": "switching_departments",
    "q18": "actual_and_predicted", "q19": "fate_of_communes", "q20": "rural_probability",
}


def _ask(name):
    def run(t: Tables):
        return getattr(t.report(), name)()

    return run


for _q, _sql in QUESTIONS.items():
    query(f"{_q}_{_TITLES[_q]}", with_views(_sql))(_ask(_q))


@query(
    "q00_generic_question",
    with_views(f"select code_dep, count(*) n, {mean('pct_gauche')} moyenne, {med('cast(gini as double)')} mediane {_NOW} and bloc_dominant = 'Gauche' group by 1 order by n desc, code_dep limit 5"),
)
def q00(t):
    return question(
        t.gold(),
        {"n": F.count(F.lit(1)), "moyenne": exact_mean("pct_gauche"), "mediane": F.median(F.col("gini").cast("double"))},
        by=["code_dep"], where={"annee": BASE, "bloc_dominant": "Gauche"}, order=[F.desc("n"), "code_dep"], limit=5,
    )


@query("q00_raw_sql", with_views("select code_dep, count(*) nb from v_gold where annee = 2001 group by 1 having count(*) > 1"))
def q00_sql(t):
    return t.spark.sql(
        "select code_dep, count(*) nb from {gold} where annee = 2001 group by 1 having count(*) > 1", gold=t.gold()
    )


# ---- models

TRAIN_END = 1999


def split(t: Tables):
    return temporal_split(t.model_rows(), TRAIN_END, BASE)


_TRAIN = "from v_rows where bloc_lag1 is not null and annee <= 1999"
_TEST = "from v_rows where bloc_lag1 is not null and annee = 2001"
_TYPO = "case typologie_territoire when 'urbain' then 2 when 'periurbain' then 1 else 0 end"


def _feature_sql(alias=""):
    parts = []
    for f in m.FEATURES:
        if f.endswith("_trend"):
            b = f[: -len("_trend")]
            parts.append((f, f"cast({b} - {b}_lag1 as double)"))
        elif f == "typo_ord":
            parts.append((f, f"cast({_TYPO} as double)"))
        else:
            parts.append((f, f"cast({f} as double)"))
    return parts


@query("ml01_feature_vector", with_views("select code_commune, annee, " + ", ".join(f"{e} f{i:02d}" for i, (_, e) in enumerate(_feature_sql())) + f" {_TRAIN}"))
def ml01(t):
    train, _ = split(t)
    rows = train.withColumns({c: F.col(c).cast("double") for c in m.FEATURES if c != "annee"})
    vectors = VectorAssembler(inputCols=m.FEATURES, outputCol="features").transform(rows)
    values = vectors.select("code_commune", "annee", vector_to_array("features").alias("v"))
    return values.select("code_commune", "annee", *[F.col("v")[i].alias(f"f{i:02d}") for i in range(len(m.FEATURES))])


@query("ml02_train_medians", with_views("select " + ", ".join(f"{med(e)} {n}" for n, e in _feature_sql()) + f" {_TRAIN}"))
def ml02(t):
    return medians(split(t)[0], m.FEATURES)


@query("ml03_label_index", with_views("select bloc_dominant, case bloc_dominant when 'Centre' then 0.0::double when 'Droite' then 2.0::double when 'ExtremeDroite' then 3.0::double else 4.0::double end label, count(*) n from v_gold group by 1, 2"))
def ml03(t):
    df = m.label_indexer().transform(t.gold())
    return df.groupBy("bloc_dominant", "label").agg(F.count(F.lit(1)).alias("n"))


@query(
    "ml04_class_weights",
    with_views(
        f"""select bloc_dominant, n, cast(sum(n) over () as double) / (count(*) over () * n) poids
        from (select bloc_dominant, count(*) n {_TRAIN} group by 1)"""
    ),
)
def ml04(t):
    weighted = m.class_weights(split(t)[0])
    return weighted.groupBy("bloc_dominant", "poids").agg(F.count(F.lit(1)).alias("n"))


def forest(t: Tables):
    return _model(t, "forest", m.train_forest)


def boosting(t: Tables):
    return _model(t, "boosting", m.train_boosting)


_models: dict = {}


def _model(t: Tables, name: str, train):
    """A model is trained once per session and folder, like the stored tables."""
    key = (t.spark.sparkContext.applicationId, t.folder, name)
    if key not in _models:
        _models[key] = train(split(t)[0])
    return _models[key]


_PROBABILITIES = [f"prob_{b}" for b in MAIN]


def _facts(predicted, labels):
    """What must hold for every prediction: shares add up to one and the label is the largest share's."""
    shares = F.array(*[F.col(f"prob_{x.lower()}") for x in labels])
    chosen = F.get(shares, F.array_position(F.array(*[F.lit(x) for x in labels]), F.col("bloc_predit")).cast("int") - 1)
    total = F.aggregate(shares, F.lit(0.0), lambda acc, x: acc + x)
    return predicted.select(
        "code_commune", "bloc_dominant", F.bround(total, 9).alias("somme"),
        (F.forall(shares, lambda x: x.between(0, 1)) & (chosen == F.array_max(shares))).alias("plus_grande"),
    )


_FACTS = with_views(f"select code_commune, bloc_dominant, 1.0::double somme, true plus_grande {_TEST}")


@query("ml05_random_forest", _FACTS)
def ml05(t):
    return _facts(forest(t).predict(split(t)[1]), forest(t).labels)


@query("ml06_gradient_boosting", _FACTS)
def ml06(t):
    return _facts(boosting(t).predict(split(t)[1]), boosting(t).labels)


@query("ml07_accuracy", with_views(f"select count(*) n, cast(count(case when bloc_dominant = bloc_lag1 then 1 end) as double) / count(*) accuracy {_TEST}"))
def ml07(t):
    return m.accuracy(m.previous_bloc(split(t)[1]))


_CLASSES = f"""select classe, coalesce(cast(sum(tp) as double), 0) tp, cast(sum(s) as bigint) support, cast(sum(p) as bigint) predits from (
    select bloc_dominant classe, case when bloc_dominant = bloc_lag1 then 1 else 0 end tp, 1 s, 0 p {_TEST}
    union all select bloc_lag1, 0, 0, 1 {_TEST}) group by 1"""
_SCORES = f"""select classe, p "precision", r recall, case when p + r > 0 then 2 * p * r / (p + r) else 0 end f1, support from (
    select classe, case when predits > 0 then tp / predits else 0 end p, case when support > 0 then tp / support else 0 end r, support from ({_CLASSES}))"""


def _average(weight, total):
    return ", ".join(
        f"list_reduce(list_prepend(0.0::double, list({c}{weight} order by classe)), lambda a, b: a + b) / {total} {n}"
        for c, n in (('"precision"', '"precision"'), ("recall", "recall"), ("f1", "f1"))
    )


@query(
    "ml08_classification_report",
    with_views(
        f"""select * from ({_SCORES}) union all
        select 'macro avg', {_average('', 'count(*)')}, cast(sum(support) as bigint) from ({_SCORES}) union all
        select 'weighted avg', {_average(' * support', 'sum(support)')}, cast(sum(support) as bigint) from ({_SCORES})"""
    ),
)
def ml08(t):
    return m.classification_report(m.previous_bloc(split(t)[1]))


_PRESENT = ", ".join(f"count({e}) {n}" for n, e in _feature_sql())


@query(
    "ml09_feature_importances",
    with_views(
        f"""select row_number() over (order by variable) numero, variable, true valide, 1.0::double somme
        from (unpivot (select {_PRESENT} {_TRAIN}) on columns(*) into name variable value n) where n > 0"""
    ),
)
def ml09(t):
    """Every variable with a value has an importance between 0 and 1, and all add up to one."""
    listed = m.importances(forest(t), t.spark, None)
    total = listed.agg(F.bround(F.sum("importance"), 9)).scalar()
    numbered = Window.orderBy("variable")  # as many rows as variables
    return listed.select(
        F.row_number().over(numbered).cast("bigint").alias("numero"), "variable",
        F.col("importance").between(0, 1).alias("valide"), total.alias("somme"),
    )


@query("ml10_model_choice", with_views(f"select count(*) n, true regle {_TEST}"))
def ml10(t):
    """The chosen model has the higher accuracy on the last election, the forest where both are equal."""
    test = split(t)[1]
    first, second = forest(t), boosting(t)
    a, b = (m.accuracy_value(x.predict(test)) for x in (first, second))
    best = m.choose_model(first, a, second, b)
    right = F.lit(best.name == ("RandomForest" if a >= b else "GradientBoosting"))
    return m.accuracy(best.predict(test)).select("n", (right & (F.col("accuracy") == max(a, b))).alias("regle"))


_SCENARIO = (
    "select code_commune, cast(y as smallint) annee, "
    + ", ".join(f"pct_{b}_lag1, d_{b}*f pct_{b}_trend" for b in MAIN)
    + ", "
    + ", ".join(f"{c} + d_{c}*f {c}" for c in m.VITAL)
    + " from v_scen"
)


@query("ml11_scenario_rows", with_views(_SCENARIO))
def ml11(t):
    columns = [c for b in MAIN for c in (f"pct_{b}_lag1", f"pct_{b}_trend")]
    return t.scenarios().select("code_commune", "annee", *columns, *m.VITAL)


def _shares():
    """The shares of a prediction table; a class the model never saw has none."""
    return F.array_compact(F.array(*[F.col(p).cast("double") for p in _PROBABILITIES]))


@query("ml12_scoring", with_views("select code_commune, cast(y as smallint) annee, 'RandomForest' modele, true valide from v_scen"))
def ml12(t):
    """Each scenario row once, with rounded shares that add up to one and the largest share's label."""
    chosen = F.coalesce(*[F.when(F.lower("bloc_predit") == p.removeprefix("prob_"), F.col(p).cast("double")) for p in _PROBABILITIES])
    total = F.aggregate(_shares(), F.lit(0.0), lambda acc, x: acc + x)
    valid = total.between(0.99, 1.01) & (chosen >= F.array_max(_shares()) - 0.001)
    return m.score(forest(t), t.scenarios()).select("code_commune", "annee", "modele", valid.alias("valide"))


@query(
    "ml13_class_aligned_probabilities",
    with_views("select cast(y as smallint) annee, count(*) n, 'GradientBoosting' modele, true valide from v_scen group by 1"),
)
def ml13(t):
    """The boosted model's probabilities by label: means per year over all rows add up to one."""
    scored = m.score(boosting(t), t.scenarios())
    means = scored.groupBy("annee", "modele").agg(F.count(F.lit(1)).alias("n"), *[exact_mean(p).alias(p) for p in _PROBABILITIES])
    total = F.aggregate(_shares(), F.lit(0.0), lambda acc, x: acc + x)
    return means.select("annee", "n", "modele", total.between(0.99, 1.01).alias("valide"))


@query(
    "ml14_one_hot_typology",
    with_views("select typologie_territoire, case typologie_territoire when 'rural' then 1.0::double else 0.0::double end rural, case typologie_territoire when 'urbain' then 1.0::double else 0.0::double end urbain, count(*) n from v_gold group by 1, 2, 3"),
)
def ml14(t):
    v = vector_to_array("typo_vec")
    coded = m.territory_one_hot(t.gold()).select("typologie_territoire", v[0].alias("rural"), v[1].alias("urbain"))
    return coded.groupBy("typologie_territoire", "rural", "urbain").agg(F.count(F.lit(1)).alias("n"))


@query("ml15_accuracy_by_typology", with_views(f"select typologie_territoire, count(*) n, cast(count(case when bloc_dominant = bloc_lag1 then 1 end) as double) / count(*) accuracy {_TEST} group by 1"))
def ml15(t):
    return m.accuracy(m.previous_bloc(split(t)[1]), by=["typologie_territoire"])


@query("ml16_confusion_matrix", with_views("select bloc_dominant, " + ", ".join(f"count(case when bloc_lag1 = '{b}' then 1 end) \"{b}\"" for b in m.LABELS) + f" {_TEST} group by 1"))
def ml16(t):
    return m.confusion_matrix(m.previous_bloc(split(t)[1]))

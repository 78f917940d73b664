import random

import pytest
from pyspark.sql import functions as F

from mairie.operators.selection import temporal_split
from mairie.plans import modelling as m


@pytest.fixture(scope="module")
def training(spark):
    rng = random.Random(3)
    data = []
    for i in range(240):
        bloc = ["Gauche", "Centre", "ExtremeDroite"][i % 3 if i % 4 else 0]
        x = {"Gauche": 0.0, "Centre": 5.0, "ExtremeDroite": 10.0}[bloc] + rng.random()
        data.append((f"{i:05d}", x, None if i % 7 == 0 else x * 2, None, bloc))
    return spark.createDataFrame(data, "code_commune string, a double, b double, vide double, bloc_dominant string").cache()


def test_feature_lists():
    assert len(m.feature_names()) == 22 and len(m.feature_names("pilot")) == 18
    assert len(m.feature_names(leak_free=True)) == 18
    assert not set(m.feature_names(leak_free=True)) & set(m.TRENDS)


def test_class_weights(training):
    weighted = m.class_weights(training)
    counts = {r[0]: r[1] for r in training.groupBy("bloc_dominant").count().collect()}
    for r in weighted.select("bloc_dominant", "poids").distinct().collect():
        assert r["poids"] == pytest.approx(240 / (3 * counts[r["bloc_dominant"]]))
    assert weighted.agg(F.sum("poids")).first()[0] == pytest.approx(240)


@pytest.mark.parametrize("kind", ["forest", "boosting"])
def test_models(training, kind):
    if kind == "forest":
        model = m.train_forest(training, ["a", "b", "vide"], numTrees=10)
    else:
        model = m.train_boosting(training, ["a", "b", "vide"], maxIter=5)
    assert model.features == ["a", "b"] and model.labels == ["Centre", "ExtremeDroite", "Gauche"]
    predicted = model.predict(training)
    assert m.accuracy_value(predicted) > 0.95
    names = [f"prob_{x.lower()}" for x in model.labels]
    for r in predicted.collect():
        p = {n: r[n] for n in names}
        assert sum(p.values()) == pytest.approx(1.0)
        assert max(p, key=p.get) == f"prob_{r['bloc_predit'].lower()}"


def test_scores_have_null_for_an_unseen_class(training):
    model = m.train_forest(training, ["a", "b"], numTrees=5)
    inputs = training.withColumns({"libelle": F.lit("x"), "code_dep": F.lit("01"), "annee": F.lit(2027), "typologie_territoire": F.lit("rural")})
    scored = m.score(model, inputs)
    assert scored.where("prob_droite is not null").count() == 0
    assert scored.where("prob_gauche is null or modele <> 'RandomForest'").count() == 0
    assert scored.columns[:5] == ["code_commune", "libelle", "code_dep", "annee", "bloc_predit"]


def test_importances_and_choice(spark, training):
    model = m.train_forest(training, ["a", "b"], numTrees=5)
    top = m.importances(model, spark, 1).collect()
    assert len(top) == 1 and top[0]["rang"] == 1
    assert sum(v for _, v in model.importances) == pytest.approx(1.0)
    other = m.Trained("GradientBoosting", None, [], {}, [])
    assert m.choose_model(model, 0.5, other, 0.5) is model
    assert m.choose_model(model, 0.5, other, 0.6) is other


def test_report_and_confusion(spark, rows):
    data = [("Gauche", "Gauche")] * 3 + [("Gauche", "Centre")] + [("Centre", "Droite")] * 2
    df = spark.createDataFrame(data, "bloc_dominant string, bloc_predit string")
    got = {r["classe"]: r for r in m.classification_report(df).collect()}
    assert (got["Gauche"]["precision"], got["Gauche"]["recall"], got["Gauche"]["support"]) == (1.0, 0.75, 4)
    assert (got["Centre"]["precision"], got["Centre"]["recall"], got["Centre"]["f1"]) == (0.0, 0.0, 0.0)
    assert (got["Droite"]["recall"], got["Droite"]["support"]) == (0.0, 0)
    assert got["macro avg"]["precision"] == pytest.approx(1 / 3)
    assert got["weighted avg"]["recall"] == pytest.approx(0.5) and got["weighted avg"]["support"] == 6
    matrix = {r["bloc_dominant"]: r for r in m.confusion_matrix(df).collect()}
    assert (matrix["Gauche"]["Centre"], matrix["Centre"]["Droite"], matrix["Centre"]["Centre"]) == (1, 2, 0)
    assert rows(m.accuracy(df)) == [(6, 0.5)]


def test_one_hot(spark):
    from pyspark.ml.functions import vector_to_array

    df = spark.createDataFrame([("periurbain",), ("rural",), ("urbain",), ("autre",)], "typologie_territoire string")
    got = {r[0]: list(r[1]) for r in m.territory_one_hot(df).select("typologie_territoire", vector_to_array("typo_vec")).collect()}
    assert got == {"periurbain": [0.0, 0.0], "rural": [1.0, 0.0], "urbain": [0.0, 1.0], "autre": [0.0, 0.0]}


def test_scenarios(spark, rows):
    columns = [*m.MAIN_SHARES, *m.VITAL]
    data = [("a", 2017, 10.0), ("a", 2022, 20.0), ("b", 2022, 5.0), ("c", 2017, None), ("c", 2022, 7.0)]
    df = spark.createDataFrame(data, "code_commune string, annee int, v double").withColumns({c: F.col("v") for c in columns}).drop("v")
    got = {(r["code_commune"], r["annee"]): r for r in m.scenario_rows(df).collect()}
    assert len(got) == 9
    assert got[("a", 2027)]["pct_gauche_lag1"] == 20.0 and got[("a", 2027)]["pct_gauche_trend"] == 10.0
    assert got[("a", 2025)]["pct_gauche_trend"] == pytest.approx(6.0)
    assert got[("a", 2025)]["nb_naissances"] == pytest.approx(26.0)
    assert got[("b", 2026)]["pct_gauche_trend"] == 0.0 and got[("b", 2026)]["nb_naissances"] == 5.0
    assert got[("c", 2026)]["pct_gauche_trend"] is None and got[("c", 2026)]["nb_naissances"] is None


def test_temporal_split(spark, rows):
    df = spark.createDataFrame([(2002, None), (2017, "x"), (2022, "y"), (2022, None)], "annee int, bloc_lag1 string")
    train, test = temporal_split(df, 2017, 2022)
    assert rows(train) == [(2017, "x")] and rows(test) == [(2022, "y")]

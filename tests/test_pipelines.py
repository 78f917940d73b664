from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from mairie.plans import gold, silver
from mairie.plans.questions import BUNDLES, Report, bundle, filter_report, question, write_bundle
from mairie.sources.schemas import table_schema


@pytest.fixture(scope="module")
def referential(spark):
    data = [
        ("1001", "A", "a", "1", "COM"), ("01002", "B", "b", "01", None), ("1003", "C", "c", "1", "COMA"),
        ("2A004", "D", "d", "2a", "COMD"), ("97101", "E", "e", "971", "COM"), ("75056", "P", "p", "75", "ARM"),
    ]
    return spark.createDataFrame(data, "COM string, LIBELLE string, NCC string, DEP string, TYPECOM string")


def test_referential(spark, referential, rows):
    got = silver.referential(referential)
    assert rows(got, "code_insee", "libelle", "code_dep") == [
        ("01001", "A", "01"), ("01002", "B", "01"), ("2A004", "D", "2A"), ("75056", "P", "75"),
    ]
    assert got.schema == table_schema("referentiel_communes")
    assert rows(silver.referential(referential, style="pilot"), "code_insee") == [("75056",)]
    raw = silver.referential(referential, keep_raw_department=True)
    assert ("2A004", "2a") in rows(raw, "code_insee", "code_dep")


def test_elections(spark, referential, rows):
    data = [
        ("1001", "2022_pres_t1", "SOC", "12", "12,5"), ("1001", "2022", None, "abc", ""),
        ("01002", "pres_x", "LR", "", None), ("99999", "2022_pres_t1", "LR", "5", "1"), ("2A004", "2017_legi_t2", "RN", "7.0", "0,0005"),
    ]
    raw = spark.createDataFrame(data, "code_commune string, id_election string, nuance string, voix string, ratio_voix_exprimes string")
    got = silver.elections(raw, silver.referential(referential))
    assert got.schema == table_schema("elections")
    assert rows(got, "code_commune", "annee", "type_election", "tour", "nb_voix", "pct_voix_exp") == [
        ("01001", 2022, None, None, None, None),
        ("01001", 2022, "pres", 1, 12, Decimal("12.500")),
        ("01002", None, "x", None, None, None),
        ("2A004", 2017, "legi", 2, 7, Decimal("0.001")),
    ]


def test_income_layouts(spark, rows):
    data = [("x", "1001", "20000", "0,30", "7"), ("x", "1002", "30000,5", None, None), ("x", "1003", None, None, None), ("x", "1001", "99999", None, None)]
    raw = spark.createDataFrame(data, "`Nom géographique` string, `Code géographique` string, `[DISP] Médiane (€)` string, `[DISP] Gini` string, `[DISP] Taux de pauvreté` string")
    got = silver.income(raw)
    # National median of 20000 and 30000.5; the threshold is 0.6 of it.
    assert rows(got, "code_commune", "annee", "mediane_revenu_disp", "taux_pauvrete") == [
        ("01001", 2022, Decimal("20000.00"), Decimal("5.000")),
        ("01002", 2022, Decimal("30000.50"), Decimal("6.000")),
        ("01003", 2022, None, None),
    ]
    kept = silver.income(raw, prefer_source=True)
    assert ("01001", Decimal("7.000")) in rows(kept, "code_commune", "taux_pauvrete")
    fixed = silver.income(raw, national_median=22810.0, digits=None)
    assert ("01002", Decimal("3.000")) in rows(fixed, "code_commune", "taux_pauvrete")
    updated = silver.update_poverty(got)
    assert ("01002", Decimal("3.000")) in rows(updated, "code_commune", "taux_pauvrete")
    wide = spark.createDataFrame([("1001", "20000", "21000")], "CODGEO string, `D5 2019` string, `D5 2020` string")
    assert rows(silver.income(wide, layout="by_year"), "code_commune", "annee", "mediane_revenu_disp") == [
        ("01001", 2019, Decimal("20000.00")), ("01001", 2020, Decimal("21000.00")),
    ]


def test_population_typology(spark, rows):
    data = [("1001", "9000", "1000"), ("1002", "1999", None), ("1003", "2000", "x"), ("1004", None, None), ("97101", "99999", "1")]
    raw = spark.createDataFrame(data, "CODGEO string, P22_POP0014 string, P22_POP1529 string")
    assert rows(silver.population_typology(raw)) == [
        ("01001", 10000.0, "urbain"), ("01002", 1999.0, "rural"), ("01003", 2000.0, "periurbain"), ("01004", 0.0, "rural"),
    ]


@pytest.fixture(scope="module")
def features(spark):
    """A small gold table built from hand-written silver tables."""
    ref = spark.createDataFrame([("01001", "A", "01"), ("01002", "B", "01"), ("02001", "C", "02")], "code_insee string, libelle string, code_dep string")
    votes = []
    for code in ("01001", "01002", "02001"):
        for year in (2017, 2022):
            votes += [(code, year, "pres", 1, "SOC", None, 10), (code, year, "pres", 1, "RN", None, 10 if code != "02001" else 30),
                      (code, year, "pres", 1, None, "MACRON", 5), (code, year, "pres", 2, "SOC", None, 99), (code, year, "legi", 1, "LR", None, 99)]
    votes.append(("03001", 2022, "pres", 1, "LR", None, 1))
    elections = spark.createDataFrame(votes, "code_commune string, annee smallint, type_election string, tour smallint, nuance_liste string, nom_candidat string, nb_voix int")
    births = spark.createDataFrame([("01001", 2016, 4), ("01001", 2022, 6), ("01002", 2022, 1)], "code_commune string, annee smallint, nb_naissances int")
    deaths = spark.createDataFrame([("01001", 2022, 2)], "code_commune string, annee smallint, nb_deces int")
    revenus = spark.createDataFrame([("01001", 2022, 20000.0, 0.3, 5.0)], "code_commune string, annee smallint, mediane_revenu_disp double, gini double, taux_pauvrete double")
    csp = spark.createDataFrame([("01001", 2022, 10.0, 30.0), ("02001", 2022, 0.0, None)], "code_commune string, annee smallint, cadres_emploi double, ouvriers_emploi double")
    for job in silver.OCCUPATIONS:
        if f"{job}_emploi" not in csp.columns:
            csp = csp.withColumn(f"{job}_emploi", F.lit(None).cast("double"))
    dipl = spark.createDataFrame([("01001", 2022, 200.0, 50.0, 10.0, None, 20.0), ("02001", 2022, 0.0, 0.0, None, None, None)], "code_commune string, annee smallint, nscol15p double, sans_diplome double, sup_bac2 double, sup_bac34 double, sup_bac5 double")
    typology = spark.createDataFrame([("01001", "urbain")], "code_commune string, typologie_territoire string")
    tables = {"referentiel_communes": ref, "elections": elections, "naissances": births, "deces": deaths, "revenus": revenus, "csp": csp, "diplomes": dipl}
    return gold.features_communes(tables, typology).cache()


def test_gold_rows(features, rows):
    assert features.schema == table_schema("features_communes")
    got = {(r["code_commune"], r["annee"]): r for r in features.collect()}
    assert len(got) == 7 and ("03001", 2022) in got
    a = got[("01001", 2022)]
    assert (a["pct_gauche"], a["pct_centre"], a["pct_extremedroite"], a["bloc_dominant"]) == (Decimal("40.000"), Decimal("20.000"), Decimal("40.000"), "Gauche")
    assert (a["nb_naissances"], a["nb_deces"], a["solde_naturel"]) == (6, 2, 4)
    assert (a["cadres_pct"], a["ouvriers_pct"], a["pct_bac_plus"], a["pct_sans_diplome"]) == (Decimal("25.000"), Decimal("75.000"), Decimal("15.000"), Decimal("25.000"))
    assert got[("02001", 2022)]["bloc_dominant"] == "ExtremeDroite"
    # 2017 takes the births of 2016; the municipality without a row there is imputed.
    assert got[("01001", 2017)]["nb_naissances"] == 4 and got[("01001", 2017)]["solde_naturel"] == 4
    # A municipality outside the referential keeps its row, without a department.
    c = got[("03001", 2022)]
    assert (c["libelle"], c["code_dep"], c["typologie_territoire"]) == (None, None, "rural")


def test_gold_invariants(features):
    shares = ["pct_gauche", "pct_centre", "pct_droite", "pct_extremedroite", "pct_divers"]
    for r in features.collect():
        assert abs(sum(r[c] for c in shares) - 100) < Decimal("0.01")
        for c in gold.IMPUTED:
            # Artisans and employees have no value anywhere, so nothing can fill them.
            assert (r[c] is None) == (c in ("employes_pct", "artisans_pct"))
    assert features.groupBy("code_commune", "annee").count().where("count > 1").count() == 0


def test_department_fallback(spark, rows):
    df = spark.createDataFrame([("01001", None), ("2A004", None)], "code_commune string, code_dep string")
    assert rows(gold.department_fallback(df), "code_dep") == [("01",), ("2A",)]
    some = spark.createDataFrame([("01001", None), ("2A004", "2A")], "code_commune string, code_dep string")
    assert rows(gold.department_fallback(some), "code_dep") == [(None,), ("2A",)]


@pytest.fixture(scope="module")
def report(spark, features):
    data = []
    for code, dep, one, two in [("01001", "01", "ExtremeDroite", "Centre"), ("01002", "01", "ExtremeDroite", "Centre"), ("02001", "02", "ExtremeDroite", "Gauche")]:
        data += [(code, code, dep, 2025, one, 0.1, 0.2, 0.3, 0.4, "m", "rural"), (code, code, dep, 2027, two, 0.1, 0.2, 0.3, 0.4, "m", "rural")]
    predictions = spark.createDataFrame(data, "code_commune string, libelle string, code_dep string, annee int, bloc_predit string, prob_gauche double, prob_centre double, prob_droite double, prob_extremedroite double, modele string, typologie_territoire string")
    from mairie.operators.harmonise import enforce_schema

    return Report(features, enforce_schema(predictions, table_schema("predictions")), departments=["01", "02"])


def test_questions(report, rows):
    assert rows(report.q17()) == [("01", 2)]
    assert rows(report.q19()) == [("Gauche", 1, Decimal("100.0"))]
    assert rows(report.q20()) == [("rural", "Gauche", "Centre", 1, Decimal("0.400"))]
    assert rows(report.q16()) == []
    assert report.q13().first()["moy_prob_droite"] == pytest.approx(0.3)
    labels = {r["source"] for r in report.q18().collect()}
    assert labels == {"Reel 2022", "Predit 2027"}


def test_bundles_and_parameters(spark, report, tmp_path, rows):
    assert len(BUNDLES) == 6
    every = {q for names in BUNDLES.values() for q in names}
    assert all(hasattr(report, q) for q in every)
    one = bundle(report, "departements_cles", code_dep=["02"])
    assert rows(one["q10"]) == [("02", 1)]
    paths = write_bundle(one, str(tmp_path))
    assert rows(spark.read.parquet(paths["q10"])) == [("02", 1)]
    with pytest.raises(ValueError):
        bundle(report, "predictions", code_dep="01")
    assert filter_report(report.f, annee=2017, code_dep=None).select("annee").distinct().count() == 1


def test_generic_question(report, rows):
    got = question(
        report.f, {"n": F.count(F.lit(1)), "m": F.avg("pct_gauche")}, by=["code_dep"], where={"annee": 2022},
        order=[F.desc("n"), "code_dep"], limit=1,
    )
    assert [(r["code_dep"], r["n"]) for r in got.collect()] == [("01", 2)]
    assert question(report.f, {"n": F.count(F.lit(1))}, where=F.col("annee") > 2017).first()["n"] == 4

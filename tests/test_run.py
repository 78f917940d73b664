"""The job from text files to reports, on a small invented area."""

import random

import pytest

from mairie.plans import run
from mairie.sources import tables

YEARS = [2002, 2007, 2012, 2017, 2022]


@pytest.fixture(scope="module")
def bronze(tmp_path_factory):
    rng, folder = random.Random(11), tmp_path_factory.mktemp("bronze")
    codes = [f"{dep:02d}{n:03d}" for dep in (75, 92, 93) for n in range(1, 15)]

    def write(name, lines):
        (folder / name).write_text("\n".join(lines) + "\n", encoding="utf-8")

    write("communes.csv", ["TYPECOM,COM,REG,DEP,LIBELLE"] + [f"COM,{c},11,{c[:2]},Commune {c}" for c in codes] + ["COM,97101,1,971,Loin"])
    votes = ["id_election;code_commune;nuance;nom;voix;ratio_voix_exprimes"]
    for y in YEARS:
        for c in [*codes, "97101"]:
            for nuance, nom in (("SOC", ""), ("LR", ""), ("", "MACRON"), ("", " Le Pen ")):
                votes.append(f"{y}_pres_t1;{c};{nuance};{nom};{rng.randint(0, 90)};12,5")
            votes.append(f"{y}_pres_t2;{c};LR;;5;1")
    write("elections.csv", votes)
    for name in ("naissances", "deces"):
        rows = [f"{c};{y};{rng.randint(0, 50)};{m}" for c in codes[:-3] for y in (2008, 2016, 2022) for m in ("LVB", "LDB", "T")]
        write(f"{name}.csv", ["GEO;TIME_PERIOD;OBS_VALUE;EC_MEASURE", *rows])
    write("revenus.csv", ["Nom;Code géographique;[DISP] Médiane (€);[DISP] Gini 2022;D5 2019"] + [
        f"x;{c};{rng.randint(12000, 40000)},5;{'0,3' if i % 3 else ''};20000" for i, c in enumerate(codes[:-2])
    ])
    jobs = [f"csx_rec{i}taxtypac_rec{j}rpop2022" for i in range(1, 7) for j in (1, 2)]
    write("csp.csv", [f"note {i}" for i in range(15)] + [";".join(["DR", "CR", *jobs])] + [
        ";".join([c[:2], c[2:], *[str(rng.randint(0, 99)) for _ in jobs]]) for c in codes
    ])
    columns = ["P22_NSCOL15P", "P22_NSCOL15P_DIPLMIN", "P22_NSCOL15P_SUP2", "P22_NSCOL15P_SUP34", "P22_NSCOL15P_SUP5", "P22_POP0014", "P22_POP1529"]
    write("diplomes.csv", [f"note {i}" for i in range(5)] + [";".join(["CODGEO", *columns])] + [
        ";".join([c, str(rng.randint(500, 900)), *[str(rng.randint(0, 100)) for _ in range(4)], str(rng.randint(0, 9000)), str(rng.randint(0, 4000))]) for c in codes
    ])
    return str(folder)


@pytest.mark.parametrize("scope", ["national", "pilot"])
def test_job(spark, bronze, tmp_path, rows, scope):
    out = str(tmp_path / "out")
    run.load_silver(spark, bronze, out, scope)
    checks = {r["table_name"]: r for r in run.validation(spark, out).collect()}
    assert checks["referentiel_communes"]["n"] == 42 and checks["csp"]["n"] == 42
    assert (checks["elections"]["n"], checks["elections"]["annee_min"], checks["elections"]["cles"]) == (42 * 5 * 5, 2002, 42)
    assert checks["naissances"]["n"] == 39 * 3
    assert checks["revenus"]["n"] == (40 if scope == "national" else 80)

    features = run.build_gold(spark, out, scope)
    assert features.count() == 42 * 5
    assert features.where("nb_naissances is null or mediane_revenu_disp is null or cadres_pct is null").count() == 0
    assert (features.where("typologie_territoire is null").count() == 0) == (scope == "national")

    if scope == "pilot":
        return
    predictions = run.predict(spark, out, scope, forest={"numTrees": 8}, boosting={"maxIter": 2})
    assert predictions.count() == 42 * 3
    for r in predictions.collect():
        known = [r[c] for c in predictions.columns if c.startswith("prob_") and r[c] is not None]
        assert abs(float(sum(known)) - 1.0) < 0.01
    classes = tables.scan_table(spark, f"{out}/reports/model/RandomForest/classification")
    assert {"macro avg", "weighted avg"} <= {r["classe"] for r in classes.collect()}

    paths = run.write_reports(spark, out, code_dep=["75"])
    top = spark.read.parquet(paths["departements_cles"]["q09"])
    assert [r["code_dep"] for r in top.collect()] in ([], ["75"])
    total = spark.read.parquet(paths["vue_nationale"]["q02"]).agg({"n": "sum"}).first()[0]
    assert total == 42 * 5


def test_unknown_stage(spark):
    with pytest.raises(SystemExit):
        run.main(["--bronze", "x", "--out", "y", "--stages", "nothing"])

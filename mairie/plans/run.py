"""The whole pipeline as a job: bronze files to silver, gold, predictions and reports.

``spark-submit --py-files mairie.zip mairie/plans/run.py --bronze DIR --out DIR [--stages silver,gold,...]``

Each stage reads what the one before it stored, so a stage can be run again alone.
"""

from __future__ import annotations

import argparse
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

from mairie.operators import quality
from mairie.operators.ordering import union_all
from mairie.operators.selection import (
    BIRTH_MEASURES,
    DEATH_MEASURES,
    PILOT_BIRTH_MEASURES,
    temporal_split,
)
from mairie.plans import gold, modelling, silver
from mairie.plans.questions import BUNDLE_FILTERS, BUNDLES, Report, bundle, write_bundle
from mairie.session import build_session
from mairie.sources import tables
from mairie.sources.delimited import FILE_ORDER, scan_delimited, scan_sheet, with_file_order
from mairie.sources.schemas import LAYERS

# File or folder of each source inside the bronze folder.
FILES = {
    "communes": "communes.csv", "elections": "elections.csv", "naissances": "naissances.csv",
    "deces": "deces.csv", "revenus": "revenus.csv", "csp": "csp.csv", "diplomes": "diplomes.csv",
}
STAGES = ["silver", "gold", "predictions", "reports"]
SILVER = [name for name, layer in LAYERS.items() if layer == "silver"]


def stored(spark: SparkSession, out: str, name: str) -> DataFrame:
    return tables.scan_table(spark, f"{out}/{LAYERS.get(name, 'silver')}/{name}")


def load_silver(
    spark: SparkSession, bronze: str, out: str, scope: str = "national", files: Mapping[str, str] = FILES
) -> None:
    """Every silver table, the referential first: the others keep its municipalities only."""

    def path(name):
        return f"{bronze}/{files[name]}"

    def keep(name, df):
        return tables.create_table(df, name, f"{out}/silver/{name}")

    ref = keep(
        "referentiel_communes", silver.referential(scan_delimited(spark, path("communes"), ","), style=scope)
    )
    births = PILOT_BIRTH_MEASURES if scope == "pilot" else BIRTH_MEASURES

    def lines(name):
        return with_file_order(scan_delimited(spark, path(name)))

    keep("elections", silver.elections(scan_delimited(spark, path("elections")), ref))
    keep("naissances", silver.vital_events(lines("naissances"), ref, "nb_naissances", births))
    keep("deces", silver.vital_events(lines("deces"), ref, "nb_deces", DEATH_MEASURES))
    layout = "by_year" if scope == "pilot" else "snapshot"
    keep("revenus", silver.income(lines("revenus"), ref, layout))
    keep("csp", silver.occupations(scan_sheet(spark, path("csp"), "DR", order=FILE_ORDER), ref))
    sheet = scan_sheet(spark, path("diplomes"), "CODGEO", order=FILE_ORDER)
    keep("diplomes", silver.diplomas(sheet, ref))
    if scope == "national":
        tables.write_table(silver.population_typology(sheet), f"{out}/silver/typologie")


def validation(spark: SparkSession, out: str) -> DataFrame:
    """Rows, years and distinct keys of every silver table."""
    rows = []
    for name in SILVER:
        df = stored(spark, out, name)
        key = "code_insee" if name == "referentiel_communes" else "code_commune"
        rows.append(quality.validation_row(df, name, "annee" if "annee" in df.columns else None, key))
    return union_all(*rows)


def build_gold(spark: SparkSession, out: str, scope: str = "national") -> DataFrame:
    sources = {name: stored(spark, out, name) for name in SILVER}
    typology = stored(spark, out, "typologie") if scope == "national" else None
    features = gold.features_communes(sources, typology, scope)
    return tables.create_table(features, "features_communes", f"{out}/gold/features_communes")


def predict(
    spark: SparkSession,
    out: str,
    scope: str = "national",
    leak_free: bool = False,
    forest: Mapping[str, object] = {},
    boosting: Mapping[str, object] = {},
) -> DataFrame:
    """Train both learners, keep the better one on the last election, score the scenarios."""
    rows = modelling.model_rows(stored(spark, out, "features_communes"))
    train, test = temporal_split(rows, modelling.LAST_TRAIN_YEAR, modelling.BASE_YEAR)
    features = modelling.feature_names(scope, leak_free)
    models = [
        modelling.train_forest(train, features, **forest),
        modelling.train_boosting(train, features, **boosting),
    ]
    figures = []
    for model in models:
        predicted = model.predict(test)
        folder = f"{out}/reports/model/{model.name}"
        tables.write_table(modelling.classification_report(predicted), f"{folder}/classification")
        tables.write_table(modelling.confusion_matrix(predicted), f"{folder}/confusion")
        if "typologie_territoire" in predicted.columns:
            by_type = modelling.accuracy(predicted, by=["typologie_territoire"])
            tables.write_table(by_type, f"{folder}/accuracy_by_typology")
        figures.append(modelling.accuracy_value(predicted))
    tables.write_table(modelling.importances(models[0], spark, None), f"{out}/reports/model/importances")
    best = modelling.choose_model(models[0], figures[0], models[1], figures[1])
    scored = modelling.score(best, modelling.scenario_rows(rows))
    return tables.create_table(scored, "predictions", f"{out}/gold/predictions")


def write_reports(spark: SparkSession, out: str, **choices) -> dict[str, dict[str, str]]:
    """Every bundle with its questions as tables; ``choices`` apply where a bundle offers them."""
    report = Report(stored(spark, out, "features_communes"), stored(spark, out, "predictions"))
    paths = {}
    for name in BUNDLES:
        wanted = {k: v for k, v in choices.items() if k in BUNDLE_FILTERS[name]}
        paths[name] = write_bundle(bundle(report, name, **wanted), f"{out}/reports/{name}")
    return paths


def main(argv: Sequence[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("--bronze", required=True)
    parser.add_argument("--out", required=True)
    parser.add_argument("--scope", choices=["national", "pilot"], default="national")
    parser.add_argument("--stages", default=",".join(STAGES))
    parser.add_argument("--leak-free", action="store_true")
    args = parser.parse_args(argv)
    spark = build_session("mairie")
    for stage in args.stages.split(","):
        if stage == "silver":
            load_silver(spark, args.bronze, args.out, args.scope)
            tables.write_table(validation(spark, args.out), f"{args.out}/reports/validation")
        elif stage == "gold":
            written = build_gold(spark, args.out, args.scope)
            tables.write_table(quality.fill_rates(written), f"{args.out}/reports/fill_rates")
        elif stage == "predictions":
            predict(spark, args.out, args.scope, args.leak_free)
        elif stage == "reports":
            write_reports(spark, args.out)
        else:
            raise SystemExit(f"unknown stage {stage!r}")


if __name__ == "__main__":
    main()

"""Headline timings: ``python bench.py`` prints one JSON line.

BENCH_SF_DIR   folder of test tables (default /root/testdata/sf0.1)
BENCH_CPUS     local threads (default 8)
BENCH_REPEAT   runs per query, the best counts (default 2)
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from mairie.session import build_session  # noqa: E402

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
REPEAT = int(os.environ.get("BENCH_REPEAT", "2"))

# Whole pipeline stages, each built anew; then questions and operators over the stored tables.
STAGES = ["silver_elections", "silver_tables", "gold_features", "predictions", "forest_train_and_score", "boosting_train"]
QUERIES = [
    "src02_large_scan_filter_load", "scl23_default_label", "flt02_semi_filter", "flt08_keep_first",
    "jn03_full_outer", "jn04_nearest_year", "jn09_dictionary_join", "jn10_contains_map",
    "agg03_pivot_shares", "agg09_spread_group_median", "agg10_impute_medians", "agg11_validation_row",
    "agg25_correlations", "win01_previous_row", "win03_share_of_grand_total", "dq01_duplicate_keys",
    "q01_bloc_shares_over_time", "q02_dominant_bloc_by_year", "q04_occupations_by_bloc", "q06_income_by_bloc",
    "q09_top_departments_gauche", "q11_predicted_blocs", "q13_mean_probabilities", "q17_switching_departments",
    "q18_actual_and_predicted", "q19_fate_of_communes", "q20_rural_probability", "ml08_classification_report",
    "ml11_scenario_rows",
]


def timed(run) -> float:
    start = time.time()
    run()
    return time.time() - start


def materialise(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    spark = build_session(
        "bench",
        f"local[{CPUS}]",
        **{
            "spark.sql.shuffle.partitions": CPUS,
            "spark.driver.memory": "16g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")

    from mairie.catalogue import QUERIES as registered
    from mairie.catalogue.adapters import Tables
    from mairie.catalogue.reports_models import split
    from mairie.plans import modelling, silver
    from mairie.session import new_path
    from mairie.sources import delimited, tables

    t = Tables(spark, FOLDER)
    materialise(t.read("lineitem").groupBy("l_returnflag").count())  # start the executors

    # The results as delimited text, written before the clock starts.
    text = new_path(spark, "bench-text")
    t.bronze_elections().repartition(2 * int(CPUS)).write.option("sep", ";").option("header", True).csv(text)
    rows = t.read("lineitem").count()
    known = t.referential()

    def silver_elections():
        """Text to the typed, partitioned results table of known municipalities."""
        raw = delimited.scan_delimited(spark, text)
        tables.create_table(silver.elections(raw, known), "elections", new_path(spark, "bench-elections"))

    def forest():
        train, test = split(t)
        materialise(modelling.score(modelling.train_forest(train), t.scenarios()))

    def boosting():
        modelling.train_boosting(split(t)[0])

    stages = {
        "silver_elections": silver_elections,
        "silver_tables": t.store_silver,
        "gold_features": lambda: materialise(t.build_gold()),
        "predictions": lambda: t.predictions(),
        "forest_train_and_score": forest,
        "boosting_train": boosting,
    }
    silver_elections()  # compile once
    times = {name: round(timed(stages[name]), 3) for name in STAGES}
    for name in QUERIES:
        runs = [timed(lambda: materialise(registered[name](spark, FOLDER))) for _ in range(REPEAT)]
        times[name] = round(min(runs), 3)
    print(
        json.dumps(
            {
                "metric": "total_query_time",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(FOLDER.rstrip("/")).removeprefix("sf"),
                "cpus": int(CPUS),
                "load_rows_per_sec": round(rows / times["silver_elections"]),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()

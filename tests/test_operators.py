import random
from statistics import median

import pytest
from pyspark.sql import functions as F

from mairie.operators import aggregates, imputation, joins, medians, ordering, quality, selection, windows


def test_prefer_measure(spark, rows):
    def run(measures, priority):
        df = spark.createDataFrame([(m, i) for i, m in enumerate(measures)], "m string, v int")
        return [r[0] for r in rows(selection.prefer_measure(df, "m", priority), "m")]

    assert run(["LVB", "T", None], ["LVB", "T"]) == ["LVB"]
    assert run(["T", "X", "NOMBRE"], ["LVB", "NOMBRE", "T"]) == ["NOMBRE"]
    assert run(["X", "Y", None], ["LVB", "T"]) == [None, "X", "Y"]
    assert run(["Z", "Z"], ["LVB"]) == ["Z", "Z"]


def test_keep_first_and_its_plan(spark, rows):
    df = spark.createDataFrame([("a", 2, "y"), ("a", 1, "x"), ("b", 5, "z")], "k string, o int, v string")
    kept = selection.keep_first(df, ["k"], ["o"])
    assert rows(kept) == [("a", 1, "x"), ("b", 5, "z")]
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "row_number(), 1, Partial" in plan


def test_semi_filter_broadcasts_only_small_sides(spark, monkeypatch):
    import mairie.session as session

    facts = spark.range(1000).select((F.col("id") % 7).cast("string").alias("k"))
    ref = spark.createDataFrame([("1",), ("3",), ("3",)], "c string")
    small = selection.semi_filter(facts, ref, "k", "c")
    assert "BroadcastHashJoin" in small._jdf.queryExecution().executedPlan().toString()
    counted = small.count()
    monkeypatch.setattr(selection, "broadcast_checked", lambda df: session.broadcast_checked(df, 0))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        large = selection.semi_filter(facts, ref, "k", "c")
        assert "BroadcastHashJoin" not in large._jdf.queryExecution().executedPlan().toString()
        assert large.count() == counted == sum(1 for i in range(1000) if i % 7 in (1, 3))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_metropolitan_and_kinds(spark, rows):
    data = ["01001", "95999", "96001", "97101", "2A004", "2B001", "98000", "00001", "20001"]
    df = spark.createDataFrame([(d,) for d in data], "c string")
    kept = [r[0] for r in rows(df.where(selection.is_metropolitan("c")))]
    assert kept == ["01001", "20001", "2A004", "2B001", "95999"]
    kinds = spark.createDataFrame([("COM",), ("COMD",), ("ARM",), ("COMA",), (None,)], "t string")
    assert rows(kinds.where(selection.member_or_null("t"))) == [(None,), ("ARM",), ("COM",), ("COMD",)]


def test_nearest_year(spark, rows):
    main = spark.createDataFrame([("a", 1997), ("a", 2001), ("b", 1997)], "code_commune string, annee int")
    feat = spark.createDataFrame([("a", 1996, 5), ("a", 1998, 6), ("b", 1998, 7)], "code_commune string, annee int, v int")
    # 1997 is a tie and takes 1996; b has no row in 1996.
    assert rows(joins.nearest_year_join(main, feat, ["v"])) == [("a", 1997, 5), ("a", 2001, 6), ("b", 1997, None)]


def test_natural_balance(spark, rows):
    births = spark.createDataFrame([("a", 2000, 5), ("b", 2000, 2)], "code_commune string, annee int, nb_naissances int")
    deaths = spark.createDataFrame([("a", 2000, 7), ("c", 2000, 1)], "code_commune string, annee int, nb_deces int")
    assert rows(joins.natural_balance(births, deaths)) == [
        ("a", 2000, 5, 7, -2), ("b", 2000, 2, None, 2), ("c", 2000, None, 1, -1),
    ]


def test_difference_default_and_null(spark, rows):
    base = spark.createDataFrame([("a", 10.0), ("b", 10.0), ("c", 10.0)], "code_commune string, x double")
    old = spark.createDataFrame([("a", 4.0), ("b", None)], "code_commune string, x double")
    assert rows(joins.difference_to(base, old, ["x"]), "code_commune", "x_trend") == [("a", 6.0), ("b", None), ("c", 0.0)]


def test_literal_years_and_pairs(spark, rows):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), ("b", 1, "z")], "code_commune string, annee int, v string")
    assert rows(joins.for_each_year(df.where("annee = 2"), [2025, 2027], "y"), "code_commune", "y") == [("a", 2025), ("a", 2027)]
    assert rows(joins.paired_years(df, 1, 2, ["v"])) == [("a", "x", "y")]


def test_shares(spark, rows):
    data = [
        ("a", 1, "Gauche", 2), ("a", 1, "Gauche", 2), ("a", 1, "Centre", 4), ("a", 1, "Divers", 8),
        ("b", 1, "Droite", 0), ("c", 1, "Divers", 3),
    ]
    votes = spark.createDataFrame(data, "code_commune string, annee int, bloc string, nb_voix int")
    wide = aggregates.with_dominant_bloc(aggregates.pivot_shares(votes))
    # b has no votes and vanishes; a is a tie between two blocs; c has votes for none of the four.
    assert rows(wide) == [
        ("a", 1, 25.0, 25.0, 0.0, 0.0, 50.0, "Gauche"), ("c", 1, 0.0, 0.0, 0.0, 0.0, 100.0, "Gauche"),
    ]
    long = aggregates.bloc_shares(votes.where("code_commune <> 'b'"))
    assert rows(long, "code_commune", "bloc", "nb_voix", "pct") == [
        ("a", "Centre", 4, 25.0), ("a", "Divers", 8, 50.0), ("a", "Gauche", 4, 25.0), ("c", "Divers", 3, 100.0),
    ]


def test_bloc_shares_without_votes(spark, rows):
    votes = spark.createDataFrame([("b", 1, "Droite", 0), ("a", 1, "Droite", 1)], "code_commune string, annee int, bloc string, nb_voix int")
    assert rows(aggregates.bloc_shares(votes), "code_commune", "pct") == [("a", 100.0)]


@pytest.mark.parametrize("limit", [200_000, 50])
def test_medians_against_brute_force(spark, limit):
    rng = random.Random(7)
    data = []
    for key in ["hot", "b", "c", "one", None]:
        size = {"hot": 3000, "one": 1}.get(key, 60)
        for _ in range(size):
            x = rng.choice([rng.gauss(0, 1e3), float(rng.randint(0, 3)), 1e9 * rng.random(), -5.0])
            data.append((key, x, None if rng.random() < 0.3 else rng.lognormvariate(0, 4)))
    data += [("empty", None, None), ("same", 4.0, 4.0), ("same", 4.0, 4.0), ("two", 1.0, 2.0), ("two", 4.0, 9.0)]
    df = spark.createDataFrame(data, "k string, x double, y double").repartition(5)
    got = {r["k"]: (r["x"], r["y"]) for r in medians.medians(df, ["x", "y"], ["k"], limit).collect()}
    for key in {d[0] for d in data}:
        for i, column in enumerate((1, 2)):
            values = [d[column] for d in data if d[0] == key and d[column] is not None]
            assert got[key][i] == (median(values) if values else None)
    overall = medians.medians(df, ["x", "y"], (), limit).first()
    for name, column in (("x", 1), ("y", 2)):
        assert overall[name] == median([d[column] for d in data if d[column] is not None])


def test_median_slices_do_not_follow_the_distribution(spark):
    rng = random.Random(3)
    data = [(rng.lognormvariate(0, 5), rng.random()) for _ in range(20_000)] + [(0.5, 1e9), (0.5, 1e18)]
    df = spark.createDataFrame(data, "heavy double, outliers double")
    long = df.unpivot([], ["heavy", "outliers"], "_column", "_v").groupBy("_column", "_v").count()
    ranged = long.repartitionByRange(40, "_column", "_v").withColumn("s", F.spark_partition_id())
    assert max(r["count"] for r in ranged.groupBy("s").count().collect()) < 3 * 1_000
    got = medians.medians(df, ["heavy", "outliers"], (), 1_000).first()
    assert got["heavy"] == median([d[0] for d in data]) and got["outliers"] == median([d[1] for d in data])


def test_imputation_order(spark, rows):
    data = [
        ("01", "a", None), ("01", "b", 2.0), ("01", "c", 4.0),   # partial department: 3
        ("02", "d", None), ("02", "e", None),                     # empty department: national
        (None, "f", None), (None, "g", 100.0),                    # no department: national
    ]
    df = spark.createDataFrame(data, "code_dep string, k string, v double")
    got = dict(rows(imputation.impute_medians(df, ["v"]), "k", "v"))
    # The national median is taken after the department fill: of 3, 2, 4, 100 and not of 2, 4, 100.
    assert got == {"a": 3.0, "b": 2.0, "c": 4.0, "d": 3.5, "e": 3.5, "f": 3.5, "g": 100.0}


def test_lags_follow_rows_not_years(spark, rows):
    shares = ["pct_gauche", "pct_centre", "pct_droite", "pct_extremedroite"]
    data = [("a", 2002, 1.0, "G"), ("a", 2012, 4.0, "C"), ("b", 2002, 9.0, "D")]
    df = spark.createDataFrame(data, "code_commune string, annee int, p double, bloc_dominant string")
    for c in shares:
        df = df.withColumn(c, F.col("p"))
    out = windows.trend_features(windows.lag_features(df))
    assert rows(out, "code_commune", "annee", "pct_gauche_lag1", "pct_gauche_trend", "bloc_lag1", "intervalle") == [
        ("a", 2002, None, None, None, None), ("a", 2012, 1.0, 3.0, "G", 10), ("b", 2002, None, None, None, None),
    ]


def test_profiles(spark, rows):
    df = spark.createDataFrame([(1, "a"), (2, None), (3, "a")], "x int, s string")
    assert [(c, float(v)) for c, v in rows(quality.fill_rates(df))] == [("s", 66.7), ("x", 100.0)]
    assert [r[0] for r in rows(quality.fill_rates(df, only_incomplete=True))] == ["s"]
    assert [(c, n, round(p, 4)) for c, n, p in rows(quality.missing_values(df))] == [("s", 1, 33.3333)]
    assert rows(quality.value_counts(df, "s")) == [("a", 2)]
    assert rows(quality.null_violations(df, ["x", "s"])) == [("s", 1, False), ("x", 0, True)]
    assert quality.duplicate_keys(df, ["s"]).collect()[0]["n"] == 2
    assert rows(quality.dataset_profile(df, "d")) == [("d", 3, 2, 0, "x", "int"), ("d", 3, 2, 1, "s", "string")]
    check = quality.coverage_check(df, "x", 90, (1.5, 2.5)).first()
    assert (check["couverture_ok"], check["moyenne_ok"], check["moyenne"]) == (True, True, 2.0)


def test_sample_does_not_depend_on_partitions(spark, rows):
    df = spark.range(500).toDF("id")
    one, two = ordering.sample_rows(df.repartition(3), 9, ["id"]), ordering.sample_rows(df.repartition(11), 9, ["id"])
    assert rows(one) == rows(two) and len(rows(one)) == 9
    assert rows(one) != rows(ordering.sample_rows(df, 9, ["id"], seed=1))


def test_correlations(spark, rows):
    df = spark.createDataFrame([(1.0, 2.0, 5.0), (2.0, 4.0, 5.0), (3.0, None, 5.0)], "a double, b double, c double")
    got = {(i, r): v for i, r, v in rows(aggregates.correlations(df, ["a"], ["b", "c"]))}
    assert abs(got[("a", "b")] - 1.0) < 1e-12 and got[("a", "c")] is None


def test_crosstab_fills_zero(spark, rows):
    df = spark.createDataFrame([("x", "A"), ("x", "A"), ("y", "B")], "r string, c string")
    assert rows(aggregates.crosstab(df, "r", "c", ["A", "B", "C"])) == [("x", 2, 0, 0), ("y", 0, 1, 0)]


def test_medians_of_groups_cut_into_pieces(spark, monkeypatch):
    """Groups far above the ranked size, with ties, infinities, NaN, null keys and empty columns."""
    import random
    import statistics

    from mairie.operators import medians as module

    monkeypatch.setattr(module, "PIVOTS", 7)
    rng = random.Random(2)
    data = []
    for key, n in (("a", 999), ("b", 1000), (None, 640), ("c", 1), ("d", 2), ("e", 0)):
        for i in range(n):
            tie = 5.0 if rng.random() < 0.4 else float(rng.randint(-3, 9))
            data.append((key, rng.gauss(0, 1e6), tie, [float("inf"), float("-inf"), 1.0][i % 3], None))
    data.append(("e", None, None, None, None))
    df = spark.createDataFrame(data, "k string, x double, ties double, far double, none double").repartition(5)
    for ranked in (1, 10, 200_000):
        got = {r["k"]: r for r in module.medians(df, ["x", "ties", "far", "none"], ["k"], ranked).collect()}
        assert set(got) == {"a", "b", None, "c", "d", "e"}
        for key, r in got.items():
            for j, name in enumerate(["x", "ties", "far", "none"], start=1):
                values = sorted(d[j] for d in data if d[0] == key and d[j] is not None)
                middle = [values[(len(values) - 1) // 2], values[len(values) // 2]] if values else []
                want = middle[0] * 0.5 + middle[1] * 0.5 if middle else None
                assert r[name] == want or (want != want and r[name] != r[name]), (ranked, key, name)
    whole = module.medians(df, ["x"], (), 25).first()["x"]
    assert whole == statistics.median_low([d[1] for d in data if d[1] is not None]) * 0.5 + statistics.median_high([d[1] for d in data if d[1] is not None]) * 0.5
    nan = spark.createDataFrame([(float("nan"),)] * 30 + [(1.0,)] * 10, "v double")
    assert module.medians(nan, ["v"], (), 3).first()["v"] != module.medians(nan, ["v"], (), 3).first()["v"]
    assert module.medians(df.limit(0), ["x"], ["k"]).count() == 0 and module.medians(df.limit(0), ["x"]).first()["x"] is None

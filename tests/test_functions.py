from pyspark.sql import functions as F

from mairie.functions import codes, mappings, numbers, poverty, territory


def values(spark, data, column, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(data)], f"i int, v {kind}")
    return [r[0] for r in df.orderBy("i").select(column).collect()]


def test_zfill_never_cuts(spark):
    assert values(spark, ["1", "1001", "2A004", "123456", None], codes.zfill("v", 5)) == [
        "00001", "01001", "2A004", "123456", None,
    ]


def test_department_codes(spark):
    data = ["1", "01", "2a", "971", " 75 ", "075", "A"]
    assert values(spark, data, codes.department_code("v")) == ["01", "01", "2A", "971", "75", "075", "A"]
    assert values(spark, data, codes.department_code("v", "pilot")) == ["01", "01", "2a", "971", "75", "75", "0A"]


def test_composite_code(spark):
    df = spark.createDataFrame([("1", "4"), ("2a", "004"), ("75", "101")], "d string, c string")
    assert [r[0] for r in df.select(codes.composite_code("d", "c")).collect()] == ["01004", "2A004", "75101"]


def test_election_identifier(spark):
    data = ["2022_pres_t1", "pres", "x_2017_t2", "2012-legi", None, "70000_a", "a_"]
    assert values(spark, data, codes.election_year("v")) == [2022, None, 2017, 2012, None, 7000, None]
    assert values(spark, data, codes.election_type("v")) == ["pres", None, "2017", None, None, "a", ""]
    assert values(spark, data, codes.election_round("v")) == [1, None, 2, None, None, None, None]
    assert values(spark, ["PR2002T1", "PR2002T2", "LG2002T1"], codes.is_presidential_first_round_id("v")) == [True, False, False]


def test_department_name_ignores_padding(spark):
    assert values(spark, ["75", "075", "75 ", "092", "094", "13"], codes.department_name("v")) == [
        "Paris", "Paris", "Paris", "Hauts-de-Seine", "Val-de-Marne", "13",
    ]


def test_number_parsing(spark):
    data = ["12", " 12.5 ", "abc", "", "1d", "2f", "1e3", "-.5", "NaN", None, "1 000", "0x1p3", "5.", "."]
    assert values(spark, data, numbers.to_number("v")) == [12.0, 12.5, None, None, None, None, 1000.0, -0.5, None, None, None, None, 5.0, None]
    assert values(spark, ["12.0", "12.5", "70000", "x", " 7", "+3"], numbers.to_integer("v", "smallint")) == [12, None, None, None, 7, 3]
    assert values(spark, ["12,5", "21000,5", "1.5", "a,b"], numbers.decimal_comma("v")) == [12.5, 21000.5, 1.5, None]


def test_percentage_guard(spark):
    df = spark.createDataFrame([(1, 3), (1, 0), (None, 4), (2, None)], "a int, b int")
    assert [r[0] for r in df.select(numbers.percentage("a", "b")).collect()] == [33.333, None, None, None]


def test_sums_and_rounding(spark):
    df = spark.createDataFrame([(None, None), (1, None), (1, 2)], "a int, b int")
    assert [r[0] for r in df.select(numbers.sum_ignoring_nulls("a", "b")).collect()] == [0, 1, 3]
    assert values(spark, [0.5, 1.5, 2.5], numbers.round_half_even("v", 0), "double") == [0.0, 2.0, 2.0]
    assert [float(v) for v in values(spark, [0.05, 0.15, 8.45], numbers.round_half_up("v", 1), "double")] == [0.1, 0.2, 8.5]
    assert values(spark, [-3.0, 20.0, 77.0, None], numbers.clamp("v", 0.0, 50.0), "double") == [0.0, 20.0, 50.0, None]


def test_bins_are_right_closed(spark):
    label = numbers.bin_label("v", poverty.RATE_BINS, poverty.RATE_BIN_LABELS)
    data = [0.0, 0.1, 5.0, 5.1, 20.0, 50.0, 50.1, None]
    assert values(spark, data, label, "double") == [None, "<5%", "<5%", "5-10%", "15-20%", ">30%", None, None]


def test_tables_have_the_published_sizes():
    national, pilot = mappings.nuance_table(), mappings.nuance_table("pilot")
    assert len(national) == len(pilot) == 148
    assert {k for k in national if national[k] != pilot[k]} == {"UDI", "LDVC", "LXD", "LFG", "BC-UC"}
    assert len(mappings.CANDIDATES) == len(dict(mappings.CANDIDATES)) == 42


def test_bloc_of_a_row(spark):
    data = [
        ("SOC", "MACRON"), ("UDI", None), ("LDVC", None), ("LXD", None), ("LFG", None), ("BC-UC", None),
        (None, " Le Pen "), ("", "MR LE PEN"), (None, "de Villiers"), (" SOC", None), (None, None), (None, ""), ("ZZZ", "inconnu"),
    ]
    df = spark.createDataFrame([(i, *d) for i, d in enumerate(data)], "i int, n string, c string").orderBy("i")
    assert [r[0] for r in df.select(mappings.bloc_of("n", "c")).collect()] == [
        "Gauche", "Centre", "Centre", "ExtremeDroite", "Gauche", "Centre",
        "ExtremeDroite", "Divers", "Divers", "Divers", "Divers", "Divers", "Divers",
    ]
    assert [r[0] for r in df.select(mappings.bloc_of("n", "c", "pilot")).collect()] == [
        "Gauche", "Droite", "Divers", "Divers", "Divers", "Divers",
        "ExtremeDroite", "ExtremeDroite", "Droite", "Divers", "Divers", "Divers", "Divers",
    ]


def test_contains_rule_takes_the_first_rule(spark):
    data = ["ROYAL MACRON", "LE", "HUE-LE PEN", "XYZ"]
    # "LE" lies inside MELENCHON, which comes before LE PEN.
    assert values(spark, data, mappings.contains_rule("v")) == ["Gauche", "Gauche", "Gauche", None]


def test_arg_max_takes_the_first_of_a_tie(spark):
    df = spark.createDataFrame([(1.0, 2.0, 2.0), (3.0, 3.0, 3.0), (0.0, 0.0, 1.0), (None, None, None)], "a double, b double, c double")
    got = df.select(mappings.arg_max_label(["a", "b", "c"], ["A", "B", "C"])).collect()
    assert [r[0] for r in got] == ["B", "A", "C", None]


def test_territory(spark):
    data = [None, 0.0, 1999.0, 2000.0, 9999.0, 10000.0]
    assert values(spark, data, territory.territory_type("v"), "double") == [
        "rural", "rural", "rural", "periurbain", "periurbain", "urbain",
    ]
    assert values(spark, [49.0, 50.0, 1500.0], territory.territory_type("v", "density"), "double") == ["rural", "periurbain", "urbain"]
    assert values(spark, ["rural", "periurbain", "urbain", "x", None], territory.territory_rank("v")) == [0, 1, 2, 0, 0]


def test_poverty_rule(spark):
    n = 20000.0
    line = 12000.0
    data = [
        (None, 0.3, None),
        (line - 1, 0.30, 35 + (0.30 - 0.25) * 80),
        (line, 0.30, (-5 + (0.30 - 0.20) * 100) * 1.4),
        (18000.0, 0.30, -5 + (0.30 - 0.20) * 100),
        (26000.0, 0.30, (-5 + (0.30 - 0.20) * 100) * 0.6),
        (18000.0, 0.10, 0.0),
        (1000.0, 0.90, 50.0),
        (0.8 * line - 1, None, 40.0),
        (0.8 * line, None, 40.0),
        (0.9 * line, None, 32.5),
        (line, None, 15.0),
        (0.9 * n, None, 10.0),
        (1.1 * n, None, 6.0),
        (1.3 * n, None, 3.0),
    ]
    df = spark.createDataFrame([(i, m, g) for i, (m, g, _) in enumerate(data)], "i int, m double, g double").orderBy("i")
    got = [r[0] for r in df.select(poverty.poverty_rate("m", "g", n)).collect()]
    for have, (_, _, want) in zip(got, data):
        assert (have is None and want is None) or abs(have - want) < 1e-9
    levels = [r[0] for r in df.select(poverty.poverty_level("m", "g")).collect()]
    assert levels == [3] + [1] * 6 + [2] * 7
    fixed = df.where("i = 7").select(poverty.poverty_rate("m", "g")).first()[0]
    assert fixed == 40.0


def test_poverty_with_a_scalar_subquery(spark):
    df = spark.createDataFrame([(10000.0, None), (30000.0, 0.3)], "m double, g double")
    median = df.agg(F.median("m")).scalar()
    assert [r[0] for r in df.select(poverty.poverty_rate("m", "g", median, 1)).collect()] == [37.5, 3.0]

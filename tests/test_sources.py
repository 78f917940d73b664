import os

import pytest
from pyspark.sql import functions as F

from mairie.operators import harmonise as h
from mairie.plans import silver
from mairie.sources import delimited, tables
from mairie.sources.schemas import table_schema
from mairie.streaming.append import append_new_files


def write(path, text):
    path.write_text(text, encoding="utf-8")
    return str(path)


def test_delimited_scan_keeps_text(spark, tmp_path, rows):
    path = write(tmp_path / "a.csv", 'code;nom;v\n01001;"A; ""b""";007\n2A004;é;\n')
    df = delimited.scan_delimited(spark, path)
    assert [t for _, t in df.dtypes] == ["string"] * 3
    assert rows(df) == [("01001", 'A; "b"', "007"), ("2A004", "é", None)]
    assert delimited.peek(df, 1)[0] == ["code", "nom", "v"]


def test_first_line_of_a_key_stays_however_the_file_is_split(spark, tmp_path, rows):
    lines = ["GEO;TIME_PERIOD;OBS_VALUE;EC_MEASURE"]
    lines += [f"{k};2020;{1000 - i};LVB" for i in range(400) for k in ("1", "2")]
    path = write(tmp_path / "n.csv", "\n".join(lines) + "\n")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        raw = delimited.with_file_order(delimited.scan_delimited(spark, path))
        assert raw.rdd.getNumPartitions() > 5
        got = silver.vital_events(raw, None, "nb_naissances", ["LVB"])
        assert rows(got) == [("00001", 2020, 1000), ("00002", 2020, 1000)]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_sheet_ingest(spark, tmp_path, rows):
    notes = "".join(f"note {i};;\n" for i in range(14)) + "\n"
    path = write(tmp_path / "s.csv", notes + "DR;CR;csx_rec1taxtypac_rec1rpop2022\n2a;4;12.5\n1;001;x\nTotal;;99\n")
    raw = delimited.scan_sheet(spark, path, "DR")
    out = silver.occupations(raw)
    assert rows(out, "code_commune", "annee", "ouvriers_chomeurs") == [("01001", 2022, None), ("2A004", 2022, None)]
    assert float(out.where("code_commune = '2A004'").first()["agriculteurs_emploi"]) == 12.5
    with pytest.raises(ValueError):
        delimited.scan_sheet(spark, path, "CODGEO")


def test_files_of_a_folder_with_headers_of_their_own(spark, tmp_path, rows):
    folder = tmp_path / "in put[1]"
    folder.mkdir()
    (folder / "a b.csv").write_bytes("code|nom|v|v\n1|été|x|y\n2|\"a|b\"||\n".encode("latin-1"))
    (folder / "c{2}.csv").write_bytes("nom|autre|code\nîle|7|3\n".encode("latin-1"))
    (folder / "d.csv").write_bytes("code|nom|v|v\n4||z|\n".encode("latin-1"))
    (folder / "empty.csv").write_bytes(b"")
    escaped = str(folder).replace("[", "\\[").replace("]", "\\]")
    found = delimited.headers(spark, escaped, "|", "ISO-8859-1")
    assert sorted(len(f) for f in found.values()) == [1, 2]
    df = delimited.scan_folder(spark, escaped, "|", "ISO-8859-1", order="place")
    want = [("1", "été", "x", "y", None), ("2", "a|b", None, None, None), ("3", "île", None, None, "7"), ("4", None, "z", None, None)]
    assert rows(df, "code", "nom", "v2", "v3", "autre") == want and "place" in df.columns
    with pytest.raises(ValueError):
        (tmp_path / "none").mkdir()
        write(tmp_path / "none" / "x.csv", "")
        delimited.scan_folder(spark, str(tmp_path / "none"))


def test_sheets_with_headers_of_their_own(spark, tmp_path, rows):
    folder = tmp_path / "sheets"
    folder.mkdir()
    (folder / "a.csv").write_bytes("Tableau étendu\n\nCODGEO,v,\n01001,1,\nTotal,9,\n".encode("latin-1"))
    (folder / "b.csv").write_bytes("x,y\r\n \r\n\"w\",\"CODGEO\",v\r\né,2A004,2\r\n".encode("latin-1"))
    sheet = delimited.scan_sheet(spark, str(folder), "CODGEO", sep=",", encoding="ISO-8859-1", order="place")
    assert rows(sheet, "CODGEO", "v", "w") == [("01001", "1", None), ("2A004", "2", "é")] and "place" in sheet.columns
    # A line of notes holds the marker as part of a cell only; a file without header is refused among several.
    write(folder / "c.csv", "CODGEO below,\n")
    with pytest.raises(ValueError):
        delimited.scan_sheet(spark, str(folder), "CODGEO", sep=",")


def test_aliases_keep_the_first_in_file_order(spark, rows):
    df = spark.createDataFrame([("1", "Upper", "Label", "75")], "com string, NCC string, LIBELLE string, Dep string")
    named = h.rename_aliases(df, h.REFERENTIAL_ALIASES)
    assert named.columns == ["code_insee", "libelle", "code_dep"]
    assert rows(named) == [("1", "Upper", "75")]


def test_column_discovery():
    columns = ["Code géographique", "[DISP] Médiane (€)", "[DISP] Gini", "[DEC] Médiane (€)", "[DISP] 1er quartile (€)", "[DISP] D1"]
    assert h.find_all_keywords(columns, ["DISP", "DIAN"], ["DISP", "MEDI"]) == "[DISP] Médiane (€)"
    assert h.find_all_keywords(columns, ["DISP", "QUARTILE", "1"], ["DISP", "D1"]) == "[DISP] 1er quartile (€)"
    assert h.find_all_keywords(columns, ["DISP", "PAUV"]) is None
    assert h.find_any_keyword(["D1 2019", "D5 2018", "MED 2019"], ["D5", "MED"], "2019") == "MED 2019"
    assert h.find_key_column(columns) == "Code géographique"
    assert h.find_key_column(["Nom géographique", "CODGEO"]) == "CODGEO"
    assert h.find_key_column(["Nom géographique", "x"], "pilot") == "Nom géographique"
    assert h.find_key_column(["a", "b", "c"]) == "b" and h.find_key_column(["a", "b"], "pilot") == "a"


def test_wide_to_long(spark, rows):
    df = spark.createDataFrame([("1", "10,5", "0,3", "11")], "code string, `D5 2019` string, `GINI 2019` string, `D5 2020` string")
    assert rows(h.wide_to_long(df, ["code"]), "code", "annee", "mediane_revenu_disp", "gini") == [
        ("1", 2019, 10.5, 0.3), ("1", 2020, 11.0, None),
    ]
    none = h.wide_to_long(df.select("code"), ["code"])
    assert rows(none, "code", "annee", "mediane_revenu_disp") == [("1", 2022, None)]


def test_typed_schema_rounds_halves_away_from_zero(spark):
    df = spark.createDataFrame([("1", 2000, 12.5)], "code_commune string, annee int, nb_naissances double")
    row = h.enforce_schema(df, table_schema("naissances")).first()
    assert (row["annee"], row["nb_naissances"]) == (2000, 13)
    share = spark.createDataFrame([(1.0005,)], "pct_gauche double")
    assert str(h.enforce_schema(share, table_schema("features_communes")).first()["pct_gauche"]) == "1.001"


def test_tables_round_trip(spark, tmp_path, rows):
    df = spark.createDataFrame([("a", "pres", 2002), ("b", "legi", 2007), ("c", None, 2007)], "k string, type_election string, annee smallint")
    path = str(tmp_path / "t")
    stored = tables.write_table(df, path, ["type_election", "annee"])
    assert stored.schema["annee"].dataType.simpleString() == "smallint"
    assert rows(stored) == rows(df)
    pruned = tables.scan_table(spark, path, ["k"], "type_election = 'pres'")
    assert "PartitionFilters: [isnotnull(type_election" in pruned._jdf.queryExecution().executedPlan().toString()
    again = tables.write_table(df.where("k = 'a'"), path, ["type_election", "annee"])
    assert again.count() == 1


def test_keyed_update(spark, rows):
    df = spark.createDataFrame([("a", 1.0), ("b", None), ("c", 3.0)], "k string, v double")
    new = spark.createDataFrame([("a", 9.0), ("b", 8.0), ("z", 7.0)], "k string, v double")
    assert rows(tables.update_by_key(df, new, ["k"], "v")) == [("a", 9.0), ("b", 8.0), ("c", 3.0)]


def test_streamed_append_reads_each_file_once(spark, tmp_path, rows):
    folder = tmp_path / "in"
    os.makedirs(folder)
    target, checkpoint = str(tmp_path / "out"), str(tmp_path / "state")
    head = "code_commune;id_election;nuance;voix\n"
    known = silver.referential(
        spark.createDataFrame([("1001", "A", "1")], "COM string, LIBELLE string, DEP string"), ["01"]
    )
    write(folder / "a.csv", head + "1001;2022_pres_t1;SOC;12\n9999;2022_pres_t1;SOC;5\n")
    load = lambda: append_new_files(spark, str(folder), target, checkpoint, lambda df: silver.elections(df, known))
    assert rows(load(), "code_commune", "annee", "nb_voix") == [("01001", 2022, 12)]
    assert load().count() == 1
    write(folder / "b.csv", head + "01001;2017_pres_t2;LR;x\n")
    assert rows(load(), "code_commune", "annee", "tour", "nb_voix") == [("01001", 2017, 2, None), ("01001", 2022, 1, 12)]


def test_catalogue_entries_and_layers(spark, tmp_path, rows):
    from mairie.operators.quality import layer_tables

    df = spark.createDataFrame([("a", "pres", 2002), ("b", "legi", 2007)], "k string, type_election string, annee smallint")
    spark.sql(f"CREATE DATABASE silver_test LOCATION '{tmp_path}/db'")
    try:
        for name in ("un", "deux"):
            path = str(tmp_path / name)
            tables.write_table(df, path, ["type_election", "annee"])
            tables.register_table(spark, f"silver_test.{name}", path)
        tables.register_table(spark, "silver_test.un", str(tmp_path / "un"))
        assert rows(spark.sql("select k from silver_test.un where annee = 2007")) == [("b",)]
        assert rows(layer_tables(spark, ["silver_test"])) == [("silver_test", 2)]
    finally:
        spark.sql("DROP DATABASE silver_test CASCADE")
    assert (tmp_path / "un").exists()


def test_named_departments(spark, rows):
    ref = spark.createDataFrame([("75056", "P", "75"), ("92012", "B", "92"), ("13055", "M", "13")], "code_insee string, libelle string, code_dep string")
    assert rows(silver.named_departments(ref), "nom_departement") == [("13",), ("Hauts-de-Seine",), ("Paris",)]


class _Context:
    def __init__(self, master, folder=None):
        self.master, self.folder = master, folder

    def getCheckpointDir(self):
        return self.folder

    def setCheckpointDir(self, path):
        self.folder = path


class _Session:
    def __init__(self, master, named=None, folder=None):
        self.sparkContext = _Context(master, folder)
        self.conf = {"spark.checkpoint.dir": named} if named else {}


def test_shared_folder_choice():
    from mairie.session import shared_dir

    assert shared_dir(_Session("yarn", named="hdfs://x/y/")) == "hdfs://x/y"
    assert shared_dir(_Session("yarn", folder="hdfs://x/z")) == "hdfs://x/z"
    local = _Session("local[2]")
    assert shared_dir(local) == shared_dir(local)
    with pytest.raises(RuntimeError):
        shared_dir(_Session("yarn"))


def test_every_catalogue_table_is_checked_before_it_is_published(spark, tmp_path):
    from mairie.sources import published
    from mairie.sources.schemas import KEYS, REQUIRED

    assert len(KEYS) == 8
    for name in {*KEYS, *REQUIRED}:
        schema, path = table_schema(name), str(tmp_path / name)
        values = [F.lit("x" if f.dataType.simpleString() == "string" else 1).cast(f.dataType).alias(f.name) for f in schema]
        one = spark.range(1).select(*values)
        assert tables.create_table(one, name, path).count() == 1
        wrong = [one.union(one)] if name in KEYS else []
        wrong += [one.withColumn(c, F.lit(None).cast(schema[c].dataType)) for c in REQUIRED.get(name, ())]
        for df in wrong:
            with pytest.raises(published.LoadRefused):
                tables.create_table(df, name, path)
            assert tables.scan_table(spark, path).count() == 1

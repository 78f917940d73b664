import pytest
from pyspark.sql import functions as F

from mairie.catalogue.adapters import Tables


@pytest.fixture()
def folder(spark, tmp_path):
    tables = {
        "customer": ("c_custkey bigint, c_acctbal double", [(1, 10.0), (2, 20.5), (151, None)]),
        "part": ("p_partkey bigint, p_type string", [(1, "LARGE"), (2, "SMALL"), (2, "SMALL"), (3, None)]),
        "orders": (
            "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_orderdate date, o_orderpriority string",
            [(1, 1, "F", "1996-01-02", "1-URGENT"), (2, 151, None, "2001-03-04", None), (3, None, "O", None, "5-LOW"), (3, 2, "O", "2001-05-06", "5-LOW")],
        ),
        "lineitem": (
            "l_orderkey bigint, l_partkey bigint, l_linenumber int, l_quantity double, l_returnflag string",
            [(1, 1, 1, 5.0, "R"), (1, 2, 4, 7.0, "A"), (2, 1, 6, None, None), (3, 3, None, 2.0, "N"), (3, None, 2, 3.0, "R"), (None, 1, 1, 9.0, "R")],
        ),
        "events": ("event_id bigint, user_id bigint, event_type string, ts timestamp", []),
        "documents": ("doc_id bigint", [(1,)]),
        "labels": ("doc_id bigint, quality int, toxic int", [(1, 0, 1)]),
    }
    for name, (schema, rows) in tables.items():
        plain = spark.createDataFrame(rows, schema.replace(" date", " string"))
        if name == "orders":
            plain = plain.withColumn("o_orderdate", F.col("o_orderdate").cast("date"))
        plain.write.parquet(f"{tmp_path}/{name}.parquet")
    return str(tmp_path)


def test_silver_tables_share_one_join_of_orders_and_lines(spark, rows, folder, monkeypatch):
    alone = Tables(spark, folder)
    want = [rows(alone.build_elections()), rows(alone.build_occupations()), rows(alone.build_typology())]
    schema = alone.build_elections().schema
    joins, lines = [], Tables.lines
    monkeypatch.setattr(Tables, "lines", lambda self: joins.append(1) or lines(self))
    t = Tables(spark, folder)
    t.store_silver()
    assert [rows(t.elections()), rows(t.occupations()), rows(t.typology())] == want
    assert [(f.name, f.dataType) for f in t.elections().schema] == [(f.name, f.dataType) for f in schema]
    assert len(joins) == 1

"""Published tables: nothing is visible before its checks, nothing is counted twice, little is rewritten."""

import os

import pytest
from pyspark.sql import functions as F

from mairie.sources import published as p
from mairie.sources.delimited import scan_delimited


def table(spark, data):
    return spark.createDataFrame(data, "k string, kind string, year smallint, v int")


DATA = [("a", "pres", 2002, 1), ("b", "pres", 2007, 2), ("c", "legi", 2007, 3), ("d", None, 2007, 4), ("e", "legi", None, None)]
BY = ["kind", "year"]


def files(root):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, names in os.walk(root) for f in names if f.endswith(".parquet")}


def test_refused_load_leaves_the_table(spark, tmp_path, rows):
    root = str(tmp_path / "t")
    with pytest.raises(FileNotFoundError):
        p.scan(spark, root)
    df = table(spark, DATA)
    stored = p.refresh(df, root, BY, keys=["k"], required=["k"], rules={"v positive": F.col("v").isNull() | (F.col("v") > 0)}, min_rows=5)
    assert rows(stored) == rows(df) and stored.schema == df.schema
    seen = files(root)
    bad = [
        (table(spark, [*DATA, ("a", "pres", 2002, 9)]), "more than one row"),
        (table(spark, [(None, "pres", 2002, 1)] * 5), "5 nulls in k"),
        (table(spark, [("x", "pres", 2002, -1), *DATA]), "1 rows break 'v positive'"),
        (table(spark, DATA[:3]), "3 rows instead of 5"),
    ]
    for wrong, message in bad:
        with pytest.raises(p.LoadRefused, match=message):
            p.refresh(wrong, root, BY, keys=["k"], required=["k"], rules={"v positive": F.col("v").isNull() | (F.col("v") > 0)}, min_rows=5)
        assert rows(p.scan(spark, root)) == rows(df) and files(root) == seen
    failing = df.withColumn("v", F.when(F.col("k") == "c", F.raise_error(F.lit("lost"))).otherwise(F.col("v")).cast("int"))
    with pytest.raises(Exception, match="lost"):
        p.refresh(failing, root, BY)
    assert rows(p.scan(spark, root)) == rows(df) and files(root) == seen

    kept = p.scan(spark, root)  # a reader that began before the next load
    again = p.refresh(df.where("k = 'a'"), root, BY)
    assert rows(again) == [("a", "pres", 2002, 1)] and rows(kept) == rows(df)
    assert len(p.vacuum(spark, root)) == 1 and rows(p.scan(spark, root)) == [("a", "pres", 2002, 1)]


def test_concurrent_load_is_refused(spark, tmp_path, rows):
    root, df = str(tmp_path / "t"), table(spark, DATA)
    p.refresh(df, root)
    stale = p.manifest(spark, root)
    p.refresh(df.where("v = 2"), root)
    with pytest.raises(p.LoadRefused, match="another load"):
        p._publish(spark, root, stale, stale)
    assert rows(p.scan(spark, root)) == [("b", "pres", 2007, 2)]


def test_partitions_are_pruned_and_nothing_is_shuffled(spark, tmp_path):
    root, df = str(tmp_path / "t"), table(spark, DATA).repartition(3)
    stored = p.refresh(df, root, BY).where("kind = 'pres'")
    plan = stored._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(kind" in plan and "Exchange" not in plan


def test_few_small_files_stay(spark, tmp_path):
    root = str(tmp_path / "t")
    p.refresh(table(spark, DATA * 20).repartition(3), root, BY)
    assert len(files(root)) > 4
    p.refresh(table(spark, DATA * 400).repartition(40), root, BY)
    p.vacuum(spark, root)
    assert len(files(root)) <= 4 * (p.SPARE_FILES + 1)


def test_small_files_are_joined_and_others_left(spark, tmp_path, rows, monkeypatch):
    monkeypatch.setattr(p, "SPARE_FILES", 0)
    rows_ = spark.range(40_000).selectExpr("cast(id as string) k", "if(id % 4 = 0, 'pres', 'legi') kind", "cast(2000 + id % 2 as smallint) year", "cast(xxhash64(id) % 100000 as int) v")
    spread, root = rows_.repartition(12), str(tmp_path / "t")
    size = 100_000
    stored = p.refresh(spread, root, BY, file_bytes=size)
    count = {}
    for path in files(root):
        count.setdefault(os.path.dirname(path), []).append(os.path.getsize(path))
    assert set(map(len, count.values())) < set(range(1, 9))
    assert all(len(v) <= -(-sum(v) // (size // 2)) + 1 for v in count.values())
    assert rows(stored.groupBy("kind", "year").agg(F.count("k"), F.sum("v"))) == rows(rows_.groupBy("kind", "year").agg(F.count("k"), F.sum("v")))
    assert [d for d in os.listdir(root) if "joined" in d] == []
    before = files(root)
    assert p.join_small_files(spark, root, rows_.select("k", "v").schema, 2_000) == 0 and files(root) == before


def write(path, lines):
    path.write_text("\n".join(lines) + "\n", encoding="utf-8")


def test_append_counts_each_file_once(spark, tmp_path, rows):
    folder, root = tmp_path / "in", str(tmp_path / "t")
    folder.mkdir()
    typed = lambda paths: scan_delimited(spark, paths).selectExpr("k", "kind", "cast(v as int) v")
    load = lambda: p.append_files(spark, root, str(folder), typed, ["kind"], required=["k"])
    with pytest.raises(p.LoadRefused, match="no file"):
        load()
    write(folder / "a.csv", ["k;kind;v", "a;pres;1", "b;legi;2"])
    write(folder / "_hidden.csv", ["k;kind;v", "z;z;9"])
    first = [("a", 1, "pres"), ("b", 2, "legi")]
    assert rows(load(), "k", "v", "kind") == first and rows(load(), "k", "v", "kind") == first
    write(folder / "b.csv", ["k;kind;v", "c;pres;3"])
    assert rows(load(), "k", "v", "kind") == [*first, ("c", 3, "pres")]
    assert p.manifest(spark, root)["rows"] == 3

    write(folder / "c.csv", ["kind;k;v", "pres;d;4"])
    write(folder / "d.csv", ["k;kind;v", "e;pres;5"])
    with pytest.raises(Exception):
        load().count()  # two headers in one batch
    (folder / "c.csv").unlink()
    write(folder / "d.csv", ["k;kind;v", ";pres;5"])
    with pytest.raises(p.LoadRefused, match="1 nulls in k"):
        load()
    write(folder / "d.csv", ["k;kind;v", "e;pres;5"])
    assert load().count() == 4
    write(folder / "a.csv", ["k;kind;v", "a;pres;100"])
    with pytest.raises(p.LoadRefused, match="changed since"):
        load()
    with pytest.raises(p.LoadRefused, match="other columns"):
        p.append_files(spark, root, str(tmp_path / "other"), lambda paths: typed(paths).drop("v"), ["kind"]) if write_other(tmp_path) else None


def write_other(tmp_path):
    (tmp_path / "other").mkdir()
    write(tmp_path / "other" / "x.csv", ["k;kind;v", "x;pres;1"])
    return True


def test_cut_off_append_is_done_again(spark, tmp_path, rows, monkeypatch):
    folder, root = tmp_path / "in", str(tmp_path / "t")
    folder.mkdir()
    write(folder / "a.csv", ["k;v", "a;1"])
    load = lambda: p.append_files(spark, root, str(folder), lambda paths: scan_delimited(spark, paths))
    with monkeypatch.context() as patched:
        patched.setattr(p, "_replace_text", lambda *a: (_ for _ in ()).throw(OSError("cut off")))
        with pytest.raises(OSError):
            load()
    assert p.manifest(spark, root) is None and rows(load()) == [("a", "1")]


def test_update_rewrites_changed_partitions_only(spark, tmp_path, rows):
    root, df = str(tmp_path / "t"), table(spark, DATA)
    p.refresh(df, root, BY)
    before = files(root)
    new = spark.createDataFrame([("b", 20), ("d", None), ("nobody", 1)], "k string, v int")
    got = p.update(spark, root, new, ["k"], "v")
    want = [("a", "pres", 2002, 1), ("b", "pres", 2007, 20), ("c", "legi", 2007, 3), ("d", None, 2007, None), ("e", "legi", None, None)]
    assert rows(got) == rows(table(spark, want))
    after = files(root)
    assert all(after[f] == t for f, t in before.items()) and len(after) - len(before) == 2
    got = p.update(spark, root, spark.createDataFrame([("b", 21), ("e", 5)], "k string, v int"), ["k"], "v")
    assert rows(got.where("k in ('b', 'e')"), "k", "v") == [("b", 21), ("e", 5)] and got.count() == 5
    assert rows(p.update(spark, root, new.where("k = 'nobody'"), ["k"], "v")) == rows(got)
    with pytest.raises(p.LoadRefused, match="more than one row"):
        p.update(spark, root, new.union(new), ["k"], "v")
    with pytest.raises(p.LoadRefused, match="belongs"):
        p.update(spark, root, new.select("k", F.lit("x").alias("kind")), ["k"], "kind")
    p.vacuum(spark, root)
    assert p.scan(spark, root).count() == 5


def test_update_of_a_table_without_partitions(spark, tmp_path, rows):
    root = str(tmp_path / "t")
    p.refresh(table(spark, DATA), root)
    got = p.update(spark, root, spark.createDataFrame([("a", 7)], "k string, v int"), ["k"], "v")
    assert rows(got.where("k = 'a'"), "v") == [(7,)] and got.count() == 5 and len(p.manifest(spark, root)["parts"]) == 1


def test_empty_tables_and_listing(spark, tmp_path, rows):
    out, df = str(tmp_path / "out"), table(spark, DATA)
    assert p.refresh(df.limit(0), f"{out}/silver/none", BY).count() == 0
    p.refresh(df, f"{out}/gold/five", BY)
    assert rows(p.listed(spark, out, ["silver", "gold", "absent"])) == [("gold", "five", 5), ("silver", "none", 0)]

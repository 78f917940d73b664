"""Run registered queries beside their SQL counterparts in DuckDB and compare every cell.

``python tests/oracle.py [--sf 0.01] [name prefix ...]``
"""

from __future__ import annotations

import argparse
import os
import sys
import time
from decimal import Decimal

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{folder}/{t}.parquet'")
    return con


def _kind(value):
    if value is None:
        return "0"
    if isinstance(value, bool):
        return f"b{value}"
    if isinstance(value, float):
        return f"f{value!r}"
    if isinstance(value, Decimal):
        return f"d{value.normalize() + 0:f}"
    return f"{type(value).__name__}{value}"


def canonical(table) -> tuple[list[str], list[str], list[tuple]]:
    names = sorted(table.column_names)
    table = table.select(names)
    types = [str(f.type).replace("large_", "") for f in table.schema]
    columns = [[_kind(v) for v in table.column(n).to_pylist()] for n in names]
    return names, types, sorted(zip(*columns)) if columns else []


def compare(spark_table, duck_table) -> str | None:
    """None when equal, else a short description of the first difference."""
    n1, t1, r1 = canonical(spark_table)
    n2, t2, r2 = canonical(duck_table)
    if n1 != n2:
        return f"columns {n1} != {n2}"
    if t1 != t2:
        return f"types {[x for x in zip(n1, t1, t2) if x[1] != x[2]]}"
    if len(r1) != len(r2):
        return f"rows {len(r1)} != {len(r2)}"
    bad = [(a, b) for a, b in zip(r1, r2) if a != b]
    return f"{len(bad)} rows differ, first {bad[0]}" if bad else None


def run_oracle(con, sql):
    return con.sql(sql).to_arrow_table()


def main():
    parser = argparse.ArgumentParser()
    parser.add_argument("--sf", default="0.01")
    parser.add_argument("names", nargs="*")
    args = parser.parse_args()
    from mairie.session import build_session

    spark = build_session(
        master="local[8]",
        **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "16g", "spark.ui.enabled": "false"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    import __spark_entry__ as entry

    folder = f"/root/testdata/sf{args.sf}"
    con, oracles, failed = connect(folder), entry.oracle_sql(), []
    for name, fn in entry.queries().items():
        if args.names and not any(name.startswith(p) for p in args.names):
            continue
        start = time.time()
        try:
            got = fn(spark, folder).toArrow()
            took = time.time() - start
            problem = compare(got, run_oracle(con, oracles[name])) if name in oracles else None
            state = "ok" if problem is None else "DIFF " + problem
            state += "" if name in oracles else f" (rows only: {got.num_rows})"
        except Exception as e:  # noqa: BLE001
            took, problem = time.time() - start, e
            state = f"ERROR {str(e).splitlines()[0][:300]}"
        if problem is not None:
            failed.append(name)
        print(f"{took:6.2f}s {name}: {state[:600]}", flush=True)
    print("failed:", failed)


if __name__ == "__main__":
    main()

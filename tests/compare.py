"""Run registered queries next to their DuckDB text and compare values.

Usage: python tests/compare.py [--sf DIR] [--only NAME,NAME] [--module MODULE]
"""

from __future__ import annotations

import argparse
import datetime as dt
import decimal
import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()


def duck(sf_dir: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def norm(value):
    if isinstance(value, decimal.Decimal):
        value = float(value)
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(round(value, 9) + 0.0)
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat(sep=" ")
    if isinstance(value, bool) or value is None:
        return str(value)
    return str(value)


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(names), sorted(tuple(norm(r[i]) for i in order) for r in rows)


def spark_rows(df):
    rows = [tuple(r) for r in df.collect()]
    return rows_of(df.columns, rows), df.dtypes


def duck_rows(con, sql):
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    types = [str(d[1]) for d in cursor.description]
    return rows_of(names, cursor.fetchall()), list(zip(names, types))


def compare(df, con, sql):
    """None if equal, else a short description of the difference."""
    (names, got), got_types = spark_rows(df)
    (want_names, want), want_types = duck_rows(con, sql)
    if names != want_names:
        return f"columns {names} != {want_names}", len(got)
    if got != want:
        a, b = set(got) - set(want), set(want) - set(got)
        return f"rows {len(got)} vs {len(want)}; only spark {sorted(a)[:3]}; only duckdb {sorted(b)[:3]}", len(got)
    kinds = {"bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN", "int": "INTEGER"}
    odd = [(n, t, dict(want_types)[n]) for n, t in got_types
           if kinds.get(t) and dict(want_types)[n] not in (kinds[t], "STRING" if t == "string" else kinds[t], "NUMBER")]
    return (f"types {odd}" if odd else None), len(got)


def main():
    parser = argparse.ArgumentParser()
    parser.add_argument("--sf", default="/root/testdata/sf0.01")
    parser.add_argument("--only", default="")
    parser.add_argument("--module", default="")
    args = parser.parse_args()
    from importlib import import_module

    from reviewmill import catalog
    from reviewmill.session import build_session

    spark = build_session("compare", "local[8]", spark__sql__shuffle__partitions="8", spark__driver__memory="8g")
    spark.sparkContext.setLogLevel("ERROR")
    if args.module:
        names = []
        for m in args.module.split(","):
            names += list(import_module(f"reviewmill.catalog.{m}").QUERIES)
        catalog.MODULES = tuple(args.module.split(","))
    queries, oracles = catalog.all_queries(), catalog.all_oracles()
    names = [n for n in queries if not args.only or n in args.only.split(",")]
    con = duck(args.sf)
    bad = 0
    for name in names:
        started = time.time()
        try:
            df = queries[name](spark, args.sf)
            if name in oracles:
                problem, count = compare(df, con, oracles[name])
                verdict = "OK" if problem is None else f"DIFF {problem}"
            else:
                count, verdict = len(df.collect()), "ROWS"
        except Exception as error:  # noqa: BLE001
            count, verdict = -1, f"FAIL {type(error).__name__}: {str(error)[:1500]}"
        bad += verdict.startswith(("DIFF", "FAIL"))
        print(f"{name:32s} {time.time() - started:6.1f}s rows={count:7d} {verdict}", flush=True)
    print("problems:", bad)
    spark.stop()
    return bad


if __name__ == "__main__":
    sys.exit(1 if main() else 0)

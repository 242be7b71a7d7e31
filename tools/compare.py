"""Run registered queries next to their SQL: python tools/compare.py [--sf DIR] [name prefix ...]"""

from __future__ import annotations

import argparse
import importlib.util
import math
import sys
import time
from pathlib import Path

import duckdb
from pyspark.sql import SparkSession

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def load_entry():
    spec = importlib.util.spec_from_file_location("spark_entry", ROOT / "__spark_entry__.py")
    module = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(module)
    return module


def plain(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return None
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    if isinstance(value, float):
        return value + 0.0
    return value


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    named = [columns[i] for i in order]
    return named, sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


def kinds(columns, rows):
    found = {c: set() for c in columns}
    for r in rows:
        for c, v in zip(columns, r):
            if v is not None:
                found[c].add(type(v).__name__)
    return found


def compare(spark, con, fn, sql, sf):
    started = time.time()
    df = fn(spark, sf)
    names, rows = canonical(df.columns, [tuple(r) for r in df.collect()])
    seconds = time.time() - started
    if sql is None:
        return "ROWS" if rows else "EMPTY", f"{len(rows)} rows", seconds
    cur = con.execute(sql)
    other_names, other = canonical([d[0] for d in cur.description], cur.fetchall())
    if names != other_names:
        return "COLUMNS", f"{names} != {other_names}", seconds
    if len(rows) != len(other):
        return "COUNT", f"{len(rows)} != {len(other)}", seconds
    if rows != other:
        bad = [(a, b) for a, b in zip(rows, other) if a != b]
        a, b = bad[0]
        diff = {n: (x, y) for n, x, y in zip(names, a, b) if x != y}
        return "VALUES", f"{len(bad)} of {len(rows)} rows, first {diff}", seconds
    mine, theirs = kinds(names, rows), kinds(names, other)
    mixed = {c: (mine[c], theirs[c]) for c in names if mine[c] != theirs[c]}
    if mixed:
        return "TYPES", str(mixed), seconds
    return ("OK" if rows else "EMPTY"), f"{len(rows)} rows", seconds


def main():
    parser = argparse.ArgumentParser()
    parser.add_argument("--sf", default="/root/testdata/sf0.01")
    parser.add_argument("prefix", nargs="*")
    args = parser.parse_args()
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{args.sf}/{t}.parquet'")
    entry = load_entry()
    queries, oracles = entry.queries(), entry.oracle_sql()
    failed = 0
    for name, fn in queries.items():
        if args.prefix and not any(name == p or name.startswith(p + "_") for p in args.prefix):
            continue
        try:
            status, note, seconds = compare(spark, con, fn, oracles.get(name), args.sf)
        except Exception as error:  # noqa: BLE001 - reported per query
            status, note, seconds = "ERROR", f"{type(error).__name__}: {str(error)[:600]}", 0.0
        failed += status not in ("OK", "ROWS")
        print(f"{status:8s} {name:36s} {seconds:6.1f}s  {note}", flush=True)
    print(f"{failed} failed")
    spark.stop()
    sys.exit(1 if failed else 0)


if __name__ == "__main__":
    main()

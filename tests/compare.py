"""Run registered queries next to their SQL on DuckDB and compare all rows.

    python -m tests.compare [--sf DIR] [key ...]
"""

from __future__ import annotations

import argparse
import math
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import duckdb

import __spark_entry__ as entrypoint
from larderspark.plans.fixtures import TABLES


def connection(sf_dir: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def plain(value):
    if value is None or isinstance(value, float) and math.isnan(value):
        return None
    if isinstance(value, bool):
        return int(value)
    if isinstance(value, float):
        return value
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    if hasattr(value, "item"):
        return plain(value.item())
    return value


def table_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(plain(r[i]) for i in order) for r in rows]
    return [columns[i] for i in order], sorted(out, key=repr)


TYPES = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "float": "FLOAT", "string": "VARCHAR",
    "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP", "timestamp": "TIMESTAMP",
}


def type_differences(schema, description):
    want = {d[0]: str(d[1]) for d in description}
    have = {f.name: TYPES.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in schema}
    return [(n, have[n], want[n]) for n in have if want.get(n) != have[n]]


def compare(spark, con, key, sf_dir, inspect=None):
    """'' when equal, else what differs; plus seconds and row count."""
    started = time.time()
    df = entrypoint.queries()[key](spark, sf_dir)
    if inspect is not None:
        inspect(df)
    names, rows = table_rows(df.columns, df.collect())
    seconds = time.time() - started
    sql = entrypoint.oracle_sql().get(key)
    if sql is None:
        return "", seconds, len(rows), False
    result = con.execute(sql)
    types = type_differences(df.schema, result.description)
    want_names, want = table_rows([d[0] for d in result.description], result.fetchall())
    if names != want_names:
        return f"columns {names} != {want_names}", seconds, len(rows), True
    if len(rows) != len(want):
        return f"rows {len(rows)} != {len(want)}", seconds, len(rows), True
    bad = [(a, b) for a, b in zip(rows, want) if a != b]
    if bad:
        a, b = bad[0]
        cells = [(n, x, y) for n, x, y in zip(names, a, b) if x != y]
        return f"{len(bad)} rows differ, first {cells!r}"[:1500], seconds, len(rows), True
    return (f"types (name, spark, duckdb): {types}" if types else ""), seconds, len(rows), True


def main() -> int:
    parser = argparse.ArgumentParser()
    parser.add_argument("keys", nargs="*")
    parser.add_argument("--sf", default="/root/testdata/sf0.01")
    parser.add_argument("--cpus", type=int, default=8)
    args = parser.parse_args()
    from larderspark.session import local_session

    spark = local_session(args.cpus)
    con = connection(args.sf)
    failures = 0
    for key in args.keys or entrypoint.queries():
        try:
            problem, seconds, n, checked = compare(spark, con, key, args.sf)
        except Exception as error:  # noqa: BLE001 - report and go on
            problem, seconds, n, checked = f"{type(error).__name__}: {str(error)[:900]}", 0, 0, True
        failures += bool(problem)
        print(f"{'FAIL' if problem else 'ok  '} {key:28s} {seconds:6.2f}s {n:7d} rows"
              f"{'' if checked else ' (rows only)'} {problem}", flush=True)
    print("failures:", failures)
    return 1 if failures else 0


if __name__ == "__main__":
    sys.exit(main())

"""Run registered queries next to their SQL in DuckDB and compare the results.

    python check.py [--sf /root/testdata/sf0.01] [name ...]
"""

from __future__ import annotations

import argparse
import datetime as dt
import math
import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def normal(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat(timespec="microseconds")
    return value


def as_counter(rows) -> Counter:
    return Counter(tuple(normal(v) for v in row) for row in rows)


def compare(spark_df, con, sql: str) -> list[str]:
    """Differences between a Spark result and its SQL; empty when they are equal."""
    names = sorted(spark_df.columns)
    problems = []
    expected = con.sql(f"SELECT * FROM ({sql.strip().rstrip(';')}) q")
    if sorted(expected.columns) != names:
        return [f"columns {names} != {sorted(expected.columns)}"]
    types = {
        "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN",
        "date": "DATE", "timestamp_ntz": "TIMESTAMP", "timestamp": "TIMESTAMP",
    }
    theirs = dict(zip(expected.columns, map(str, expected.types), strict=True))
    for name, kind in spark_df.dtypes:
        if types.get(kind) != theirs[name]:
            problems.append(f"type of {name}: {kind} != {theirs[name]}")
    quoted = ", ".join('"' + n + '"' for n in names)
    want = as_counter(con.sql(f"SELECT {quoted} FROM ({sql.strip().rstrip(';')}) q").fetchall())
    got = as_counter(tuple(r) for r in spark_df.select(*[f"`{n}`" for n in names]).collect())
    if got != want:
        problems.append(f"rows {sum(got.values())} != {sum(want.values())} or values differ")
        problems += [f"  only Spark {k} x{v}" for k, v in list((got - want).items())[:3]]
        problems += [f"  only SQL   {k} x{v}" for k, v in list((want - got).items())[:3]]
    if not want:
        problems.append("empty result")
    return problems


def main() -> int:
    parser = argparse.ArgumentParser()
    parser.add_argument("--sf", default="/root/testdata/sf0.01")
    parser.add_argument("--explain", action="store_true")
    parser.add_argument("names", nargs="*")
    args = parser.parse_args()
    sys.path.insert(0, str(Path(__file__).resolve().parent))
    from ladderline.session import build_session
    from workload import oracle_sql, queries

    spark = build_session(
        "check", "local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false", spark__driver__memory="8g",
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(args.sf)
    run, sql = queries(), oracle_sql()
    bad = 0
    for name in args.names or run:
        started = time.time()
        try:
            df = run[name](spark, args.sf)
            if args.explain:
                df.explain("formatted")
            problems = compare(df, con, sql[name]) if name in sql else ([] if df.count() else ["empty result"])
        except Exception as error:  # noqa: BLE001
            problems = [f"{type(error).__name__}: {str(error)[:1500]}"]
        bad += bool(problems)
        print(f"{'FAIL' if problems else 'ok  '} {name} {time.time() - started:.1f}s", flush=True)
        for problem in problems:
            print("     ", problem)
    spark.stop()
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())

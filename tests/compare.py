"""Side-by-side check of the registered queries against DuckDB.

    python -m tests.compare [--sf sf0.01] [--rows N] [query ...]
"""

from __future__ import annotations

import argparse
import datetime
import decimal
import math
import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for name in TABLES:
        con.execute(f"create view {name} as select * from read_parquet('{sf_dir}/{name}.parquet')")
    return con


def plain(value):
    """A hashable form that is the same for equal Spark and DuckDB values."""
    if value is None:
        return None
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value + 0.0
    if isinstance(value, decimal.Decimal):
        return ("decimal", str(value))
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    if isinstance(value, dict):
        return tuple(sorted((str(k), plain(v)) for k, v in value.items()))
    if hasattr(value, "asDict"):
        return plain(value.asDict())
    return value


def rows_of(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


def compare(spark, con, build, oracle: str | None, sf_dir: str) -> tuple[bool, str]:
    df = build(spark, sf_dir)
    got = rows_of(df.columns, df.collect())
    if oracle is None:
        return True, f"{len(got)} rows (no oracle)"
    result = con.execute(oracle)
    names = [d[0] for d in result.description]
    want = rows_of(names, result.fetchall())
    if sorted(names) != sorted(df.columns):
        return False, f"columns differ: {sorted(df.columns)} / {sorted(names)}"
    if got == want:
        return True, f"{len(got)} rows"
    got_set, want_set = set(got), set(want)
    extra = [r for r in got if r not in want_set][:3]
    lost = [r for r in want if r not in got_set][:3]
    return False, f"rows {len(got)}/{len(want)}\n    spark only: {extra}\n    oracle only: {lost}"


def main() -> int:
    from __spark_entry__ import oracle_sql, queries

    from logharbor.session import build_session

    parser = argparse.ArgumentParser()
    parser.add_argument("--sf", default="sf0.01")
    parser.add_argument("--rows", help="row limit per key before it is split")
    parser.add_argument("names", nargs="*")
    args = parser.parse_args()
    sf_dir = f"/root/testdata/{args.sf}"
    conf = {"spark_sql_shuffle_partitions": "8", "spark_driver_memory": "4g"}
    spark = build_session("compare", "local[8]", **conf)
    if args.rows:
        spark.conf.set("spark.logharbor.maxGroupRows", args.rows)
    spark.sparkContext.setLogLevel("OFF")
    con = connect(sf_dir)
    oracles, bad = oracle_sql(), 0
    for name, build in queries().items():
        if args.names and name not in args.names:
            continue
        began = time.time()
        try:
            ok, note = compare(spark, con, build, oracles.get(name), sf_dir)
        except Exception as error:  # report and go on with the next query
            ok, note = False, f"{type(error).__name__}: {str(error)[:1500]}"
        bad += not ok
        print(f"{'ok  ' if ok else 'FAIL'} {name} {time.time() - began:.2f}s {note}", flush=True)
    print(f"{bad} failed")
    spark.stop()
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())

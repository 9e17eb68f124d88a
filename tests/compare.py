"""Compare registered queries with their DuckDB twins: `python tests/compare.py [sf] [query ...]`."""

from __future__ import annotations

import datetime
import math
import os
import sys
import time
from decimal import Decimal

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def local_spark(cores: int = 8, memory: str = "12g"):
    from pyspark.sql import SparkSession

    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("storeops")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", memory)
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        path = f"{sf_dir}/{name}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def normal(value):
    """A value as both engines should give it; the type is kept apart from the text."""
    if isinstance(value, Decimal):
        return ("decimal", str(value))
    if isinstance(value, float):
        return ("double", None if math.isnan(value) else value)
    if isinstance(value, datetime.datetime):
        return ("timestamp", value.isoformat())
    if isinstance(value, datetime.date):
        return ("date", value.isoformat())
    return (type(value).__name__, value)


def rows_of(names: list[str], rows) -> list[tuple]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(normal(r[i]) for i in order) for r in rows), key=repr)


def differences(spark, con, sf_dir: str, build, sql: str, show: int = 3) -> list[str]:
    df = build(spark, sf_dir)
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    expected = cur.fetchall()
    if sorted(df.columns) != sorted(names):
        return [f"columns {sorted(df.columns)} != {sorted(names)}"]
    got = [tuple(r) for r in df.collect()]
    found = []
    if len(got) != len(expected):
        found.append(f"rows {len(got)} != {len(expected)}")
    a, b = rows_of(df.columns, got), rows_of(names, expected)
    if a != b:
        left, right = set(a), set(b)
        only_a = sorted(left - right, key=repr)
        only_b = sorted(right - left, key=repr)
        found.append(f"{len(only_a)} rows differ; columns {sorted(names)}")
        for x, y in zip(only_a[:show], only_b[:show]):
            found += [f"  spark  {[v for _, v in x]}", f"  duckdb {[v for _, v in y]}", f"  types {[(p[0], q[0]) for p, q in zip(x, y) if p != q]}"]
    return found


def main() -> int:
    import __spark_entry__ as entry

    sf = sys.argv[1] if len(sys.argv) > 1 else "sf0.01"
    sf_dir = f"/root/testdata/{sf}"
    queries, oracle = entry.queries(), entry.oracle_sql()
    names = sys.argv[2:] or list(queries)
    spark, con = local_spark(), duck(sf_dir)
    bad = 0
    for name in names:
        start = time.time()
        try:
            if name in oracle:
                found = differences(spark, con, sf_dir, queries[name], oracle[name])
            else:
                found = [] if queries[name](spark, sf_dir).count() else ["no rows"]
                print(f"{name}: rows only")
        except Exception as error:  # report and go on with the next query
            found = [f"{type(error).__name__}: {str(error)[:1500]}"]
        bad += bool(found)
        print(f"{'DIFF' if found else 'ok  '} {name} {time.time() - start:.1f}s", *found, sep="\n     " if found else " ", flush=True)
    print(f"{len(names) - bad} of {len(names)} match")
    return 1 if bad else 0


if __name__ == "__main__":
    raise SystemExit(main())

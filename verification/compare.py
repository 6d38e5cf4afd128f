"""Run the registered queries and their SQL twins side by side.

``python -m verification.compare [sf_dir] [query ...]``
"""

from __future__ import annotations

import math
import sys
import time
from collections import Counter

import duckdb
from pyspark.sql import DataFrame, SparkSession

from verification.oracle import ORACLE
from verification.queries import DRIVER_TABLES, QUERIES


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in DRIVER_TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{sf_dir}/{table}.parquet')")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value
    return value


def _rows(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def differences(df: DataFrame, con: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    """What differs between the two results: column names, Python types, rows. Empty if nothing."""
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    if sorted(df.columns) != sorted(names):
        return [f"columns {sorted(df.columns)} != {sorted(names)}"]
    mine, theirs = _rows(df.columns, df.collect()), _rows(names, cursor.fetchall())
    found = []
    if mine != theirs:
        found += [f"only in Spark: {r}" for r in list((mine - theirs).elements())[:3]]
        found += [f"only in SQL: {r}" for r in list((theirs - mine).elements())[:3]]
        found.append(f"{sum(mine.values())} rows in Spark, {sum(theirs.values())} in SQL")
    kinds = [
        {tuple(type(v) if v is not None else None for v in row) for row in side} for side in (mine, theirs)
    ]
    if not found and kinds[0] != kinds[1]:
        found.append("value types differ")
    return found


def main() -> int:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:] or list(QUERIES)
    spark = (
        SparkSession.builder.master("local[*]")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, failed = connect(sf_dir), 0
    for name in wanted:
        start = time.time()
        found = differences(QUERIES[name](spark, sf_dir), con, ORACLE[name])
        failed += bool(found)
        print(f"{'FAIL' if found else 'ok  '} {name} {time.time() - start:.1f}s", *found, sep="\n     ")
    return failed


if __name__ == "__main__":
    sys.exit(main())

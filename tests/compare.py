"""Run registered queries and their SQL counterparts side by side.

``python -m tests.compare [folder] [name ...]`` prints one line per query.
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

ROOT = Path(__file__).resolve().parent.parent
DATA = Path("/root/testdata")
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return con


def _plain(value):
    if isinstance(value, (dt.date, dt.datetime, decimal.Decimal)):
        raise TypeError(f"{value!r} prints differently on the two engines")
    if isinstance(value, float) and math.isnan(value):
        return "nan"
    return value


def _bag(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple((type(r[i]).__name__, _plain(r[i])) for i in order) for r in rows)


def difference(spark, con, query, sql: str, folder: str) -> tuple[str | None, int]:
    """(what differs or None, number of rows)."""
    df = query(spark, folder)
    ours = _bag(df.columns, df.collect())
    result = con.execute(sql)
    columns = [d[0] for d in result.description]
    theirs = _bag(columns, result.fetchall())
    n = sum(ours.values())
    if sorted(df.columns) != sorted(columns):
        return f"columns {sorted(df.columns)} / {sorted(columns)}", n
    if ours != theirs:
        extra, missing = ours - theirs, theirs - ours
        return (
            f"{sum(extra.values())} extra {list(extra)[:2]}, "
            f"{sum(missing.values())} missing {list(missing)[:2]}"
        ), n
    return None, n


def main() -> int:
    sys.path.insert(0, str(ROOT))
    from __spark_entry__ import oracle_sql, queries

    from tallyhouse.session import build_session

    folder = sys.argv[1] if len(sys.argv) > 1 else str(DATA / "sf0.01")
    wanted = sys.argv[2:]
    spark = build_session("compare", "local[8]", {"spark.sql.shuffle.partitions": "8"})
    spark.sparkContext.setLogLevel("ERROR")
    con, bad = connect(folder), 0
    for name, query in queries().items():
        if wanted and name not in wanted:
            continue
        start = time.perf_counter()
        try:
            sql = oracle_sql().get(name)
            if sql is None:  # tested without SQL
                continue
            problem, rows = difference(spark, con, query, sql, folder)
        except Exception as error:  # report and go on with the next query
            problem, rows = f"{type(error).__name__}: {str(error)[:600]}", -1
        bad += problem is not None
        print(f"{name:28s} {rows:7d} rows {time.perf_counter() - start:6.2f}s  {problem or 'ok'}")
    print("differences:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(main())

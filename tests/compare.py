"""Run registered queries next to their SQL and compare rows and types."""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))


def views(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for file in Path(sf_dir).glob("*.parquet"):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')")
    return con


def _cell(value: object) -> str:
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return "NULL"
    return repr(value)


def _rows(columns: list[str], rows: list[tuple]) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_cell(row[i]) for i in order) for row in rows)


# Spark type -> DuckDB type
_SAME = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN",
         "date": "DATE", "timestamp_ntz": "TIMESTAMP"}


def difference(df, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """None when both sides agree, else what differs."""
    answer = con.sql(sql)
    expected = dict(zip(answer.columns, map(str, answer.types)))
    got = {c: _SAME.get(t, t) for c, t in df.dtypes}
    if got != expected:
        return f"schema: spark-only {set(got.items()) - set(expected.items())}, " \
               f"sql-only {set(expected.items()) - set(got.items())}"
    ours = _rows(df.columns, [tuple(r) for r in df.collect()])
    theirs = _rows(answer.columns, answer.fetchall())
    if ours == theirs:
        return None
    only_ours, only_theirs = set(ours) - set(theirs), set(theirs) - set(ours)
    return f"rows {len(ours)} vs {len(theirs)}; spark-only {len(only_ours)} {sorted(only_ours)[:3]}; " \
           f"sql-only {len(only_theirs)} {sorted(only_theirs)[:3]}"


if __name__ == "__main__":
    from registry.oracle import ORACLE
    from registry.spark_queries import QUERIES
    from sensorlake.session import build_session

    sf_dir = sys.argv[1]
    names = sys.argv[2:] or list(QUERIES)
    spark = build_session(master="local[8]", spark__sql__shuffle__partitions=8, spark__driver__memory="8g",
                          spark__ui__showConsoleProgress="false")
    spark.sparkContext.setLogLevel("ERROR")
    con = views(sf_dir)
    bad = 0
    for name in names:
        start = time.time()
        try:
            result = difference(QUERIES[name](spark, sf_dir), con, ORACLE[name]) if name in ORACLE else "no sql"
        except Exception as e:  # a report over all queries, so go on with the next
            result = f"{type(e).__name__}: {str(e)[:600]}"
        bad += result is not None
        print(f"{'ok ' if result is None else 'BAD'} {name} {time.time() - start:.2f}s {result or ''}", flush=True)
    print("bad:", bad, "of", len(names), "without sql:", sorted(set(QUERIES) - set(ORACLE)))

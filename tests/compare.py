"""Run queries in Spark and DuckDB on the same tables and compare every value.

``python tests/compare.py [sf] [name-part ...]`` prints one line per query.
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()
DATA = os.environ.get("TESTDATA", "/root/testdata")


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{sf_dir}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, float) and math.isnan(value):
        return None
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat()
    return value.isoformat() if isinstance(value, dt.date) else value


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = [tuple(_plain(row[i]) for i in order) for row in rows]
    return sorted(columns), sorted(plain, key=repr)


def difference(spark_df, con, sql: str) -> str | None:
    """None if equal, else a short text."""
    result = con.execute(sql)
    want_columns, want = _rows([d[0] for d in result.description], result.fetchall())
    got_columns, got = _rows(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    if got_columns != want_columns:
        return f"columns {got_columns} != {want_columns}"
    if len(got) != len(want):
        return f"rows {len(got)} != {len(want)}"
    kinds = {(c, type(a).__name__, type(b).__name__)
             for g, w in zip(got, want) for c, a, b in zip(got_columns, g, w) if type(a) is not type(b)}
    if kinds:
        return f"types {sorted(kinds)[:5]}"
    wrong = [(g, w) for g, w in zip(got, want) if g != w]
    return f"{len(wrong)} rows differ, first {wrong[0]}" if wrong else None


def main() -> None:
    from __spark_entry__ import oracle_sql, queries
    from riskgrid.session import local_session

    scale, wanted = (sys.argv[1] if len(sys.argv) > 1 else "0.01"), sys.argv[2:]
    sf_dir = f"{DATA}/sf{scale}"
    spark = local_session("8")
    spark.sparkContext.setLogLevel("ERROR")
    con, oracles, failed = connect(sf_dir), oracle_sql(), 0
    unknown = set(oracles) - set(queries())
    assert not unknown, unknown
    for name, function in queries().items():
        if wanted and not any(part in name for part in wanted):
            continue
        start = time.time()
        try:
            df = function(spark, sf_dir)
            if name in oracles:
                problem = difference(df, con, oracles[name])
                text = "equal" if problem is None else f"FAIL {problem}"
            else:
                problem, text = None, f"rows only: {len(df.collect())}"
        except Exception as error:  # noqa: BLE001
            problem, text = error, f"ERROR {type(error).__name__}: {str(error)[:600]}"
        failed += problem is not None
        print(f"{time.time() - start:6.1f}s  {name}: {text}", flush=True)
    print("failed:", failed)


if __name__ == "__main__":
    main()

"""Run registered queries and their SQL side by side: ``python tests/compare.py [sf] [names]``."""

from __future__ import annotations

import os
import sys
import time
from datetime import date, datetime

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

DATA = "/root/testdata"
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations").split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    return con


def _cell(v):
    if isinstance(v, datetime):
        return v.isoformat(sep=" ")
    if isinstance(v, date):
        return v.isoformat()
    if isinstance(v, float):
        return "nan" if v != v else repr(v + 0.0)
    return repr(v)


def normal(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_cell(row[i]) for i in order) for row in rows)


def difference(df, con, sql: str) -> str | None:
    """None when both sides have the same columns and rows, else what differs."""
    found = con.execute(sql)
    theirs_columns = [d[0] for d in found.description]
    theirs = normal(theirs_columns, found.fetchall())
    ours = normal(df.columns, df.collect())
    if sorted(df.columns) != sorted(theirs_columns):
        return f"columns {sorted(df.columns)} against {sorted(theirs_columns)}"
    if len(ours) != len(theirs):
        return f"{len(ours)} rows against {len(theirs)}"
    wrong = [(a, b) for a, b in zip(ours, theirs) if a != b]
    return f"{len(wrong)} rows differ, first {wrong[0]}" if wrong else None


if __name__ == "__main__":
    import __spark_entry__ as entry
    from farelane.session import local_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "sf0.01"
    names = sys.argv[2:] or list(entry.queries())
    if os.environ.get("PLAIN"):  # a session without the library's settings
        from pyspark.sql import SparkSession

        spark = SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8").getOrCreate()
    else:
        spark = local_session(8)
    con = connect(f"{DATA}/{sf}")
    bad = 0
    for name in names:
        started = time.time()
        try:
            df = entry.queries()[name](spark, f"{DATA}/{sf}")
            sql = entry.oracle_sql().get(name)
            verdict = difference(df, con, sql) if sql else f"rows only: {len(df.collect())}"
        except Exception as e:  # noqa: BLE001
            verdict = f"FAILED {type(e).__name__}: {str(e)[:600]}"
        bad += bool(verdict) and not str(verdict).startswith("rows only")
        print(f"{name:24s} {time.time() - started:6.2f}s  {'ok' if verdict is None else str(verdict)[:900]}", flush=True)
    print("bad:", bad)

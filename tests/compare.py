"""Spark-vs-DuckDB comparison used by the tests (same checks the oracle gate
makes: row count, column names, order-insensitive values)."""

from __future__ import annotations

import math
from collections.abc import Iterable

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def duckdb_connection(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 6)
    if hasattr(v, "isoformat"):
        return v.isoformat(sep=" ") if hasattr(v, "hour") else v.isoformat()
    if isinstance(v, (bytes, bytearray)):
        return bytes(v).hex()
    return v


def _key(row: Iterable) -> tuple:
    return tuple((0, "") if x is None else (1, str(x)) for x in row)


def compare(spark_df, con, sql: str) -> dict:
    """Return a report dict; ``ok`` is True when both sides agree."""
    s_cols = spark_df.columns
    s_rows = [tuple(_norm(r[c]) for c in s_cols) for r in spark_df.collect()]
    rel = con.execute(sql)
    d_cols = [d[0] for d in rel.description]
    d_raw = rel.fetchall()
    report = {"spark_rows": len(s_rows), "oracle_rows": len(d_raw), "columns_equal": sorted(s_cols) == sorted(d_cols)}
    if not report["columns_equal"]:
        report.update(ok=False, spark_cols=s_cols, oracle_cols=d_cols)
        return report
    idx = [d_cols.index(c) for c in s_cols]
    d_rows = [tuple(_norm(r[i]) for i in idx) for r in d_raw]
    s_sorted = sorted(s_rows, key=_key)
    d_sorted = sorted(d_rows, key=_key)
    diffs = [(a, b) for a, b in zip(s_sorted, d_sorted) if a != b]
    report["value_mismatches"] = len(diffs) + abs(len(s_rows) - len(d_rows))
    report["examples"] = diffs[:3]
    report["ok"] = report["value_mismatches"] == 0 and len(s_rows) == len(d_rows)
    return report

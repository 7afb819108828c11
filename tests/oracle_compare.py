"""Compare a Spark query with its DuckDB oracle: row count, column names and
an order-insensitive hash of the values (columns sorted by name)."""

from __future__ import annotations

import hashlib
import math
import sys

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return "∅"
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return repr(round(v, 6))
    if hasattr(v, "isoformat"):
        return v.isoformat()
    try:
        import decimal

        if isinstance(v, decimal.Decimal):
            return repr(round(float(v), 6))
    except Exception:
        pass
    return str(v)


def fingerprint(columns: list[str], rows: list[tuple]) -> tuple[int, list[str], str]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    lines = sorted("|".join(_norm(r[i]) for i in order) for r in rows)
    h = hashlib.sha256("\n".join(lines).encode()).hexdigest()
    return len(rows), [columns[i] for i in order], h


def compare(spark, name: str, sf_dir: str, con=None) -> dict:
    sys.path.insert(0, "/root/repo")
    import __spark_entry__ as E

    df = E.queries()[name](spark, sf_dir)
    srows = [tuple(r) for r in df.collect()]
    s = fingerprint(df.columns, srows)
    sql = E.oracle_sql().get(name)
    if sql is None:
        return {"name": name, "rows": s[0], "oracle": None}
    con = con or duck(sf_dir)
    cur = con.execute(sql)
    cols = [d[0] for d in cur.description]
    o = fingerprint(cols, cur.fetchall())
    return {
        "name": name,
        "rows": s[0],
        "oracle_rows": o[0],
        "cols_match": s[1] == o[1],
        "hash_match": s[2] == o[2],
        "spark_cols": s[1] if s[1] != o[1] else None,
        "oracle_cols": o[1] if s[1] != o[1] else None,
    }

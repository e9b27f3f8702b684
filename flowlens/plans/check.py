"""Compare registered Spark queries with their DuckDB oracle SQL.

Mirrors the driver's gate: row count, column names and an order-insensitive
comparison of all values (floats to 9 significant digits).
"""

from __future__ import annotations

import math
from collections import Counter
from dataclasses import dataclass

from pyspark.sql import SparkSession

DRIVER_TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem",
                 "events"]


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        return "nan" if math.isnan(v) else float(f"{v:.9g}")
    if hasattr(v, "as_tuple"):  # Decimal
        return float(f"{float(v):.9g}")
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return v


@dataclass
class Result:
    key: str
    ok: bool
    spark_rows: int
    oracle_rows: int | None
    detail: str = ""


def duckdb_connection(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for t in DRIVER_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def compare(spark: SparkSession, con, sf_dir: str, key: str, query, sql: str | None) -> Result:
    df = query(spark, sf_dir)
    cols = sorted(df.columns)
    s_rows = Counter(tuple(_norm(r[c]) for c in cols) for r in df.collect())
    n_spark = sum(s_rows.values())
    if sql is None:
        return Result(key, True, n_spark, None, "no oracle")
    cur = con.execute(sql)
    d_cols = [d[0] for d in cur.description]
    if sorted(d_cols) != cols:
        return Result(key, False, n_spark, None, f"columns {cols} vs {sorted(d_cols)}")
    idx = {c: i for i, c in enumerate(d_cols)}
    d_rows = Counter(tuple(_norm(r[idx[c]]) for c in cols) for r in cur.fetchall())
    ok = s_rows == d_rows
    detail = ""
    if not ok:
        detail = (f"only spark {list((s_rows - d_rows).items())[:2]} "
                  f"only oracle {list((d_rows - s_rows).items())[:2]}")
    return Result(key, ok, n_spark, sum(d_rows.values()), detail)

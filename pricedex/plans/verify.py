"""Compare a registered Spark query with its DuckDB oracle: same columns, same multiset of rows (exact values)."""

from __future__ import annotations

import datetime as dt
import decimal
import math

import duckdb

from pricedex.sources.standins import DRIVER_TABLES


def duckdb_views(sf_dir: str):
    con = duckdb.connect()
    for t in DRIVER_TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    if isinstance(v, decimal.Decimal):
        return float(v)
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    if isinstance(v, bool):
        return int(v)
    return v


def _key(row):
    return tuple((0, "") if x is None else (1, str(x)) for x in row)


# Spark type -> DuckDB type of the same values
TYPE_PAIRS = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE",
              "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN", "float": "FLOAT", "smallint": "SMALLINT"}


def type_mismatches(spark_df, con, sql: str) -> list[tuple[str, str, str]]:
    rel = con.sql(sql)
    duck = dict(zip(rel.columns, [str(t) for t in rel.types]))
    return [(f.name, f.dataType.simpleString(), duck.get(f.name)) for f in spark_df.schema.fields
            if TYPE_PAIRS.get(f.dataType.simpleString(), f.dataType.simpleString()) != duck.get(f.name)]


def compare(spark_df, con, sql: str) -> tuple[bool, str, int]:
    bad_types = type_mismatches(spark_df, con, sql)
    if bad_types:
        return False, f"types (column, spark, duckdb): {bad_types}", 0
    cols = spark_df.columns
    s_rows = [tuple(_norm(r[c]) for c in cols) for r in spark_df.collect()]
    cur = con.execute(sql)
    o_cols = [d[0] for d in cur.description]
    if sorted(cols) != sorted(o_cols):
        return False, f"columns spark={cols} oracle={o_cols}", len(s_rows)
    idx = [o_cols.index(c) for c in cols]
    o_rows = [tuple(_norm(r[i]) for i in idx) for r in cur.fetchall()]
    a, b = sorted(s_rows, key=_key), sorted(o_rows, key=_key)
    if a != b:
        diff = [(x, y) for x, y in zip(a, b) if x != y][:3]
        return False, f"rows spark={len(a)} oracle={len(b)} first diffs={diff}", len(a)
    return True, "", len(a)

"""Compares a Spark result with a DuckDB one: columns, types, row count and values."""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        path = f"{sf_dir}/{t}.parquet"
        if os.path.exists(path):
            con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{path}'")
    return con


_SPARK_TYPES = {
    "int": "INTEGER",
    "bigint": "BIGINT",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
    "date": "DATE",
    "timestamp": "TIMESTAMP",
    "timestamp_ntz": "TIMESTAMP",
}


def _value(x):
    if x is None or (isinstance(x, float) and math.isnan(x)):
        return None
    if isinstance(x, decimal.Decimal):
        return float(x)
    if isinstance(x, dt.datetime):
        return x.replace(tzinfo=None).isoformat()
    if isinstance(x, dt.date):
        return x.isoformat()
    return x


def differences(df, con, sql: str) -> list[str]:
    """What differs; empty if nothing does."""
    rel = con.sql(sql)
    spark_types = {f.name: _SPARK_TYPES.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in df.schema}
    duck_types = dict(zip(rel.columns, [str(t) for t in rel.types]))
    out = []
    if set(spark_types) != set(duck_types):
        return [f"columns differ: {sorted(set(spark_types) ^ set(duck_types))}"]
    for c, t in spark_types.items():
        if duck_types[c] != t:
            out.append(f"type of {c}: {t} / {duck_types[c]}")
    cols = sorted(spark_types)
    left = [tuple(_value(r[c]) for c in cols) for r in df.collect()]
    at = {c: i for i, c in enumerate(rel.columns)}
    right = [tuple(_value(r[at[c]]) for c in cols) for r in rel.fetchall()]
    if len(left) != len(right):
        out.append(f"rows: {len(left)} / {len(right)}")
    l, r = Counter(left), Counter(right)
    only_l, only_r = list((l - r).elements()), list((r - l).elements())
    if only_l or only_r:
        out.append(f"values: {len(only_l)} rows only in Spark, {len(only_r)} only in DuckDB")
        key = lambda row: tuple(str(x) for x in row)
        for a, b in list(zip(sorted(only_l, key=key), sorted(only_r, key=key)))[:2]:
            out.append(str({c: (x, y) for c, x, y in zip(cols, a, b) if x != y}))
        if not only_r or not only_l:
            out.append(str(dict(zip(cols, (only_l or only_r)[0]))))
    return out

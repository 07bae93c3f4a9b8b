"""Compare a Spark result with its oracle: names, kinds of types, every value."""

from __future__ import annotations

import datetime as dt
import math
from collections import Counter
from decimal import Decimal

import duckdb

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _norm(v):
    if isinstance(v, bool) or v is None:
        return v
    if isinstance(v, float):
        return "nan" if math.isnan(v) else ("f", v)
    if isinstance(v, Decimal):
        return ("d", str(v))
    if isinstance(v, dt.datetime):
        return ("ts", v.isoformat())
    if isinstance(v, dt.date):
        return ("date", v.isoformat())
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def differences(df, con, sql: str) -> list[str]:
    rel = con.sql(sql)
    names = sorted(df.columns)
    if names != sorted(rel.columns):
        return [f"columns {names} vs {sorted(rel.columns)}"]
    got = Counter(tuple(_norm(r[n]) for n in names) for r in df.collect())
    order = [rel.columns.index(n) for n in names]
    want = Counter(tuple(_norm(r[i]) for i in order) for r in rel.fetchall())
    out = []
    if sum(got.values()) != sum(want.values()):
        out.append(f"rows {sum(got.values())} vs {sum(want.values())}")
    spark_types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    duck_types = dict(zip(rel.columns, [str(t) for t in rel.types]))
    same = {
        "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
        "date": "DATE", "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP",
    }
    for n in names:
        if same.get(spark_types[n]) != duck_types[n]:
            out.append(f"type of {n}: {spark_types[n]} vs {duck_types[n]}")
    only_got, only_want = got - want, want - got
    if only_got or only_want:
        out.append(f"{sum(only_got.values())} rows differ")
        for a, b in zip(sorted(only_got, key=str)[:2], sorted(only_want, key=str)[:2]):
            out.append("  " + str([(n, x, y) for n, x, y in zip(names, a, b) if x != y])[:700])
    return out

"""Compare a Spark result with its SQL counterpart: names, types, rows in any order."""

from __future__ import annotations

import glob
import math
import os

import duckdb
from pyspark.sql import DataFrame

SPARK_TYPES = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "boolean": "BOOLEAN", "string": "VARCHAR"}


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


def _key(row: tuple) -> tuple:
    return tuple((x is None, str(round(x, 3)) if isinstance(x, float) else str(x)) for x in row)


def differences(df: DataFrame, con: duckdb.DuckDBPyConnection, sql: str, limit: int = 5) -> list[str]:
    """Empty when both agree, doubles to the last bit."""
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    types = {d[0]: str(d[1]) for d in cursor.description}
    out = []
    if sorted(names) != sorted(df.columns):
        return [f"columns: spark only {sorted(set(df.columns) - set(names))}, sql only {sorted(set(names) - set(df.columns))}"]
    for field in df.schema:
        want = SPARK_TYPES.get(field.dataType.simpleString(), field.dataType.simpleString())
        if types[field.name] != want:
            out.append(f"type of {field.name}: spark {want}, sql {types[field.name]}")
    order = sorted(names)
    left = sorted([tuple(r[c] for c in order) for r in df.collect()], key=_key)
    pick = [names.index(c) for c in order]
    right = sorted([tuple(r[i] for i in pick) for r in cursor.fetchall()], key=_key)
    if len(left) != len(right):
        out.append(f"rows: spark {len(left)}, sql {len(right)}")
    bad = [(a, b) for a, b in zip(left, right) if not all(map(_same, a, b))]
    if bad:
        out.append(f"{len(bad)} rows differ")
        for a, b in bad[:limit]:
            out.append("; ".join(f"{c}: {x!r} / {y!r}" for c, x, y in zip(order, a, b) if not _same(x, y)))
    return out


def _same(x, y) -> bool:
    if isinstance(x, float) and isinstance(y, float):
        return x == y or (math.isnan(x) and math.isnan(y))
    return x == y


def rows(df, *columns):
    """Rows as sorted tuples."""
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=lambda t: tuple((x is None, str(x)) for x in t))

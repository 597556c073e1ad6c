"""Copies of the tables in which one key of each kind holds a third of all rows."""

from __future__ import annotations

import glob
import os

import duckdb


def write_hot_tables(source: str, target: str) -> str:
    """Copy the Parquet tables of ``source``; a third of the sales share order line, product and store,
    a third of the orders one client."""
    con = duckdb.connect()
    for path in glob.glob(f"{source}/*.parquet"):
        name, out = os.path.basename(path)[:-8], os.path.join(target, os.path.basename(path))
        body = f"SELECT * FROM '{path}'"
        if name == "lineitem":
            hot = "(row_number() OVER () % 3 = 0)"
            body = f"""SELECT * REPLACE (CASE WHEN hot THEN 5 ELSE l_orderkey END AS l_orderkey,
              CAST(CASE WHEN hot THEN 1 ELSE l_linenumber END AS INTEGER) AS l_linenumber,
              CASE WHEN hot THEN 7 ELSE l_partkey END AS l_partkey, CASE WHEN hot THEN 3 ELSE l_suppkey END AS l_suppkey)
              FROM (SELECT *, {hot} AS hot FROM '{path}')"""
            body = f"SELECT * EXCLUDE (hot) FROM ({body})"
        elif name == "orders":
            body = f"SELECT * REPLACE (CASE WHEN o_orderkey % 3 = 0 THEN 11 ELSE o_custkey END AS o_custkey) FROM '{path}'"
        con.execute(f"COPY ({body}) TO '{out}' (FORMAT parquet)")
    return target

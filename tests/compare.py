"""Compare a Spark result with DuckDB text over the same parquet tables."""

from __future__ import annotations

import math

import duckdb

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations"]


def connect(sf: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    return con


def _norm(v):
    if isinstance(v, float) and math.isnan(v):
        return None
    return v


def _sorted_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(_norm(row[i]) for i in order) for row in rows]
    return [columns[i] for i in order], sorted(out, key=lambda t: [(x is not None, str(type(x)), x) if x is not None
                                                                   else (False, "", 0) for x in t])


KINDS = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "timestamp_ntz": "TIMESTAMP",
         "date": "DATE", "boolean": "BOOLEAN"}


def compare(df, sql: str, con) -> list[str]:
    """Differences as text; empty when names, types, row count and every value agree exactly."""
    res = con.execute(sql)
    dcols = [d[0] for d in res.description]
    types = dict(zip(dcols, [str(d[1]) for d in res.description]))
    drows = res.fetchall()
    srows = [tuple(row) for row in df.collect()]
    problems = []
    if sorted(dcols) != sorted(df.columns):
        return [f"columns spark={sorted(df.columns)} duck={sorted(dcols)}"]
    for f in df.schema.fields:
        want = KINDS.get(f.dataType.simpleString(), f.dataType.simpleString())
        if types[f.name] != want:
            problems.append(f"type {f.name}: spark={f.dataType.simpleString()} duck={types[f.name]}")
    if len(srows) != len(drows):
        problems.append(f"rows spark={len(srows)} duck={len(drows)}")
    cols, a = _sorted_rows(df.columns, srows)
    _, b = _sorted_rows(dcols, drows)
    bad = [(x, y) for x, y in zip(a, b) if x != y]
    if bad:
        problems.append(f"{len(bad)} rows differ, columns {cols}: first spark={bad[0][0]} duck={bad[0][1]}")
    return problems

"""Order-insensitive comparison of a Spark result with a DuckDB result."""

from __future__ import annotations

import math
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def oracle(folder: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def _cell(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 6) + 0.0
    if hasattr(value, "hour"):
        return value.replace(tzinfo=None).isoformat()
    return value.isoformat() if hasattr(value, "isoformat") else value


def _bag(columns, rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(repr(_cell(row[i])) for i in order) for row in rows)


def differences(df, con, sql: str) -> list[str]:
    """Empty when the results agree in column names and in rows."""
    result = con.execute(sql)
    columns = [d[0] for d in result.description]
    if sorted(columns) != sorted(df.columns):
        return [f"columns {sorted(df.columns)} != {sorted(columns)}"]
    ours = _bag(df.columns, [tuple(r) for r in df.collect()])
    theirs = _bag(columns, result.fetchall())
    out = []
    for label, extra in (("only ours", ours - theirs), ("only oracle", theirs - ours)):
        if extra:
            out.append(f"{label}: {sum(extra.values())} rows, e.g. {str(list(extra)[:2])[:600]}")
    if not ours:
        out.append("no rows")
    return out

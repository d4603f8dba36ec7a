"""Comparison of a Spark result with the same query stated in SQL and run by DuckDB."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        path = Path(sf_dir) / f"{table}.parquet"
        if path.exists():
            con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{path}')")
    return con


def _key(value):
    if isinstance(value, float):
        if math.isnan(value):
            return "nan"
        return f"{value + 0.0:.9g}"
    return repr(value)


# Spark type -> DuckDB types that hash alike
SAME_TYPE = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN",
    "timestamp": "TIMESTAMP", "timestamp_ntz": "TIMESTAMP",
}


def differences(df, con, sql: str) -> list[str]:
    """Reasons why the two results differ; empty when they agree in columns, types and rows."""
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    types = dict(zip(names, (str(d[1]) for d in result.description)))
    expected = result.fetchall()
    actual = [tuple(r) for r in df.collect()]
    found = []
    if sorted(df.columns) != sorted(names):
        return [f"columns {sorted(df.columns)} against {sorted(names)}"]
    for field in df.schema.fields:
        want = SAME_TYPE.get(field.dataType.simpleString(), field.dataType.simpleString())
        if want != types[field.name]:
            found.append(f"type of {field.name}: {field.dataType.simpleString()} against {types[field.name]}")
    if len(expected) != len(actual):
        found.append(f"rows {len(actual)} against {len(expected)}")
    order = sorted(names)
    left = sorted(tuple(_key(r[df.columns.index(c)]) for c in order) for r in actual)
    right = sorted(tuple(_key(r[names.index(c)]) for c in order) for r in expected)
    if left != right:
        only = [a for a in set(left) - set(right)][:3]
        other = [b for b in set(right) - set(left)][:3]
        found.append(f"values {order}: Spark only {sorted(only)} SQL only {sorted(other)}")
    return found

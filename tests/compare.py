"""Run a query on Spark and its SQL twin on DuckDB and compare rows."""

from __future__ import annotations

import datetime as dt
import decimal
import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(folder: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def plain(value):
    if value is None:
        return None
    if isinstance(value, decimal.Decimal):
        value = float(value)
    if isinstance(value, float):
        if math.isnan(value):
            return None
        return float(f"{value:.9g}")
    if isinstance(value, bool):
        return value
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, dt.date):
        return value.isoformat()
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    return value


def shaped(names: list[str], rows) -> list[tuple]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    out = [tuple(plain(row[i]) for i in order) for row in rows]
    return sorted(out, key=lambda r: tuple((v is not None, str(type(v)), v if not isinstance(v, tuple) else str(v)) for v in r))


# DuckDB type -> Spark types that hold the same values.
SAME_TYPE = {
    "INTEGER": {"int"},
    "BIGINT": {"bigint"},
    "VARCHAR": {"string"},
    "DOUBLE": {"double"},
    "DATE": {"date"},
    "BOOLEAN": {"boolean"},
    "TIMESTAMP": {"timestamp_ntz", "timestamp"},
}


def compare(df, con, statement: str) -> list[str]:
    """Differences as text; empty when both sides agree."""
    result = con.execute(statement)
    names = [d[0] for d in result.description]
    types = [str(d[1]) for d in result.description]
    expected = shaped(names, result.fetchall())
    problems = []
    if sorted(names) != sorted(df.columns):
        return [f"columns differ: sql {sorted(names)} spark {sorted(df.columns)}"]
    spark_types = dict(df.dtypes)
    for name, dtype in zip(names, types):
        if spark_types[name] not in SAME_TYPE.get(dtype, {spark_types[name]} if "[]" in dtype or "STRUCT" in dtype else set()):
            problems.append(f"type of {name}: sql {dtype} spark {spark_types[name]}")
    actual = shaped(df.columns, df.collect())
    if len(actual) != len(expected):
        problems.append(f"rows: sql {len(expected)} spark {len(actual)}")
    if actual != expected:
        extra = [r for r in actual if r not in set(expected)][:3]
        lost = [r for r in expected if r not in set(actual)][:3]
        problems.append(f"spark only {extra}; sql only {lost} ({sorted(names)})")
    return problems

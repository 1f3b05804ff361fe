"""Runs queries and their SQL side by side."""

from __future__ import annotations

import datetime as dt
import decimal
import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    connection.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return connection


def plain(value):
    if isinstance(value, decimal.Decimal):
        value = float(value)
    if isinstance(value, float):
        return None if math.isnan(value) else float(f"{value:.9g}") + 0.0
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None)
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(plain(row[i]) for i in order) for row in rows]
    return [columns[i] for i in order], sorted(out, key=repr)


# Spark type -> type names the SQL side may have.
SAME = {
    "bigint": {"BIGINT"}, "int": {"INTEGER"}, "string": {"VARCHAR"}, "double": {"DOUBLE"},
    "boolean": {"BOOLEAN"}, "date": {"DATE"}, "timestamp_ntz": {"TIMESTAMP"}, "float": {"FLOAT"},
}


def compare(df, connection, sql) -> list[str]:
    """What differs, as texts; empty when all is equal."""
    relation = connection.execute(sql)
    sql_types = {c[0]: str(c[1]) for c in relation.description}
    problems = []
    for field in df.schema.fields:
        kind = field.dataType.simpleString()
        if sql_types.get(field.name) not in SAME.get(kind, {kind}):
            problems.append(f"{field.name}: {kind} against {sql_types.get(field.name)}")
    want = rows_of(list(sql_types), relation.fetchall())
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    if got[0] != want[0]:
        problems.append(f"columns {got[0]} against {want[0]}")
    if len(got[1]) != len(want[1]):
        problems.append(f"{len(got[1])} rows against {len(want[1])}")
    elif got[1] != want[1]:
        pairs = [(a, b) for a, b in zip(got[1], want[1]) if a != b]
        problems.append(f"{len(pairs)} rows differ, first {pairs[0]}")
    return problems

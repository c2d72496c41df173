"""Run a catalog query in Spark and its SQL in DuckDB and compare the rows."""

from __future__ import annotations

import math
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return connection


def _plain(value):
    if isinstance(value, float):
        if math.isnan(value):
            return "NaN"
        return repr(value)
    return value


def _bag(columns, rows):
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def differences(df, connection, sql) -> list[str]:
    """Nothing when both give the same columns, types and bag of rows."""
    arrow = df.toArrow()
    rows = list(zip(*[c.to_pylist() for c in arrow.columns])) if arrow.num_columns else []
    connection.execute(sql)
    description = connection.description
    expected_names = [d[0] for d in description]
    expected = connection.fetchall()
    found = []
    if sorted(expected_names) != sorted(df.columns):
        return [f"columns {sorted(df.columns)} <> {sorted(expected_names)}"]
    kinds = {"BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "VARCHAR": "string",
             "BOOLEAN": "boolean", "DATE": "date"}
    spark_types = dict(df.dtypes)
    for name, kind in ((d[0], str(d[1])) for d in description):
        if kinds.get(kind, kind) != spark_types[name]:
            found.append(f"type of {name}: {spark_types[name]} <> {kind}")
    if len(rows) != len(expected):
        found.append(f"{len(rows)} rows <> {len(expected)}")
    ours, theirs = _bag(list(df.columns), rows), _bag(expected_names, expected)
    if ours != theirs:
        found.append(f"only ours {list((ours - theirs).items())[:3]}, "
                     f"only theirs {list((theirs - ours).items())[:3]}")
    return found

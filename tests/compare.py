"""Comparing a Spark result with the same SQL run by DuckDB."""

from __future__ import annotations

import datetime
import decimal
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return connection


def _plain(value):
    if isinstance(value, decimal.Decimal):
        raise AssertionError("decimals do not compare across engines")
    if isinstance(value, float) and value == 0:
        return 0.0  # no negative zero
    if isinstance(value, datetime.datetime):
        raise AssertionError("timestamps are compared as text")
    return value


TYPES = {"bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN", "date": "DATE"}


def differences(df, connection, sql: str) -> str | None:
    """None when columns, types and rows agree."""
    described = {r[0]: r[1] for r in connection.execute(f"DESCRIBE {sql}").fetchall()}
    found_types = {name: TYPES.get(kind, kind) for name, kind in df.dtypes}
    if found_types != described:
        return f"types {sorted(set(found_types.items()) ^ set(described.items()))}"
    names = sorted(described)
    result = connection.execute(sql)
    at = [list(described).index(n) for n in names]
    expected = [tuple(_plain(row[i]) for i in at) for row in result.fetchall()]
    found = [tuple(_plain(v) for v in row) for row in df.select(*[f"`{n}`" for n in names]).collect()]
    extra, lost = Counter(found) - Counter(expected), Counter(expected) - Counter(found)
    if extra or lost:
        return (
            f"{len(found)} rows, expected {len(expected)}; {names}\n"
            f"  only here ({sum(extra.values())}): {sorted(extra, key=str)[:2]}\n"
            f"  missing ({sum(lost.values())}): {sorted(lost, key=str)[:2]}"
        )
    return None

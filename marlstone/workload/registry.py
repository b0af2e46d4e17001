"""Named queries over the benchmark tables, each with its SQL equivalent."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marlstone.workload.inputs import select_sql

Build = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    name: str
    build: Build
    sql: str | None


QUERIES: dict[str, Query] = {}


def query(name: str, sql: str | None = None) -> Callable[[Build], Build]:
    """Register a query; ``sql`` may name its inputs as ``e_<input>``."""

    def add(build: Build) -> Build:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = Query(name, lambda spark, folder: comparable(build(spark, folder)), sql)
        return build

    return add


def comparable(df: DataFrame) -> DataFrame:
    """Column types that mean the same in both engines."""
    columns = []
    for name, kind in df.dtypes:
        column = F.col(f"`{name}`")
        if kind in ("int", "smallint", "tinyint"):
            column = column.cast("bigint")
        elif kind.startswith("decimal"):
            column = column.cast("double")
        elif kind.startswith("timestamp"):
            column = F.date_format(column, "yyyy-MM-dd HH:mm:ss")
        columns.append(column.alias(name))
    return df.select(*columns)


def with_inputs(body: str, *inputs: str, **more: str) -> str:
    """``body`` after definitions of its inputs; ``more`` adds named subqueries."""
    parts = [f"e_{name} AS ({select_sql(name)})" for name in inputs]
    parts += [f"{name} AS ({sql})" for name, sql in more.items()]
    return f"WITH {', '.join(parts)} {body}"


# Fragments of comparison SQL.


def exact_sum(expression: str) -> str:
    return f"sum(CAST({expression} AS DECIMAL(18, 4)))"


def double(expression: str) -> str:
    return f"CAST({expression} AS DOUBLE)"


def whole(expression: str) -> str:
    return f"CAST({expression} AS BIGINT)"


def rounded_mean(cents: str, n: str, scale: int = 100) -> str:
    """cents / n rounded half up, in whole numbers, as an amount."""
    return f"{double(f'(2 * {cents} + {n}) // (2 * {n})')} / {scale}"


def percent(part: str, total: str) -> str:
    return f"round({double(part)} / nullif({double(total)}, 0) * 100, 2)"


def instant(expression: str) -> str:
    return f"strftime({expression}, '%Y-%m-%d %H:%M:%S')"

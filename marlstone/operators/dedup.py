"""One row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marlstone.functions.rules import orderable

RANK = "_rank_in_key"


def top_per_key(df: DataFrame, key: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of every key in the given order.

    Catalyst turns the rank filter into a group limit that runs before the
    shuffle as well, so each task sends at most one row per key, however many
    rows a key has.
    """
    window = Window.partitionBy(*key).orderBy(*order)
    return df.withColumn(RANK, F.row_number().over(window)).filter(F.col(RANK) == 1).drop(RANK)


def latest_per_key(
    df: DataFrame, key: str, recency: Sequence[str] = ("_ingested_at",), tie_break: Sequence[str] | None = None
) -> DataFrame:
    """The most recent row of every key.

    Rows equally recent are ordered by ``tie_break`` (by default every other
    column), so a retried task picks the same row again.
    """
    if tie_break is None:
        tie_break = orderable(df, skip={key, *recency})
    return top_per_key(df, [key], [F.desc(c) for c in recency] + [F.asc_nulls_last(c) for c in tie_break])


def distinct_by_key(df: DataFrame, key: str) -> DataFrame:
    """One row per key, the smallest in column order."""
    return latest_per_key(df, key, recency=())

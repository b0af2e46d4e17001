"""Row-level ingestion operators: coercion, quarantine split, late flag, stamps."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marlstone.entities import LATE_AFTER_DAYS
from marlstone.functions.rules import all_true, day, moment

WHOLE_NUMBERS = ("int", "bigint")
FRACTIONS = ("float", "double")


def coerce(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Bring declared columns to their type; undeclared columns pass unchanged.

    A value that does not fit its type becomes NULL, and so do NaN and the infinities, which no amount can be.
    """
    present = dict(df.dtypes)
    return df.withColumns(
        {name: _coerced(name, present[name], wanted) for name, wanted in types.items() if name in present}
    )


def _coerced(name: str, found: str, wanted: str) -> Column:
    value = F.col(name)
    if found == "string" and wanted in WHOLE_NUMBERS:
        # Text such as "12.0" counts as the whole number 12.
        return F.coalesce(
            value.try_cast(wanted), value.try_cast("decimal(38,6)").try_cast(wanted)
        )
    if wanted in FRACTIONS:
        number = value.try_cast(wanted)
        return F.when(F.abs(number) < float("inf"), number)  # NaN counts as larger than any number
    return value.try_cast(wanted)


def is_complete(df: DataFrame, required: Iterable[str]) -> Column:
    """True where every required column has a value; never, if one is missing altogether."""
    required = list(required)
    if not set(required) <= set(df.columns):
        return F.lit(False)
    return all_true(F.col(c).isNotNull() for c in required)


def split_required(df: DataFrame, required: Iterable[str]) -> tuple[DataFrame, DataFrame]:
    """(valid rows, rows for quarantine)."""
    complete = is_complete(df, required)
    return df.filter(complete), df.filter(~complete)


def with_order_month(df: DataFrame, date_column: str) -> DataFrame:
    parsed = F.col(date_column).try_cast("date")
    return df.withColumns({"order_year": F.year(parsed), "order_month": F.month(parsed)})


def flag_late(df: DataFrame, date_column: str, as_of=None, days: int = LATE_AFTER_DAYS) -> DataFrame:
    """Mark rows dated more than ``days`` before ``as_of``; no date, no verdict."""
    age = F.datediff(day(as_of), F.col(date_column).try_cast("date"))
    return df.withColumn("_is_late", age > days)


def stamp(df: DataFrame, source_file: str, batch_id: str, ingested_at=None) -> DataFrame:
    return df.withColumns(
        {
            "_ingested_at": moment(ingested_at),
            "_source_file": F.lit(source_file),
            "_batch_id": F.lit(batch_id),
        }
    )

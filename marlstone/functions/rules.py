"""Small expression builders shared by the row-level operators."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SURROGATE_NULL = "_dbt_utils_surrogate_key_null_"  # fixed value


def filled(defaults: Mapping[str, object]) -> dict[str, Column]:
    """``{column: coalesce(column, default)}`` for use with ``withColumns``."""
    return {name: F.coalesce(F.col(name), F.lit(value)) for name, value in defaults.items()}


def as_dates(names: Iterable[str]) -> dict[str, Column]:
    """Lenient date parsing: text that is no date becomes NULL."""
    return {name: F.col(name).try_cast("date") for name in names}


def all_true(conditions: Iterable[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions, F.lit(True))


def has_status(statuses: Iterable[str]) -> Column:
    return F.col("status").isin(*statuses)


def day(as_of) -> Column:
    """The reference day: a given date, or today."""
    return F.current_date() if as_of is None else F.lit(as_of).cast("date")


def moment(at) -> Column:
    """The processing instant: a given timestamp, or now."""
    return F.current_timestamp() if at is None else F.lit(at).cast("timestamp")


def tiers(value: Column, steps: Iterable[tuple[Column, str]], otherwise: str) -> Column:
    """First matching label wins."""
    steps = list(steps)
    out = F.when(*steps[0])
    for condition, label in steps[1:]:
        out = out.when(condition, label)
    return out.otherwise(otherwise)


def surrogate_key(*columns: str) -> Column:
    """MD5 over the text of the key columns, NULL-safe."""
    texts = [F.coalesce(F.col(c).cast("string"), F.lit(SURROGATE_NULL)) for c in columns]
    return F.md5(F.concat_ws("-", *texts))


def differs(left: str, right: str, columns: Iterable[str]) -> Column:
    """NULL-safe: does any of the struct fields differ between two structs?"""
    return ~all_true(F.col(f"{left}.{c}").eqNullSafe(F.col(f"{right}.{c}")) for c in columns)


def orderable(df: DataFrame, skip: Iterable[str] = ()) -> list[str]:
    """Columns usable in ORDER BY (maps and variants are not), by name."""
    skip = set(skip)
    return sorted(
        f.name
        for f in df.schema.fields
        if f.name not in skip and not any(t in f.dataType.simpleString() for t in ("map<", "variant"))
    )

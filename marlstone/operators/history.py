"""Type-2 history: merging a batch of current records into a versioned dimension.

One full outer join on the key decides, for every key, which versions the batch
leaves behind.  Both sides hold at most one row per key, so no key can be hot.
Closed versions are never read by a merge; they only accumulate.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marlstone.entities import OPEN_END, TRACKED_CUSTOMER_COLUMNS
from marlstone.functions.rules import differs, moment, surrogate_key
from marlstone.sources.evolution import common_schema


@dataclass(frozen=True)
class HistoryRules:
    """How versions are dated and what happens to keys a batch no longer has."""

    key: str
    tracked: tuple[str, ...]
    valid_from: str
    valid_to: str
    current_flag: str | None  # without one, a version is current while its end is NULL
    open_end: str | None  # end of a current version
    first_valid_from: str | None  # column that dates the first version of a key, if any
    closes_absent: bool  # does a key missing from the batch lose its current version?
    updated_at: str | None = None  # records the run that opened a version
    any_order: bool = False  # may batches come late? (``operators.splicing``)

    def validity_types(self) -> dict[str, str]:
        types = {self.valid_from: "timestamp", self.valid_to: "timestamp"}
        if self.current_flag:
            types[self.current_flag] = "boolean"
        if self.updated_at:
            types[self.updated_at] = "timestamp"
        return types

    def is_current(self) -> Column:
        return F.col(self.current_flag) if self.current_flag else F.col(self.valid_to).isNull()


# The silver dimension dates first versions by registration, and keeps vanished customers.
SILVER_CUSTOMERS = HistoryRules(
    key="customer_id",
    tracked=TRACKED_CUSTOMER_COLUMNS,
    valid_from="effective_from",
    valid_to="effective_to",
    current_flag="is_current",
    open_end=OPEN_END,
    first_valid_from="registration_date",
    closes_absent=False,
)

# The warehouse snapshot dates versions by run time, and closes vanished customers.
CUSTOMER_SNAPSHOT = replace(
    SILVER_CUSTOMERS,
    valid_from="dbt_valid_from",
    valid_to="dbt_valid_to",
    current_flag=None,
    open_end=None,
    first_valid_from=None,
    closes_absent=True,
    updated_at="dbt_updated_at",
)


def first_load(incoming: DataFrame, rules: HistoryRules, at=None) -> DataFrame:
    """The dimension after its first batch: every record opens a version."""
    validity = _opened(rules, moment(at), first=True)
    return incoming.withColumns(validity)


def merge_batch(current: DataFrame, incoming: DataFrame, rules: HistoryRules, at=None) -> DataFrame:
    """Current and newly closed versions after a batch.

    ``current`` holds the current versions and ``incoming`` one record per key.
    A record equal in all tracked columns keeps the stored version as it is;
    columns that only one side has are NULL in rows from the other.
    """
    now = moment(at)
    columns = union_columns(current, incoming, rules)
    stored = current.select(rules.key, _as_struct(current, columns, "stored"))
    arrived = incoming.select(rules.key, _as_struct(incoming, columns, "arrived"))
    paired = stored.join(arrived, rules.key, "full_outer")

    keep = F.col("stored")
    close = _with_fields("stored", columns, _closed(rules, now))
    reopen = _with_fields("arrived", columns, _opened(rules, now, first=False))
    insert = _with_fields("arrived", columns, _opened(rules, now, first=True, of="arrived"))
    changed = differs("stored", "arrived", rules.tracked)

    versions = (
        F.when(F.col("stored").isNull(), F.array(insert))
        .when(F.col("arrived").isNull(), F.array(close if rules.closes_absent else keep))
        .when(changed, F.array(close, reopen))
        .otherwise(F.array(keep))
    )
    return paired.select(F.inline(versions))


def merge_history(dimension: DataFrame, incoming: DataFrame, rules: HistoryRules, at=None) -> DataFrame:
    """The whole dimension after a batch; versions closed earlier pass by unshuffled."""
    closed = dimension.filter(~rules.is_current())
    merged = merge_batch(dimension.filter(rules.is_current()), incoming, rules, at)
    return closed.unionByName(merged, allowMissingColumns=True)


def changed_keys(current: DataFrame, incoming: DataFrame, rules: HistoryRules) -> DataFrame:
    """Keys on both sides whose tracked columns differ."""
    left = current.select(rules.key, F.struct(*rules.tracked).alias("stored"))
    right = incoming.select(rules.key, F.struct(*rules.tracked).alias("arrived"))
    return (
        left.join(right, rules.key).filter(differs("stored", "arrived", rules.tracked)).select(rules.key)
    )


def customer_dimension(snapshot: DataFrame) -> DataFrame:
    """Warehouse dimension: one row per customer version, with a surrogate key."""
    return snapshot.select(
        surrogate_key("customer_id", "dbt_valid_from").alias("customer_key"),
        *["customer_id", "first_name", "last_name", "email", "phone", "address", "city", "state"],
        *["zip_code", "country", "gender", "income_bracket", "registration_date", "birth_date"],
        *["is_churned", "churn_date"],
        F.col("dbt_valid_from").alias("effective_from"),
        F.col("dbt_valid_to").alias("effective_to"),
        CUSTOMER_SNAPSHOT.is_current().alias("is_current"),
        F.col("dbt_updated_at").alias("last_updated_at"),
    )


def _opened(rules: HistoryRules, now: Column, first: bool, of: str | None = None) -> dict[str, Column]:
    start = now
    if first and rules.first_valid_from:
        own = F.col(f"{of}.{rules.first_valid_from}" if of else rules.first_valid_from)
        start = F.coalesce(own.cast("timestamp"), now)
    validity = {rules.valid_from: start, rules.valid_to: F.lit(rules.open_end).cast("timestamp")}
    if rules.current_flag:
        validity[rules.current_flag] = F.lit(True)
    if rules.updated_at:
        validity[rules.updated_at] = now
    return validity


def _closed(rules: HistoryRules, now: Column) -> dict[str, Column]:
    validity = {rules.valid_to: now}
    if rules.current_flag:
        validity[rules.current_flag] = F.lit(False)
    return validity


def union_columns(current: DataFrame, incoming: DataFrame, rules: HistoryRules) -> dict[str, str]:
    """Names and types of the union of both sides; where they differ, the least common type (``sources.evolution``)."""
    both = {f.name: f.dataType.simpleString() for f in common_schema([current.schema, incoming.schema]).fields}
    kinds = {**dict(incoming.dtypes), **rules.validity_types(), **dict(current.dtypes)}
    return {name: both.get(name, kind) if name not in rules.validity_types() else kind for name, kind in kinds.items()}


def _as_struct(df: DataFrame, columns: dict[str, str], name: str) -> Column:
    present = set(df.columns)
    fields = [
        f"CAST({f'`{c}`' if c in present else 'NULL'} AS {kind}) AS `{c}`" for c, kind in columns.items()
    ]
    return F.expr(f"struct({', '.join(fields)})").alias(name)


def _with_fields(source: str, columns: dict[str, str], values: dict[str, Column]) -> Column:
    """The struct ``source`` with some fields replaced, in the same field order and types."""
    out = F.col(source)
    for name, value in values.items():
        out = out.withField(f"`{name}`", value.cast(columns[name]))
    return out

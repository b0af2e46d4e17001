"""Silver tables to the four gold aggregates, as Parquet and CSV."""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marlstone.entities import choose
from marlstone.operators import gold
from marlstone.plans.outcomes import Outcome, run_each
from marlstone.plans.silver_job import read_silver
from marlstone.plans.silver_update import Changes, changes_since
from marlstone.sources.readers import locate
from marlstone.sources.scratch import exists
from marlstone.sources.writers import refresh_gold, write_gold


def daily_revenue(spark: SparkSession, silver_base: str, as_of=None, months=None) -> DataFrame:
    return gold.daily_revenue_by_category(
        read_silver(spark, silver_base, "orders", months),
        read_silver(spark, silver_base, "order_items"),
        read_silver(spark, silver_base, "products"),
    )


def lifetime_value(spark: SparkSession, silver_base: str, as_of=None, months=None) -> DataFrame:
    return gold.customer_lifetime_value(
        read_silver(spark, silver_base, "orders"),
        read_silver(spark, silver_base, "order_items"),
        read_silver(spark, silver_base, "customers"),
        as_of,
    )


def funnel(spark: SparkSession, silver_base: str, as_of=None, months=None) -> DataFrame:
    return gold.conversion_funnel(read_silver(spark, silver_base, "orders", months))


def cohort(spark: SparkSession, silver_base: str, as_of=None, months=None) -> DataFrame:
    return gold.cohort_retention(read_silver(spark, silver_base, "orders"))


# name -> (builder, table, partition columns, order within a file)
AGGREGATES = {
    "daily_revenue": (
        daily_revenue,
        "daily_revenue_by_category",
        ("order_year", "order_month"),
        ("order_date", "category", "sub_category"),
    ),
    "clv": (lifetime_value, "customer_lifetime_value", (), ()),
    "funnel": (funnel, "conversion_funnel", ("order_year", "order_month"), ("status",)),
    "cohort": (cohort, "cohort_retention", ("cohort_year", "cohort_month_num"), ("period_number",)),
}


def build_aggregate(
    spark: SparkSession,
    name: str,
    silver_base: str,
    gold_base: str,
    csv_dir: str | None = None,
    as_of=None,
    months=None,
) -> int:
    """Build and store one aggregate; returns the number of rows built.

    ``months``, a first and a last (year, month) or a frozenset of months, refreshes only those partitions of a stored monthly aggregate; a
    month without rows any more is emptied, the others stay.  The CSV export is then taken from the whole table.
    Aggregates that need all history cannot be refreshed by month.
    """
    build, table, partition_by, sort_by = AGGREGATES[name]
    if months is not None and partition_by != ("order_year", "order_month"):
        raise ValueError(f"{name} needs all months")
    df = build(spark, silver_base, as_of, months)
    path = locate(gold_base, table)
    if months is None or not exists(spark, path):
        return write_gold(df, table, gold_base, csv_dir, partition_by, sort_by)
    return refresh_gold(df, table, gold_base, csv_dir, months, sort_by)


#: The silver tables that each aggregate is made from.
SOURCES = {
    "daily_revenue": ("orders", "order_items", "products"),
    "clv": ("orders", "order_items", "customers"),
    "funnel": ("orders",),
    "cohort": ("orders",),
}
STATE, RECORD = "_state", "refresh bigint, runs string"


@dataclass(frozen=True)
class Refresh:
    """What a refresh did: rows built and the months replaced, None for the whole table."""

    rows: int
    months: frozenset | None


def refresh_aggregate(
    spark: SparkSession, name: str, silver_base: str, gold_base: str, csv_dir: str | None = None, as_of=None
) -> Refresh:
    """Bring one aggregate up to date with the silver runs since its last refresh.

    The months to replace follow from the notes of ``silver_update``: months of changed orders, and of the orders that
    changed lines belong to or whose products changed.  The first refresh, one after a silver run over all batches, one
    after a change of orders without a month, and those of aggregates that need all history build the whole table;
    nothing is built if nothing changed, but lifetime values, which depend on the day, always are.  Silver tables have
    to be kept by incremental runs only; rows that other jobs changed are not noticed.
    """
    log = locate(gold_base, STATE, name)
    seen, number = {}, 0
    if exists(spark, log) and exists(spark, locate(gold_base, AGGREGATES[name][1])):
        last = spark.read.schema(RECORD).json(log).orderBy(F.desc("refresh")).first()
        seen, number = json.loads(last.runs), last.refresh
    # Read before the tables: what a silver run changes meanwhile is refreshed again next time.
    changes = {entity: changes_since(spark, silver_base, entity, seen.get(entity)) for entity in SOURCES[name]}
    monthly = AGGREGATES[name][2] == ("order_year", "order_month")
    months = None
    if not any(c.whole for c in changes.values()):
        months = changed_months(spark, silver_base, changes) if monthly else None
        if name != "clv" and all(c.noted is None for c in changes.values()):
            return Refresh(0, frozenset())
    if months is not None and any(None in month for month in months):
        months = None
    rows = 0 if months == frozenset() else build_aggregate(spark, name, silver_base, gold_base, csv_dir, as_of, months)
    runs = json.dumps({entity: c.run for entity, c in changes.items()})
    record = spark.createDataFrame([(number + 1, runs)], RECORD)
    record.coalesce(1).write.mode("append").json(log)
    return Refresh(rows, months)


def changed_months(spark: SparkSession, silver_base: str, changes: dict[str, Changes]) -> frozenset:
    """Months of orders that the noted changes of silver tables concern; there are as many as partitions at most."""
    noted = {entity: c.noted for entity, c in changes.items() if c.noted is not None}
    found = [noted["orders"].select(*gold.MONTH_KEYS)] if "orders" in noted else []
    lines = [noted["order_items"].select("order_id")] if "order_items" in noted else []
    if "products" in noted:
        items = read_silver(spark, silver_base, "order_items")
        lines.append(items.join(noted["products"], "product_id", "left_semi").select("order_id"))
    for ids in lines:
        orders = read_silver(spark, silver_base, "orders")
        found.append(orders.join(ids, "order_id", "left_semi").select(*gold.MONTH_KEYS))
    return frozenset(tuple(r) for months in found for r in months.distinct().collect())


def run_gold(
    spark: SparkSession, silver_base: str, gold_base: str, csv_dir=None, aggregates=None, incremental=False, **options
) -> list[Outcome]:
    """Build the chosen aggregates, or with ``incremental`` bring them up to date."""

    def build(name: str) -> int:
        if incremental:
            return refresh_aggregate(spark, name, silver_base, gold_base, csv_dir, options.get("as_of")).rows
        return build_aggregate(spark, name, silver_base, gold_base, csv_dir, **options)

    return run_each(choose(aggregates, AGGREGATES), build)

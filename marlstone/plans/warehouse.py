"""The warehouse models, from CSV files to marts."""

from __future__ import annotations

from contextlib import ExitStack
from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marlstone.operators import marts, quality
from marlstone.operators.history import CUSTOMER_SNAPSHOT, customer_dimension
from marlstone.operators.staging import STAGES
from marlstone.operators.suites import SUITES
from marlstone.plans.silver_job import run_snapshot
from marlstone.sources.readers import locate, read_csv
from marlstone.sources.scratch import dropping_shuffles, remove, scratch_parts
from marlstone.sources.writers import publish, write_table


#: Slices of orders in which models over many lines are computed, and bytes of stored lines that count as many.
SLICES, MANY_BYTES = 4, 32_000_000


def slices_of(lines: DataFrame) -> int:
    """In how many slices models over these stored lines are computed.

    One slice after the other divides the disk that the shuffles of a model take at once; each reads the tables again.
    """
    return SLICES if int(lines._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()) > MANY_BYTES else 1


def sliced(df: DataFrame, n: int, i: int) -> DataFrame:
    """Slice ``i`` of ``n``: all rows of some orders."""
    return df if n == 1 else df.filter(F.pmod(F.xxhash64("order_id"), F.lit(n)) == i)


def staging_views(spark: SparkSession, samples_path: str, store: str | None = None, consume: bool = False) -> dict[str, DataFrame]:
    """``<samples_path>/<entity>_sample.csv`` as the views ``stg_<entity>``, over tables in the folder ``store`` if given.

    With ``consume`` each file is removed once its rows are stored.
    """
    staged = {}
    for name, stage in STAGES.items():
        source = locate(samples_path, f"{name}_sample.csv")
        staged[name] = publish(
            stage(read_csv(spark, source)), f"stg_{name}", locate(store, f"stg_{name}") if store else None
        )
        if store and consume:
            remove(spark, source)
    return staged


def build_warehouse(
    spark: SparkSession, samples_path: str, warehouse: str, batch_id: str, at: datetime, as_of=None, *, store_staging: bool = False, consume_samples: bool = False
) -> dict[str, DataFrame]:
    """Staging and intermediate views, the customer snapshot, and the stored marts.

    Staging views parse the CSV files whenever they are read.  With ``store_staging`` each file is parsed once and its
    rows are stored: worth it where all models are read, as by checks; text that does not fit its type then stops the
    build rather than the first reader of its column.  With ``consume_samples`` as well, files are removed once stored.
    """
    with dropping_shuffles(spark):
        staged = staging_views(spark, samples_path, locate(warehouse, "staging") if store_staging else None, consume_samples)
        snapshot = run_snapshot(
            staged["customers"],
            locate(warehouse, "snapshots", "customers_snapshot"),
            CUSTOMER_SNAPSHOT,
            batch_id,
            at,
        )
    orders, items, products = staged["orders"], staged["order_items"], staged["products"]
    models = {f"stg_{name}": df for name, df in staged.items()}
    models["int_order_enriched"] = publish(
        marts.order_enriched(orders, items, products), "int_order_enriched"
    )
    models["int_customer_360"] = publish(
        marts.customer_360(staged["customers"], orders, items, products, as_of), "int_customer_360"
    )
    n = slices_of(items) if store_staging else 1
    with dropping_shuffles(spark), ExitStack() as stack:
        if n > 1:
            totals = [marts.daily_totals(sliced(orders, n, i), sliced(items, n, i), products) for i in range(n)]
            daily = marts.daily_measures(marts.added_totals(stack.enter_context(scratch_parts(totals, "daily-totals"))))
        else:
            daily = marts.daily_revenue(orders, items, products)
        tables = {
            "fct_daily_revenue": daily,
            "fct_conversion_funnel": marts.monthly_funnel(orders),
            "dim_products": marts.product_dimension(products),
            "dim_customers": customer_dimension(snapshot),
        }
        for name, df in tables.items():
            models[name] = publish(df, name, locate(warehouse, "marts", name))
    return models


class ChecksFailed(Exception):
    """Models break some of their checks."""


def check_warehouse(models: dict[str, DataFrame], warehouse: str, batch_id: str, slices: int = 1) -> DataFrame:
    """Run all checks of the models, 127 declared ones and three of their own, and store the report of the batch.

    The intermediate models are views over joins, so they are written out for the time of the checks; every check
    reads stored rows.  Of columns that are only checked for missing values no more is stored than that.  The enriched
    lines are computed in ``slices`` of orders, one after the other.  Returns (model, check_name, column_name, failures).
    """
    with dropping_shuffles(next(iter(models.values())).sparkSession), ExitStack() as stack:
        stored = dict(models)
        for name, n in (("int_customer_360", 1), ("int_order_enriched", slices)):
            suite = SUITES[name]
            read = {*suite.unique, *suite.accepted_values}
            checked = [
                sliced(models[name], n, i).select(*[
                    F.col(c) if c in read else F.when(F.col(c).isNotNull(), True).alias(c)
                    for c in models[name].columns if c in read or c in suite.not_null
                ])
                for i in range(n)
            ]
            stored[name] = stack.enter_context(scratch_parts(checked, f"checked-{name}"))
        report = reduce(
            DataFrame.unionAll,
            [
                quality.check_models(stored, SUITES),
                quality.check_rows("dim_customers", "one_current", quality.not_one_current(stored["dim_customers"]), "customer_id"),
                quality.check_rows("stg_orders", "total_positive", quality.nonpositive_totals(stored["stg_orders"]), "total"),
                quality.check_rows("fct_daily_revenue", "share_is_100", quality.unbalanced_days(stored["fct_daily_revenue"]), "revenue_share_pct"),
            ],
        )
        return write_table(report.coalesce(1), locate(warehouse, "checks", f"batch=id-{batch_id}"))


def require_checks(report: DataFrame) -> int:
    """Raise ``ChecksFailed`` naming the checks that fail; returns the number of checks."""
    rows = report.collect()  # one row a check
    broken = sorted(f"{r.model}.{r.check_name}({r.column_name}): {r.failures}" for r in rows if r.failures)
    if broken:
        raise ChecksFailed(f"{len(broken)} of {len(rows)} checks fail: " + "; ".join(broken))
    return len(rows)

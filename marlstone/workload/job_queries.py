"""Whole jobs: files written, processed layer by layer, and read back."""

from __future__ import annotations

from dataclasses import replace
from datetime import datetime, timezone

from pyspark.sql import functions as F

from marlstone.entities import ENTITIES
from marlstone.operators.history import CUSTOMER_SNAPSHOT, SILVER_CUSTOMERS
from marlstone.operators.staging import stage_orders
from marlstone.operators.suites import SUITES
from marlstone.plans.bronze_job import QUARANTINE, ingest_entity, ingest_frame
from marlstone.plans.documents_job import flatten_documents, report_documents
from marlstone.plans.gold_job import AGGREGATES, build_aggregate, refresh_aggregate
from marlstone.plans.silver_job import merge_into, process_entity, read_history, read_silver
from marlstone.plans.silver_update import update_entity
from marlstone.plans.warehouse import build_warehouse, check_warehouse, slices_of
from marlstone.sources.readers import locate, read_csv
from marlstone.sources.scratch import new_path, written
from marlstone.sources.writers import (
    export_sample,
    read_batches,
    replace_months,
    write_csv,
    write_table,
)
from marlstone.streaming.arrivals import ingest_arrivals
from marlstone.workload import gold_queries, mart_queries, silver_queries
from marlstone.workload.inputs import AS_OF, BATCH_TIMES, batch, load, order_documents
from marlstone.workload.registry import query, whole, with_inputs

STAMPS = "'orders.json' AS _source_file"
VALID_SQL = f"""SELECT *, {silver_queries.MONTHS_SQL}, {silver_queries.LATE_SQL}, {STAMPS}
    FROM coerced WHERE {silver_queries.COMPLETE}"""


def _at(number: int) -> datetime:
    return datetime.fromisoformat(BATCH_TIMES[number]).replace(tzinfo=timezone.utc)


def _json_source(spark, folder, name: str) -> str:
    """The raw input of an entity as a folder of JSON files."""
    path = new_path(spark, f"raw-{name}")
    load(spark, folder, f"raw_{name}").write.json(locate(path, f"{name}.json"))
    return path


def _bronze(spark, folder, name: str) -> str:
    source, base = _json_source(spark, folder, name), new_path(spark, "bronze")
    ingest_entity(
        spark, name, locate(source, f"{name}.json"), base, "b-1", as_of=AS_OF, ingested_at=BATCH_TIMES[1]
    )
    return base


@query("bronze_job_orders", with_inputs(VALID_SQL, "raw_orders", coerced=silver_queries.COERCED_SQL))
def bronze_job_orders(spark, folder):
    return read_batches(spark, _bronze(spark, folder, "orders"), "orders").drop("_ingested_at", "_batch_id")


@query(
    "bronze_job_quarantine",
    with_inputs(
        f"""SELECT * EXCLUDE (channel), channel, {STAMPS}, 'b-1' AS _batch_id
            FROM coerced WHERE NOT ({silver_queries.COMPLETE})""",
        "raw_orders",
        coerced=silver_queries.COERCED_SQL,
    ),
)
def bronze_job_quarantine(spark, folder):
    base = locate(_bronze(spark, folder, "orders"), QUARANTINE)
    return read_batches(spark, base, "orders").drop("_ingested_at", "_corrupt_record")


STREAM_SCHEMA = (
    "order_id string, customer_id bigint, order_date string, order_timestamp string, status string, "
    "payment_method string, shipping_city string, shipping_state string, shipping_zip string, "
    "subtotal double, shipping_cost double, tax double, total double, channel string"
)


@query("stream_bronze_orders", with_inputs(VALID_SQL, "raw_orders", coerced=silver_queries.COERCED_SQL))
def stream_bronze_orders(spark, folder):
    source, base = _json_source(spark, folder, "orders"), new_path(spark, "bronze-stream")
    arrivals = ingest_arrivals(
        spark,
        "orders",
        locate(source, "orders.json"),
        base,
        new_path(spark, "stream-state"),
        schema=STREAM_SCHEMA,
        as_of=AS_OF,
        ingested_at=BATCH_TIMES[1],
    )
    arrivals.awaitTermination()
    return read_batches(spark, base, "orders").drop("_ingested_at", "_batch_id")


def _silver(spark, folder, name: str):
    base = new_path(spark, "silver")
    process_entity(spark, name, _bronze(spark, folder, name), base, null_limit=50.0, processed_at=_at(1))
    return read_silver(spark, base, name).drop("_silver_processed_at")


@query(
    "silver_job_orders",
    with_inputs(
        silver_queries.CLEAN_ORDERS_SQL,
        "raw_orders",
        all_rows=silver_queries.COERCED_SQL,
        coerced=f"SELECT * FROM all_rows WHERE {silver_queries.COMPLETE}",
    ),
)
def silver_job_orders(spark, folder):
    return _silver(spark, folder, "orders")


# Equal ids arrive in one batch here, so the first row in column order survives.
_ITEMS_SQL = f"""SELECT * FROM ({silver_queries.CLEAN_ITEMS_SQL.replace('e_raw_order_items', 'firsts')})"""


@query(
    "silver_job_order_items",
    with_inputs(
        _ITEMS_SQL,
        "raw_order_items",
        firsts=f"""SELECT * FROM e_raw_order_items QUALIFY row_number() OVER (PARTITION BY order_item_id
            ORDER BY discount_pct NULLS LAST, line_total NULLS LAST, {whole('product_id')},
              {whole('quantity')}, unit_price) = 1""",
    ),
)
def silver_job_order_items(spark, folder):
    return _silver(spark, folder, "order_items")


@query("silver_job_products", with_inputs(silver_queries.CLEAN_PRODUCTS_SQL, "raw_products"))
def silver_job_products(spark, folder):
    return _silver(spark, folder, "products")


@query(
    "silver_job_customers",
    with_inputs(
        f"""SELECT *, strftime(CAST(registration_date AS TIMESTAMP), '%Y-%m-%d %H:%M:%S') AS effective_from,
              '9999-12-31 00:00:00' AS effective_to, true AS is_current
            FROM ({silver_queries.CLEAN_CUSTOMERS_SQL}) WHERE email IS NOT NULL""",
        "raw_customers",
    ),
)
def silver_job_customers(spark, folder):
    return _silver(spark, folder, "customers")


# Batch 2 returns the orders of some months.  Batch 3 was taken before batch 2 and arrives after it: it dates some orders
# anew, but those of March are known more recently.
RETURNED, REDATED = "order_date LIKE '1997-0%'", "order_date LIKE '1998-01%'"
NEW_DATE = "1998-02-11"


REVISED_PARTS = {
    "revised": f"""SELECT * REPLACE (CASE WHEN {RETURNED} THEN 'Returned' ELSE status END AS status,
        CASE WHEN {REDATED} THEN '{NEW_DATE}' ELSE order_date END AS order_date) FROM e_raw_orders""",
    "all_rows": silver_queries.COERCED_SQL.replace("e_raw_orders", "revised"),
    "coerced": f"SELECT * FROM all_rows WHERE {silver_queries.COMPLETE}",
}


def _revised_orders(spark, folder, bronze, silver):
    """Three batches, each brought into silver before the next arrives; yields after each.

    The two that hold some orders only are stored first, as a batch arrives: ingestion reads its input several times.
    """
    raw = load(spark, folder, "raw_orders")
    batches = [
        (raw, 1),
        (written(raw.filter(RETURNED).withColumn("status", F.lit("Returned")), "raw-orders"), 3),
        (written(raw.filter(f"order_date LIKE '1997-03%' OR {REDATED}").withColumn("order_date", F.lit(NEW_DATE)), "raw-orders"), 2),
    ]
    for number, (rows, taken) in enumerate(batches, 1):
        ingest_frame(rows, ENTITIES["orders"], bronze, f"b-{number}", as_of=AS_OF, ingested_at=BATCH_TIMES[taken])
        yield update_entity(spark, "orders", bronze, silver, null_limit=50.0, processed_at=_at(number))


@query("silver_job_incremental", with_inputs(silver_queries.CLEAN_ORDERS_SQL, "raw_orders", **REVISED_PARTS))
def silver_job_incremental(spark, folder):
    bronze, silver = new_path(spark, "bronze"), new_path(spark, "silver")
    for _ in _revised_orders(spark, folder, bronze, silver):
        pass
    return read_silver(spark, silver, "orders").drop("_silver_processed_at")


@query(
    "gold_job_incremental",
    with_inputs(
        gold_queries.FUNNEL_BODY,
        "raw_orders",
        **REVISED_PARTS,
        e_orders=silver_queries.CLEAN_ORDERS_SQL,
        **gold_queries.FUNNEL_PARTS,
    ),
)
def gold_job_incremental(spark, folder):
    """The same batches; after each, the funnel is refreshed in the months that silver changed."""
    bronze, silver, gold = new_path(spark, "bronze"), new_path(spark, "silver"), new_path(spark, "gold")
    for _ in _revised_orders(spark, folder, bronze, silver):
        refresh_aggregate(spark, "funnel", silver, gold)
    return spark.read.parquet(locate(gold, "conversion_funnel"))


@query(
    "silver_job_evolution",
    with_inputs(
        f"""SELECT *, strftime(CAST(registration_date AS TIMESTAMP), '%Y-%m-%d %H:%M:%S') AS effective_from,
              '9999-12-31 00:00:00' AS effective_to, true AS is_current,
              CASE customer_id % 3 WHEN 1 THEN CAST(customer_id % 7 AS VARCHAR) WHEN 2 THEN 'tier ' || customer_id % 5 END AS loyalty,
              CASE customer_id % 3 WHEN 0 THEN CAST(customer_id % 10 AS DOUBLE) WHEN 1 THEN customer_id % 10 + 0.5 END AS points
            FROM ({silver_queries.CLEAN_CUSTOMERS_SQL}) WHERE email IS NOT NULL""",
        "raw_customers",
    ),
)
def silver_job_evolution(spark, folder):
    """A column without values, then numbers, then text; another whole, then fractional, then without values."""
    bronze, silver = new_path(spark, "bronze"), new_path(spark, "silver")
    raw, key = load(spark, folder, "raw_customers"), F.col("customer_id").cast("long")
    batches = [
        raw.withColumns({"loyalty": F.lit(None).cast("string"), "points": key % 10}),
        raw.filter(key % 3 >= 1).withColumns({"loyalty": key % 7, "points": key % 10 + 0.5}),
        raw.filter(key % 3 == 2).withColumns({"loyalty": F.concat(F.lit("tier "), (key % 5).cast("string")), "points": F.lit(None).cast("double")}),
    ]
    for number, rows in enumerate(batches, 1):
        path = locate(new_path(spark, "raw-customers"), "customers.json")
        rows.write.option("ignoreNullFields", False).json(path)
        ingest_entity(spark, "customers", path, bronze, f"b-{number}", ingested_at=BATCH_TIMES[number])
    process_entity(spark, "customers", bronze, silver, null_limit=50.0, processed_at=_at(1))
    return read_silver(spark, silver, "customers").drop("_silver_processed_at")


def _merged_batches(spark, folder, rules):
    base = new_path(spark, "history")
    for number in BATCH_TIMES:
        merge_into(batch(spark, folder, number), base, rules, f"b-{number}", _at(number))
    # The last batch again: nothing may change.
    merge_into(batch(spark, folder, 3), base, rules, "b-3", _at(3))
    return read_history(spark, base, rules)


@query("history_job_silver", silver_queries.SILVER_HISTORY_SQL)
def history_job_silver(spark, folder):
    return _merged_batches(spark, folder, SILVER_CUSTOMERS)


@query("history_job_snapshot", silver_queries.SNAPSHOT_SQL)
def history_job_snapshot(spark, folder):
    return _merged_batches(spark, folder, CUSTOMER_SNAPSHOT)


def _late_batches(spark, folder, rules, order):
    base = new_path(spark, "history")
    for number in order:
        merge_into(batch(spark, folder, number), base, replace(rules, any_order=True), f"b-{number}", _at(number))
    return read_history(spark, base, rules)


@query("history_job_late_batches", silver_queries.SILVER_HISTORY_SQL)
def history_job_late_batches(spark, folder):
    return _late_batches(spark, folder, SILVER_CUSTOMERS, (3, 1, 2))


@query("history_job_late_snapshots", silver_queries.SNAPSHOT_SQL)
def history_job_late_snapshots(spark, folder):
    return _late_batches(spark, folder, CUSTOMER_SNAPSHOT, (2, 3, 1))


def _gold(spark, folder, name: str, *entities: str):
    """A gold aggregate from stored silver tables, read back from its CSV export."""
    silver, gold, csv = (new_path(spark, label) for label in ("silver", "gold", "csv"))
    for entity in entities:
        rows, target = load(spark, folder, entity), locate(silver, entity)
        if entity == "orders":
            write_table(rows, target, ("order_year", "order_month"))
        elif entity == "customers":
            merge_into(rows.filter("is_current").drop("is_current"), target, SILVER_CUSTOMERS, "b-1", _at(1))
        else:
            write_table(rows, target)
    build_aggregate(spark, name, silver, gold, csv, as_of=AS_OF)
    table = AGGREGATES[name][1]
    stored = spark.read.parquet(locate(gold, table))
    kinds = dict(stored.dtypes)
    exported = read_csv(spark, locate(csv, table))
    return exported.select(*[F.col(c).cast(kinds[c]).alias(c) for c in exported.columns])


@query("gold_job_daily_revenue", gold_queries.DAILY_SQL)
def gold_job_daily_revenue(spark, folder):
    return _gold(spark, folder, "daily_revenue", "orders", "order_items", "products")


@query("gold_job_clv", gold_queries.LIFETIME_SQL)
def gold_job_clv(spark, folder):
    return _gold(spark, folder, "clv", "orders", "order_items", "customers")


@query("gold_job_funnel", gold_queries.FUNNEL_SQL)
def gold_job_funnel(spark, folder):
    return _gold(spark, folder, "funnel", "orders")


@query("gold_job_months", gold_queries.FUNNEL_SQL)
def gold_job_months(spark, folder):
    """A full build over orders that are wrong in two years, then a refresh of those years with the right ones."""
    silver, gold, keys = new_path(spark, "silver"), new_path(spark, "gold"), ("order_year", "order_month")
    orders = load(spark, folder, "orders")
    wrong = orders.withColumn("status", F.when(F.col("order_year").isin(1996, 1997), "wrong").otherwise(F.col("status")))
    write_table(wrong, locate(silver, "orders"), keys)
    build_aggregate(spark, "funnel", silver, gold)
    write_table(orders, locate(silver, "orders"), keys)
    build_aggregate(spark, "funnel", silver, gold, months=((1996, 1), (1997, 12)))
    return spark.read.parquet(locate(gold, "conversion_funnel"))


@query("gold_job_cohort", gold_queries.COHORT_SQL)
def gold_job_cohort(spark, folder):
    return _gold(spark, folder, "cohort", "orders")


@query(
    "month_range",
    with_inputs(
        f"""SELECT {whole('order_year')} AS order_year, {whole('order_month')} AS order_month,
              count(*) AS orders FROM e_orders
            WHERE order_date >= DATE '1996-11-01' AND order_date < DATE '1998-03-01' GROUP BY ALL""",
        "orders",
    ),
)
def month_range(spark, folder):
    silver = new_path(spark, "silver")
    write_table(load(spark, folder, "orders"), locate(silver, "orders"), ("order_year", "order_month"))
    kept = read_silver(spark, silver, "orders", months=((1996, 11), (1998, 2)))
    return kept.groupBy("order_year", "order_month").agg(F.count(F.lit(1)).alias("orders"))


@query(
    "replace_partitions",
    with_inputs(
        """SELECT order_id, status, CASE WHEN order_year = 1998 THEN total * 2 ELSE total END AS total,
             CAST(order_year AS BIGINT) AS order_year, CAST(order_month AS BIGINT) AS order_month
           FROM e_orders""",
        "orders",
    ),
)
def replace_partitions(spark, folder):
    path, keys = new_path(spark, "orders"), ("order_year", "order_month")
    orders = load(spark, folder, "orders").select("order_id", "status", "total", *keys)
    write_table(orders, path, keys)
    rebuilt = orders.filter("order_year = 1998").withColumn("total", F.col("total") * 2)
    replace_months(rebuilt, path, keys)
    return spark.read.parquet(path)


@query("csv_staging", with_inputs(mart_queries.STAGED_ORDERS_SQL, "source_orders"))
def csv_staging(spark, folder):
    path = new_path(spark, "orders-csv")
    write_csv(load(spark, folder, "source_orders"), path)
    return stage_orders(read_csv(spark, path))


@query(
    "csv_sample",
    with_inputs(
        "SELECT order_id, customer_id, status, total FROM e_orders ORDER BY order_id LIMIT 10000", "orders"
    ),
)
def csv_sample(spark, folder):
    path = new_path(spark, "sample")
    orders = load(spark, folder, "orders").select("order_id", "customer_id", "status", "total")
    export_sample(orders.withColumn("_weight", F.col("total") * 2), path, ["order_id"], rows=10_000)
    rows = read_csv(spark, path)
    return rows.select(*[F.col(c).cast(t).alias(c) for c, t in orders.dtypes])


def _warehouse(spark, folder, **options) -> dict:
    """The warehouse models built from CSV files."""
    samples = new_path(spark, "samples")
    inputs = {
        "customers": "raw_customers",
        "orders": "source_orders",
        "order_items": "raw_order_items",
        "products": "raw_products",
    }
    for name, source in inputs.items():
        export_sample(load(spark, folder, source), locate(samples, f"{name}_sample.csv"), [])
    return build_warehouse(spark, samples, new_path(spark, "warehouse"), "run-1", _at(1), AS_OF, **options)


_STAGED_INPUTS = {
    "e_orders": mart_queries.STAGED_ORDERS_SQL,
    "e_order_items": mart_queries.STAGED_ITEMS_SQL,
    "e_products": mart_queries.STAGED_PRODUCTS_SQL,
}


@query(
    "warehouse_job_daily_revenue",
    with_inputs(
        mart_queries.FCT_DAILY_SQL,
        "source_orders",
        "raw_order_items",
        "raw_products",
        **_STAGED_INPUTS,
        **mart_queries.FCT_DAILY_PARTS,
    ),
)
def warehouse_job_daily_revenue(spark, folder):
    return _warehouse(spark, folder)["fct_daily_revenue"]


@query(
    "warehouse_job_customers",
    with_inputs(
        f"""SELECT md5(customer_id || '-{BATCH_TIMES[1]}') AS customer_key, *,
              '{BATCH_TIMES[1]}' AS effective_from, CAST(NULL AS VARCHAR) AS effective_to,
              true AS is_current, '{BATCH_TIMES[1]}' AS last_updated_at
            FROM ({mart_queries.STAGED_CUSTOMERS_SQL})""",
        "raw_customers",
    ),
)
def warehouse_job_customers(spark, folder):
    return _warehouse(spark, folder)["dim_customers"]


def _nested(body: str, **parts: str) -> str:
    return f"WITH {', '.join(f'{name} AS ({sql})' for name, sql in parts.items())} {body}"


_STAGED_MODELS = {**_STAGED_INPUTS, "e_customers": mart_queries.STAGED_CUSTOMERS_SQL}
_MODEL_SQL = {
    "stg_customers": "SELECT * FROM e_customers",
    "stg_products": "SELECT * FROM e_products",
    "stg_orders": "SELECT * FROM e_orders",
    "stg_order_items": "SELECT * FROM e_order_items",
    # The staged timestamp is text already.
    "int_order_enriched": mart_queries.ENRICHED_SQL.replace("strftime(order_timestamp, '%Y-%m-%d %H:%M:%S')", "order_timestamp"),
    "int_customer_360": _nested(
        mart_queries.PROFILE_SQL,
        stats=mart_queries.ORDER_STATS_SQL,
        units=mart_queries.UNITS_SQL,
        preferred=mart_queries.PREFERRED_SQL,
    ),
    "fct_daily_revenue": _nested(mart_queries.FCT_DAILY_SQL, **mart_queries.FCT_DAILY_PARTS),
    "fct_conversion_funnel": _nested(mart_queries.FCT_FUNNEL_SQL, **mart_queries.FCT_FUNNEL_PARTS),
    "dim_customers": f"""SELECT md5(customer_id || '-{BATCH_TIMES[1]}') AS customer_key, *, true AS is_current,
        '{BATCH_TIMES[1]}' AS effective_from, '{BATCH_TIMES[1]}' AS last_updated_at FROM e_customers""",
    "dim_products": mart_queries.DIM_PRODUCTS_SQL,
}


def _check_sql(model: str) -> list[str]:
    """One SELECT for each declared check of a model."""
    suite = SUITES[model]
    counts = [("not_null", c, f"count(*) FILTER (WHERE {c} IS NULL)") for c in suite.not_null]
    counts += [
        ("accepted_values", c, f"count(*) FILTER (WHERE {c} NOT IN {values})") for c, values in suite.accepted_values.items()
    ]
    out = [f"SELECT '{model}' AS model, '{kind}' AS check_name, '{c}' AS column_name, {n} AS failures FROM {model}" for kind, c, n in counts]
    for kind, columns in [("unique", (c,)) for c in suite.unique] + [("unique_combination", cs) for cs in suite.unique_combinations]:
        names, present = ", ".join(columns), "true" if len(columns) > 1 else f"{columns[0]} IS NOT NULL"
        twice = f"SELECT {names} FROM {model} WHERE {present} GROUP BY {names} HAVING count(*) > 1"
        out.append(f"SELECT '{model}', '{kind}', '{','.join(columns)}', count(*) FROM ({twice})")
    for c, (parent, key) in suite.references.items():
        out.append(
            f"SELECT '{model}', 'relationships', '{c}', count(*) FROM {model} AS m WHERE {c} IS NOT NULL "
            f"AND NOT EXISTS (SELECT 1 FROM {parent} AS p WHERE p.{key} = m.{c})"
        )
    return out


_OWN_CHECKS_SQL = [
    """SELECT 'dim_customers', 'one_current', 'customer_id', count(*) FROM (SELECT customer_id FROM dim_customers
        GROUP BY customer_id HAVING count(*) FILTER (WHERE is_current) <> 1)""",
    "SELECT 'stg_orders', 'total_positive', 'total', count(*) FROM stg_orders WHERE total <= 0",
    """SELECT 'fct_daily_revenue', 'share_is_100', 'revenue_share_pct', count(*) FROM (SELECT order_date FROM fct_daily_revenue
        GROUP BY order_date HAVING abs(sum(CAST(revenue_share_pct AS DECIMAL(9, 2))) - 100) > 1)""",
]


@query(
    "warehouse_job_checks",
    with_inputs(
        " UNION ALL ".join([sql for model in _MODEL_SQL for sql in _check_sql(model)] + _OWN_CHECKS_SQL),
        "raw_customers",
        "source_orders",
        "raw_order_items",
        "raw_products",
        **_STAGED_MODELS,
        **_MODEL_SQL,
    ),
)
def warehouse_job_checks(spark, folder):
    models = _warehouse(spark, folder, store_staging=True, consume_samples=True)
    return check_warehouse(models, new_path(spark, "warehouse"), "run-1", slices_of(models["stg_order_items"]))


def _documents(spark, folder):
    """The document pipeline run from JSON files to its reports."""
    source, silver, gold = (new_path(spark, label) for label in ("docs", "docs-silver", "docs-gold"))
    inputs = {
        "customers": load(spark, folder, "customer_documents"),
        "products": load(spark, folder, "product_documents"),
        "orders": order_documents(spark, folder),
    }
    for name, rows in inputs.items():
        rows.write.json(locate(source, name, f"{name}.json"))
    flatten_documents(spark, source, silver)
    return report_documents(spark, silver, gold)


_DOCUMENT_SQL = {
    "lines": mart_queries.order_document_lines_sql(),
}


@query(
    "document_job_categories",
    with_inputs(
        mart_queries.CATEGORY_REVENUE_SQL,
        "product_documents",
        known=mart_queries.DOCUMENT_PRODUCTS_SQL,
        **_DOCUMENT_SQL,
    ),
)
def document_job_categories(spark, folder):
    return _documents(spark, folder)["revenue_by_category"]


@query(
    "document_job_customers",
    with_inputs(
        mart_queries.SUMMARY_SQL,
        "customer_documents",
        known=mart_queries.DOCUMENT_CUSTOMERS_SQL,
        **_DOCUMENT_SQL,
    ),
)
def document_job_customers(spark, folder):
    return _documents(spark, folder)["customer_summary"]

"""Row-level ingestion and repair, deduplication, histories and checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from marlstone.entities import ENTITIES, ORDER_TYPES, TRACKED_CUSTOMER_COLUMNS
from marlstone.operators import bronze, history, marts, quality, silver, staging
from marlstone.operators.dedup import latest_per_key
from marlstone.operators.suites import SUITES
from marlstone.workload import mart_queries as sql
from marlstone.workload.inputs import (
    AS_OF,
    BATCH_COLUMNS,
    BATCH_TIMES,
    batch,
    batch_sql,
    load,
)
from marlstone.workload.registry import double, instant, query, whole, with_inputs

# Bronze ----------------------------------------------------------------------

# raw_orders after coercion
COERCED_SQL = """SELECT * REPLACE (TRY_CAST(order_id AS BIGINT) AS order_id) FROM e_raw_orders"""
COMPLETE = "order_id IS NOT NULL AND customer_id IS NOT NULL AND order_date IS NOT NULL"
DAY = "TRY_CAST(order_date AS DATE)"
MONTHS_SQL = f"year({DAY}) AS order_year, month({DAY}) AS order_month"
LATE_SQL = f"date_diff('day', {DAY}, DATE '{AS_OF}') > 7 AS _is_late"


def coerced_orders(spark, folder):
    return bronze.coerce(load(spark, folder, "raw_orders"), ORDER_TYPES)


@query("cast_known", with_inputs("SELECT * FROM coerced", "raw_orders", coerced=COERCED_SQL))
def cast_known(spark, folder):
    return coerced_orders(spark, folder)


@query(
    "validate_valid",
    with_inputs(f"SELECT * FROM coerced WHERE {COMPLETE}", "raw_orders", coerced=COERCED_SQL),
)
def validate_valid(spark, folder):
    return bronze.split_required(coerced_orders(spark, folder), ENTITIES["orders"].required)[0]


@query(
    "validate_quarantine",
    with_inputs(f"SELECT * FROM coerced WHERE NOT ({COMPLETE})", "raw_orders", coerced=COERCED_SQL),
)
def validate_quarantine(spark, folder):
    return bronze.split_required(coerced_orders(spark, folder), ENTITIES["orders"].required)[1]


@query(
    "partition_columns",
    with_inputs(f"SELECT order_id, order_date, {MONTHS_SQL} FROM e_raw_orders", "raw_orders"),
)
def partition_columns(spark, folder):
    rows = bronze.with_order_month(load(spark, folder, "raw_orders"), "order_date")
    return rows.select("order_id", "order_date", "order_year", "order_month")


@query("late_flag", with_inputs(f"SELECT order_id, order_date, {LATE_SQL} FROM e_raw_orders", "raw_orders"))
def late_flag(spark, folder):
    rows = bronze.flag_late(load(spark, folder, "raw_orders"), "order_date", AS_OF)
    return rows.select("order_id", "order_date", "_is_late")


@query(
    "ingest_stamps",
    with_inputs(
        f"""SELECT order_id, '2000-01-01 06:00:00' AS _ingested_at, 'orders.json' AS _source_file,
              'b-1' AS _batch_id FROM e_orders""",
        "orders",
    ),
)
def ingest_stamps(spark, folder):
    rows = bronze.stamp(load(spark, folder, "orders"), "orders.json", "b-1", BATCH_TIMES[1])
    return rows.select("order_id", "_ingested_at", "_source_file", "_batch_id")


# Deduplication and repair ----------------------------------------------------


@query(
    "dedup_latest",
    with_inputs(
        f"""SELECT order_item_id, order_id, product_id, {whole('quantity')} AS quantity, line_total,
              {instant('_ingested_at')} AS _ingested_at FROM e_order_items
            QUALIFY row_number() OVER (PARTITION BY order_item_id
              ORDER BY _ingested_at DESC, product_id, supplier_id) = 1""",
        "order_items",
    ),
)
def dedup_latest(spark, folder):
    items = load(spark, folder, "order_items")
    latest = latest_per_key(items, "order_item_id", tie_break=["product_id", "supplier_id"])
    return latest.select("order_item_id", "order_id", "product_id", "quantity", "line_total", "_ingested_at")


_STAMP = "TRY_CAST(order_timestamp AS TIMESTAMP)"
CLEAN_ORDERS_SQL = f"""SELECT order_id, customer_id, {DAY} AS order_date, {instant(_STAMP)} AS order_timestamp,
      CASE WHEN status IS NULL THEN 'pending' ELSE trim(lower(status)) END AS status,
      ifnull(payment_method, 'UNKNOWN') AS payment_method, ifnull(shipping_city, 'UNKNOWN') AS shipping_city,
      ifnull(shipping_state, 'UNKNOWN') AS shipping_state, ifnull(shipping_zip, '00000') AS shipping_zip,
      ifnull(subtotal, 0) AS subtotal, ifnull(shipping_cost, 0) AS shipping_cost, ifnull(tax, 0) AS tax,
      CASE WHEN total IS NULL THEN ifnull(subtotal, 0) + ifnull(shipping_cost, 0) + ifnull(tax, 0)
           ELSE total END AS total, {MONTHS_SQL}
    FROM coerced"""
CLEAN_ITEMS_SQL = f"""SELECT {whole('order_item_id')} AS order_item_id, {whole('order_id')} AS order_id,
      {whole('product_id')} AS product_id, {whole('quantity')} AS quantity, unit_price,
      ifnull(discount_pct, 0) AS discount_pct,
      CASE WHEN line_total IS NOT NULL THEN line_total
           ELSE {double('''round(CAST(quantity AS INT) * CAST(unit_price AS DECIMAL(18, 2))
             * (100 - CAST(ifnull(discount_pct, 0) AS DECIMAL(5, 0))) / 100, 2)''')} END AS line_total
    FROM e_raw_order_items"""
CLEAN_PRODUCTS_SQL = f"""SELECT {whole('product_id')} AS product_id, product_name, category,
      ifnull(sub_category, 'General') AS sub_category, ifnull(brand, 'UNKNOWN') AS brand, price,
      ifnull(cost, round(price / 2, 2)) AS cost, ifnull(weight_kg, 0) AS weight_kg,
      CASE WHEN rating > 5 THEN 5 WHEN rating > 0 THEN rating ELSE 0 END AS rating,
      ifnull({whole('review_count')}, 0) AS review_count, ifnull(is_active, true) AS is_active,
      CAST(created_date AS DATE) AS created_date
    FROM e_raw_products"""
CLEAN_CUSTOMERS_SQL = f"""SELECT {whole('customer_id')} AS customer_id, first_name, last_name, email,
      ifnull(phone, 'UNKNOWN') AS phone, address, ifnull(city, 'UNKNOWN') AS city,
      ifnull(state, 'UNKNOWN') AS state, ifnull(zip_code, '00000') AS zip_code, ifnull(country, 'US') AS country,
      CAST(registration_date AS DATE) AS registration_date, CAST(birth_date AS DATE) AS birth_date,
      ifnull(gender, 'UNKNOWN') AS gender, ifnull(income_bracket, 'UNKNOWN') AS income_bracket,
      ifnull(is_churned, false) AS is_churned, TRY_CAST(churn_date AS DATE) AS churn_date
    FROM e_raw_customers"""


def _repaired(spark, folder, name):
    rows = bronze.coerce(load(spark, folder, f"raw_{name}"), ENTITIES[name].types)
    return silver.silver_rows(name, rows)


@query("clean_orders", with_inputs(CLEAN_ORDERS_SQL, "raw_orders", coerced=COERCED_SQL))
def clean_orders(spark, folder):
    return _repaired(spark, folder, "orders")


@query("clean_order_items", with_inputs(CLEAN_ITEMS_SQL, "raw_order_items"))
def clean_order_items(spark, folder):
    return _repaired(spark, folder, "order_items")


@query("clean_products", with_inputs(CLEAN_PRODUCTS_SQL, "raw_products"))
def clean_products(spark, folder):
    return _repaired(spark, folder, "products")


@query("clean_customers", with_inputs(CLEAN_CUSTOMERS_SQL, "raw_customers"))
def clean_customers(spark, folder):
    return _repaired(spark, folder, "customers")


# Histories -------------------------------------------------------------------

ATTRIBUTES = ", ".join(BATCH_COLUMNS)
_CHANGED = " OR ".join(f"{c} IS DISTINCT FROM lag({c}) OVER k" for c in TRACKED_CUSTOMER_COLUMNS)
_BATCHES = " UNION ALL ".join(f"SELECT *, {n} AS b FROM ({batch_sql(n)})" for n in BATCH_TIMES)
_TIME = "CASE {b} " + " ".join(f"WHEN {n} THEN '{t}'" for n, t in BATCH_TIMES.items()) + " END"

# Silver: absent keys stay current, so a version ends only where the next one starts.
SILVER_HISTORY_SQL = f"""WITH seen AS ({_BATCHES}),
    opened AS (SELECT *, lag(b) OVER k IS NULL AS is_first, ({_CHANGED}) AS changed FROM seen
               WINDOW k AS (PARTITION BY customer_id ORDER BY b)),
    versions AS (SELECT *, lead(b) OVER (PARTITION BY customer_id ORDER BY b) AS next_b
                 FROM opened WHERE is_first OR changed)
    SELECT {ATTRIBUTES},
      CASE WHEN is_first THEN {instant('CAST(registration_date AS TIMESTAMP)')}
           ELSE {_TIME.format(b='b')} END AS effective_from,
      coalesce({_TIME.format(b='next_b')}, '9999-12-31 00:00:00') AS effective_to,
      next_b IS NULL AS is_current
    FROM versions"""

# Warehouse: a version also ends at the first batch that lacks the key.
SNAPSHOT_SQL = f"""WITH seen AS ({_BATCHES}),
    opened AS (SELECT *, (lag(b) OVER k IS DISTINCT FROM b - 1 OR ({_CHANGED})) AS opens FROM seen
               WINDOW k AS (PARTITION BY customer_id ORDER BY b)),
    runs AS (SELECT *, sum(CASE WHEN opens THEN 1 ELSE 0 END)
               OVER (PARTITION BY customer_id ORDER BY b) AS run FROM opened),
    ends AS (SELECT customer_id, run, max(b) + 1 AS end_b FROM runs GROUP BY ALL)
    SELECT {ATTRIBUTES}, {_TIME.format(b='b')} AS dbt_valid_from, {_TIME.format(b='end_b')} AS dbt_valid_to,
      {_TIME.format(b='b')} AS dbt_updated_at
    FROM runs JOIN ends USING (customer_id, run) WHERE opens"""
DIM_CUSTOMERS_SQL = f"""SELECT md5(customer_id || '-' || dbt_valid_from) AS customer_key, {ATTRIBUTES},
      dbt_valid_from AS effective_from, dbt_valid_to AS effective_to, dbt_valid_to IS NULL AS is_current,
      dbt_updated_at AS last_updated_at
    FROM ({SNAPSHOT_SQL})"""


def after_batches(spark, folder, rules, last):
    dimension = history.first_load(batch(spark, folder, 1), rules, BATCH_TIMES[1])
    for number in range(2, last + 1):
        dimension = history.merge_history(dimension, batch(spark, folder, number), rules, BATCH_TIMES[number])
    return dimension


@query(
    "scd2_initial",
    f"""SELECT {ATTRIBUTES}, {instant('CAST(registration_date AS TIMESTAMP)')} AS effective_from,
          '9999-12-31 00:00:00' AS effective_to, true AS is_current FROM ({batch_sql(1)})""",
)
def scd2_initial(spark, folder):
    return after_batches(spark, folder, history.SILVER_CUSTOMERS, 1)


@query("scd2_merge", SILVER_HISTORY_SQL)
def scd2_merge(spark, folder):
    return after_batches(spark, folder, history.SILVER_CUSTOMERS, 3)


@query(
    "scd2_changed_keys",
    f"""SELECT customer_id FROM ({batch_sql(1)}) a JOIN ({batch_sql(2)}) b USING (customer_id)
        WHERE {' OR '.join(f'a.{c} IS DISTINCT FROM b.{c}' for c in TRACKED_CUSTOMER_COLUMNS)}""",
)
def scd2_changed_keys(spark, folder):
    return history.changed_keys(batch(spark, folder, 1), batch(spark, folder, 2), history.SILVER_CUSTOMERS)


@query("snapshot_hard_delete", SNAPSHOT_SQL)
def snapshot_hard_delete(spark, folder):
    return after_batches(spark, folder, history.CUSTOMER_SNAPSHOT, 3)


@query("dim_customers", DIM_CUSTOMERS_SQL)
def dim_customers(spark, folder):
    return history.customer_dimension(after_batches(spark, folder, history.CUSTOMER_SNAPSHOT, 3))


# Quality ---------------------------------------------------------------------

_GATED = [*ENTITIES["orders"].gated, "payment_method"]


@query(
    "null_profile",
    with_inputs(
        " UNION ALL ".join(
            f"""SELECT '{c}' AS column_name, count(*) AS total_rows, count(*) - count({c}) AS null_rows,
                  {double(f'count(*) - count({c})')} / count(*) * 100 AS null_pct FROM coerced"""
            for c in _GATED
        ),
        "raw_orders",
        coerced=COERCED_SQL,
    ),
)
def null_profile(spark, folder):
    return quality.null_profile(coerced_orders(spark, folder), _GATED)


@query(
    "check_unique",
    with_inputs(
        """SELECT order_item_id, count(*) AS occurrences FROM e_order_items
           GROUP BY order_item_id HAVING count(*) > 1""",
        "order_items",
    ),
)
def check_unique(spark, folder):
    return quality.repeated(load(spark, folder, "order_items"), "order_item_id")


@query("check_not_null", with_inputs("SELECT order_id FROM e_raw_orders WHERE total IS NULL", "raw_orders"))
def check_not_null(spark, folder):
    return quality.missing(load(spark, folder, "raw_orders"), "total").select("order_id")


_STATUSES = SUITES["stg_orders"].accepted_values["status"]


@query(
    "check_accepted_values",
    with_inputs(
        f"SELECT status, count(*) AS occurrences FROM e_orders WHERE status NOT IN {_STATUSES} GROUP BY status",
        "orders",
    ),
)
def check_accepted_values(spark, folder):
    return quality.outside(load(spark, folder, "orders"), "status", _STATUSES)


@query(
    "check_relationships",
    with_inputs(
        """SELECT order_id, customer_id FROM e_orders
           WHERE customer_id NOT IN (SELECT customer_id FROM e_customers WHERE is_current)""",
        "orders",
        "customers",
    ),
)
def check_relationships(spark, folder):
    known = load(spark, folder, "customers").filter("is_current")
    orders = load(spark, folder, "orders").select("order_id", "customer_id")
    return quality.orphans(orders, "customer_id", known, "customer_id")


@query(
    "check_unique_combo",
    with_inputs(
        """SELECT order_id, product_id, count(*) AS occurrences FROM e_order_items
           GROUP BY ALL HAVING count(*) > 1""",
        "order_items",
    ),
)
def check_unique_combo(spark, folder):
    return quality.repeated(load(spark, folder, "order_items"), "order_id", "product_id")


@query(
    "check_one_current",
    f"""SELECT customer_id, count(*) FILTER (WHERE is_current) AS current_count FROM ({DIM_CUSTOMERS_SQL})
        GROUP BY customer_id HAVING count(*) FILTER (WHERE is_current) <> 1""",
)
def check_one_current(spark, folder):
    return quality.not_one_current(dim_customers(spark, folder))


@query(
    "check_total_positive",
    with_inputs("SELECT order_id, total FROM e_orders WHERE NOT total > 0", "orders"),
)
def check_total_positive(spark, folder):
    return quality.nonpositive_totals(load(spark, folder, "orders"))


@query(
    "check_share_100",
    with_inputs(
        f"""SELECT order_date, round({double('sum(CAST(revenue_share_pct AS DECIMAL(9, 2)))')}, 4) AS total_share
            FROM ({sql.FCT_DAILY_SQL}) GROUP BY order_date
            HAVING abs(sum(CAST(revenue_share_pct AS DECIMAL(9, 2))) - 100) > 0.005""",
        "orders",
        "order_items",
        "products",
        **sql.FCT_DAILY_PARTS,
    ),
)
def check_share_100(spark, folder):
    # A tolerance far below the usual 1.0, so that rounding residues show up.
    return quality.unbalanced_days(sql.fct_daily_revenue(spark, folder), tolerance=0.005)


# The declared checks of every model, as one report per model.

MODELS = {
    "stg_customers": (
        lambda s, f: staging.stage_customers(load(s, f, "raw_customers")),
        with_inputs(sql.STAGED_CUSTOMERS_SQL, "raw_customers"),
    ),
    "stg_products": (
        lambda s, f: staging.stage_products(load(s, f, "raw_products")),
        with_inputs(sql.STAGED_PRODUCTS_SQL, "raw_products"),
    ),
    "stg_orders": (
        lambda s, f: staging.stage_orders(load(s, f, "source_orders")),
        with_inputs(sql.STAGED_ORDERS_SQL, "source_orders"),
    ),
    "stg_order_items": (
        lambda s, f: staging.stage_order_items(load(s, f, "raw_order_items")),
        with_inputs(sql.STAGED_ITEMS_SQL, "raw_order_items"),
    ),
    "int_order_enriched": (
        lambda s, f: sql.order_enriched(s, f),
        with_inputs(sql.ENRICHED_SQL, "orders", "order_items", "products"),
    ),
    "int_customer_360": (
        lambda s, f: sql.customer_360(s, f),
        with_inputs(
            sql.PROFILE_SQL,
            "customers",
            "orders",
            "order_items",
            "products",
            stats=sql.ORDER_STATS_SQL,
            units=sql.UNITS_SQL,
            preferred=sql.PREFERRED_SQL,
        ),
    ),
    "fct_daily_revenue": (
        lambda s, f: sql.fct_daily_revenue(s, f),
        with_inputs(sql.FCT_DAILY_SQL, "orders", "order_items", "products", **sql.FCT_DAILY_PARTS),
    ),
    "fct_conversion_funnel": (
        lambda s, f: marts.monthly_funnel(load(s, f, "orders")),
        with_inputs(sql.FCT_FUNNEL_SQL, "orders", **sql.FCT_FUNNEL_PARTS),
    ),
    "dim_customers": (lambda s, f: dim_customers(s, f), DIM_CUSTOMERS_SQL),
    "dim_products": (
        lambda s, f: sql.dim_products(s, f),
        with_inputs(sql.DIM_PRODUCTS_SQL, "products"),
    ),
}


def _suite_sql(model: str) -> str:
    suite, rows = SUITES[model], MODELS[model][1]
    parents = {parent: MODELS[parent][1] for parent, _ in suite.references.values()}
    branches = [(c, "not_null", f"count(*) FILTER (WHERE {c} IS NULL)") for c in suite.not_null]
    branches += [
        (c, "accepted_values", f"count(*) FILTER (WHERE {c} NOT IN {values})")
        for c, values in suite.accepted_values.items()
    ]
    selects = [
        f"SELECT '{kind}' AS check_name, '{c}' AS column_name, {n} AS failures FROM m"
        for c, kind, n in branches
    ]
    for kind, columns in [("unique", (c,)) for c in suite.unique] + [
        ("unique_combination", cs) for cs in suite.unique_combinations
    ]:
        names, present = ", ".join(columns), " AND ".join(f"{c} IS NOT NULL" for c in columns)
        selects.append(
            f"SELECT '{kind}', '{','.join(columns)}', count(*) FROM (SELECT {names} FROM m WHERE {present} "
            f"GROUP BY {names} HAVING count(*) > 1)"
        )
    for c, (parent, pc) in suite.references.items():
        selects.append(
            f"SELECT 'relationships', '{c}', count(*) FROM m WHERE {c} IS NOT NULL "
            f"AND NOT EXISTS (SELECT 1 FROM {parent} AS p WHERE p.{pc} = m.{c})"
        )
    named = [f"m AS MATERIALIZED ({rows})"] + [f"{n} AS ({q})" for n, q in parents.items()]
    return f"WITH {', '.join(named)} {' UNION ALL '.join(selects)}"


def _register_suite(model: str) -> None:
    @query(f"suite_{model}", _suite_sql(model))
    def suite_report(spark, folder):
        suite = SUITES[model]
        parents = {
            column: (MODELS[parent][0](spark, folder), key)
            for column, (parent, key) in suite.references.items()
        }
        return quality.run_suite(
            MODELS[model][0](spark, folder), suite, parents, store=not model.startswith("stg_")
        )


for _model in MODELS:
    _register_suite(_model)

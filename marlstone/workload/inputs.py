"""The entities, derived from the benchmark tables.

Each input is one projection written in SQL that both Spark and the comparison
engine understand, so both sides start from the same rows.  ``raw_*`` inputs look
like source files: text where a source has text, with missing and malformed
values; the others look like cleaned tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

_DATE = "CAST(o_orderdate AS DATE)"
_PRIORITY = "left(o_orderpriority, 1)"
_STATUS = (
    f"CASE WHEN o_orderstatus = 'F' AND {_PRIORITY} IN ('1', '2') THEN 'completed' "
    f"WHEN o_orderstatus = 'F' AND {_PRIORITY} IN ('3', '4') THEN 'delivered' "
    "WHEN o_orderstatus = 'F' THEN 'shipped' "
    f"WHEN o_orderstatus = 'O' AND {_PRIORITY} IN ('1', '2', '3') THEN 'pending' "
    "WHEN o_orderstatus = 'O' THEN 'returned' "
    f"WHEN {_PRIORITY} IN ('1', '2') THEN 'cancelled' "
    f"WHEN {_PRIORITY} IN ('3', '4') THEN 'refunded' ELSE 'on_hold' END"
)
_PAYMENT = (
    f"CASE {_PRIORITY} WHEN '1' THEN 'credit_card' WHEN '2' THEN 'debit_card' "
    "WHEN '3' THEN 'paypal' WHEN '4' THEN 'apple_pay' ELSE 'gift_card' END"
)
_INCOME = (
    "CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'low' WHEN 'BUILDING' THEN 'medium' "
    "WHEN 'FURNITURE' THEN 'high' ELSE 'premium' END"
)


def _text(expression: str) -> str:
    return f"CAST({expression} AS STRING)"


def _null_every(n: int, key: str, expression: str, rest: int = 0) -> str:
    return f"CASE WHEN {key} % {n} = {rest} THEN NULL ELSE {expression} END"


def _padded(expression: str) -> str:
    return f"lpad({_text(expression)}, 2, '0')"


_REGISTERED = f"'1995-' || {_padded('c_custkey % 12 + 1')} || '-' || {_padded('c_custkey % 28 + 1')}"
_BORN = f"{_text('1950 + c_custkey % 50')} || '-' || {_padded('c_custkey % 12 + 1')} || '-11'"

# name -> (table, [(column, expression), ...])
PROJECTIONS: dict[str, tuple[str, list[tuple[str, str]]]] = {
    "orders": (
        "orders",
        [
            ("order_id", "o_orderkey"),
            ("customer_id", "o_custkey"),
            ("order_date", _DATE),
            ("order_timestamp", "CAST(o_orderdate AS TIMESTAMP)"),
            ("status", _STATUS),
            ("payment_method", _PAYMENT),
            ("shipping_city", _null_every(17, "o_custkey", f"'City ' || {_text('o_custkey % 50')}")),
            ("shipping_state", f"'State ' || {_text('o_custkey % 25')}"),
            ("shipping_zip", _text("10000 + o_custkey % 900")),
            ("subtotal", "o_totalprice"),
            ("shipping_cost", "CAST(o_orderkey % 20 AS DOUBLE)"),
            ("tax", "CAST(o_orderkey % 9 AS DOUBLE)"),
            ("total", "CASE WHEN o_orderkey % 1013 = 7 THEN 0.0 ELSE o_totalprice END"),
            ("order_year", f"CAST(year({_DATE}) AS INT)"),
            ("order_month", f"CAST(month({_DATE}) AS INT)"),
        ],
    ),
    # One row per line; the item id repeats on purpose.
    "order_items": (
        "lineitem",
        [
            ("order_item_id", "l_orderkey * 10 + l_linenumber"),
            ("order_id", "l_orderkey"),
            ("product_id", "l_partkey"),
            ("quantity", "CAST(l_quantity AS INT)"),
            ("unit_price", "l_extendedprice"),
            ("discount_pct", "l_discount * 100"),
            ("line_total", "l_extendedprice * (1 - l_discount)"),
            ("_ingested_at", "CAST(l_shipdate AS TIMESTAMP)"),
            ("supplier_id", "l_suppkey"),
        ],
    ),
    "products": (
        "part",
        [
            ("product_id", "p_partkey"),
            ("product_name", "p_name"),
            ("category", "p_type"),
            ("sub_category", "p_brand"),
            ("brand", "p_brand"),
            ("price", "CAST((p_partkey % 100 + 1) * 10 AS DOUBLE)"),
            ("cost", "CAST((p_partkey % 100 + 1) * (5 + p_partkey % 3) AS DOUBLE)"),
            ("weight_kg", "p_size / 8.0E0"),
            ("rating", "CAST(p_size AS DOUBLE) / 10"),
            ("review_count", "CAST(p_partkey % 500 AS INT)"),
            ("is_active", "p_partkey % 9 <> 0"),
            ("created_date", "DATE '1994-05-06'"),
        ],
    ),
    "customers": (
        "customer",
        [
            ("customer_id", "c_custkey"),
            ("first_name", "split_part(c_name, '#', 1)"),
            ("last_name", "split_part(c_name, '#', 2)"),
            ("email", f"'user' || {_text('c_custkey')} || '@example.com'"),
            ("phone", f"'555-' || {_text('c_custkey % 1000')}"),
            ("address", f"{_text('c_custkey % 300')} || ' Main St'"),
            ("city", f"'City ' || {_text('c_custkey % 50')}"),
            ("state", f"'State ' || {_text('c_nationkey')}"),
            ("zip_code", _text("10000 + c_custkey % 900")),
            ("country", "'US'"),
            ("registration_date", f"CAST({_REGISTERED} AS DATE)"),
            ("birth_date", f"CAST({_BORN} AS DATE)"),
            ("gender", "CASE c_custkey % 3 WHEN 0 THEN 'm' WHEN 1 THEN 'f' ELSE 'other' END"),
            ("income_bracket", _INCOME),
            ("is_churned", "c_acctbal < 0"),
            ("churn_date", "CASE WHEN c_acctbal < 0 THEN DATE '2001-06-15' END"),
            ("is_current", "c_acctbal >= -900"),
        ],
    ),
    "raw_orders": (
        "orders",
        [
            (
                "order_id",
                f"CASE WHEN o_orderkey % 101 = 5 THEN 'bad-' || {_text('o_orderkey')} "
                f"ELSE {_text('o_orderkey')} END",
            ),
            ("customer_id", _null_every(97, "o_orderkey", "o_custkey")),
            (
                "order_date",
                "CASE WHEN o_orderkey % 89 = 3 THEN '2024-13-45' WHEN o_orderkey % 83 = 2 THEN NULL "
                f"ELSE {_text(_DATE)} END",
            ),
            (
                "order_timestamp",
                f"CASE WHEN o_orderkey % 79 = 1 THEN 'n/a' ELSE {_text('o_orderdate')} END",
            ),
            (
                "status",
                "CASE WHEN o_orderkey % 11 = 0 THEN NULL "
                f"WHEN o_orderkey % 7 = 0 THEN ' ' || upper({_STATUS}) || '  ' ELSE {_STATUS} END",
            ),
            ("payment_method", _null_every(13, "o_orderkey", f"upper({_PAYMENT})")),
            ("shipping_city", _null_every(17, "o_orderkey", f"'City ' || {_text('o_custkey % 50')}")),
            ("shipping_state", _null_every(19, "o_orderkey", f"'State ' || {_text('o_custkey % 25')}")),
            ("shipping_zip", _null_every(23, "o_orderkey", _text("10000 + o_custkey % 900"))),
            ("subtotal", _null_every(29, "o_orderkey", "o_totalprice")),
            ("shipping_cost", _null_every(31, "o_orderkey", "CAST(o_orderkey % 20 AS DOUBLE)")),
            ("tax", _null_every(37, "o_orderkey", "CAST(o_orderkey % 9 AS DOUBLE)")),
            ("total", _null_every(6, "o_orderkey", "o_totalprice", rest=5)),
            ("channel", "CASE WHEN o_custkey % 2 = 0 THEN 'web' ELSE 'store' END"),
        ],
    ),
    # Like raw_orders, but without malformed values: staging views reject those.
    "source_orders": (
        "orders",
        [
            ("order_id", _text("o_orderkey")),
            ("customer_id", _text("o_custkey")),
            ("order_date", _text(_DATE)),
            ("order_timestamp", _text("o_orderdate")),
            ("status", f"CASE WHEN o_orderkey % 7 = 0 THEN ' ' || upper({_STATUS}) || '  ' ELSE {_STATUS} END"),
            ("payment_method", f"upper({_PAYMENT})"),
            ("shipping_city", _null_every(17, "o_orderkey", f"'City ' || {_text('o_custkey % 50')}")),
            ("shipping_state", _null_every(19, "o_orderkey", f"'State ' || {_text('o_custkey % 25')}")),
            ("shipping_zip", _null_every(23, "o_orderkey", _text("10000 + o_custkey % 900"))),
            ("subtotal", "o_totalprice"),
            ("shipping_cost", "CAST(o_orderkey % 20 AS DOUBLE)"),
            ("tax", "CAST(o_orderkey % 9 AS DOUBLE)"),
            ("total", "o_totalprice"),
        ],
    ),
    # Documents about customers, several per customer and not all alike.
    "customer_documents": (
        "orders",
        [
            ("customer_id", "o_custkey"),
            ("name", f"'Customer ' || {_text('o_custkey')}"),
            ("email", f"CASE WHEN o_custkey % 9 = 0 THEN NULL ELSE 'user' || {_text('o_custkey')} || '@example.com' END"),
            ("city", f"'City ' || {_text('(o_custkey + o_orderkey) % 40')}"),
            ("state", f"'State ' || {_text('o_orderkey % 25')}"),
            ("created_at", _text(_DATE)),
        ],
    ),
    "product_documents": (
        "part",
        [
            ("product_id", "p_partkey"),
            ("name", "p_name"),
            ("category", "p_type"),
            ("price", "CASE WHEN p_partkey % 17 = 0 THEN 0.0E0 ELSE p_retailprice END"),
        ],
    ),
    "order_documents": (
        "orders",
        [
            ("order_id", "o_orderkey"),
            ("customer_id", "o_custkey"),
            ("order_date", _text(_DATE)),
            ("status", _STATUS),
            ("item_count", "CASE WHEN o_orderkey % 10 = 9 THEN 0 ELSE CAST(o_orderkey % 4 AS INT) + 1 END"),
        ],
    ),
    "raw_order_items": (
        "lineitem",
        [
            ("order_item_id", _text("l_orderkey * 10 + l_linenumber")),
            ("order_id", _text("l_orderkey")),
            ("product_id", _text("l_partkey")),
            ("quantity", _text("CAST(l_quantity AS INT)")),
            ("unit_price", "round(l_extendedprice, 0)"),
            ("discount_pct", _null_every(5, "l_partkey", "round(l_discount * 100, 0)")),
            ("line_total", _null_every(4, "l_partkey", "l_extendedprice")),
        ],
    ),
    "raw_products": (
        "part",
        [
            ("product_id", _text("p_partkey")),
            ("product_name", "' ' || p_name || ' '"),
            ("category", "p_type"),
            ("sub_category", _null_every(7, "p_partkey", "p_brand")),
            ("brand", _null_every(9, "p_partkey", "p_brand")),
            ("price", "CAST((p_partkey % 100 + 1) * 10 AS DOUBLE)"),
            ("cost", _null_every(3, "p_partkey", "CAST((p_partkey % 100 + 1) * 6 AS DOUBLE)")),
            ("weight_kg", _null_every(8, "p_partkey", "p_size / 8.0E0")),
            (
                "rating",
                "CASE WHEN p_size % 11 = 0 THEN NULL WHEN p_size % 13 = 0 THEN -1.0E0 "
                "ELSE CAST(p_size AS DOUBLE) / 8 END",
            ),
            ("review_count", _null_every(12, "p_partkey", _text("p_partkey % 500"))),
            ("is_active", _null_every(14, "p_partkey", "p_partkey % 9 <> 0")),
            ("created_date", _text("CAST('1994-05-06' AS DATE)")),
        ],
    ),
    "raw_customers": (
        "customer",
        [
            ("customer_id", _text("c_custkey")),
            ("first_name", "' ' || split_part(c_name, '#', 1)"),
            ("last_name", "split_part(c_name, '#', 2) || ' '"),
            ("email", _null_every(43, "c_custkey", f"' User' || {_text('c_custkey')} || '@Example.com'")),
            ("phone", _null_every(7, "c_custkey", f"'555-' || {_text('c_custkey % 1000')}")),
            ("address", f"{_text('c_custkey % 300')} || ' Main St'"),
            ("city", _null_every(11, "c_custkey", f"'City ' || {_text('c_custkey % 50')}")),
            ("state", _null_every(13, "c_custkey", f"'State ' || {_text('c_nationkey')}")),
            ("zip_code", _null_every(17, "c_custkey", _text("10000 + c_custkey % 900"))),
            ("country", _null_every(19, "c_custkey", "'CA'")),
            ("registration_date", _REGISTERED),
            ("birth_date", _BORN),
            ("gender", "CASE c_custkey % 4 WHEN 0 THEN 'M' WHEN 1 THEN 'F' WHEN 2 THEN 'Other' END"),
            ("income_bracket", _null_every(23, "c_custkey", _INCOME)),
            ("is_churned", _null_every(29, "c_custkey", "c_acctbal < 0")),
            ("churn_date", "CASE WHEN c_acctbal < 0 THEN '2001-06-15' WHEN c_custkey % 5 = 0 THEN '' END"),
        ],
    ),
}

# The customers as three successive batches see them, each without one of the
# income groups: keys vanish and come back, and tracked (city, phone, zip code) and
# untracked (first name) columns change.
BATCH_FILTERS = {
    1: "income_bracket <> 'high'",
    2: "income_bracket <> 'medium'",
    3: "income_bracket <> 'low'",
}
BATCH_CHANGES = {
    1: {"phone": "CASE WHEN customer_id % 13 = 0 THEN NULL ELSE phone END"},
    2: {
        "city": "CASE WHEN customer_id % 7 = 0 THEN 'Moved ' || city ELSE city END",
        "first_name": "CASE WHEN customer_id % 11 = 0 THEN upper(first_name) ELSE first_name END",
    },
    3: {
        "city": "CASE WHEN customer_id % 14 = 0 THEN 'Moved ' || city ELSE city END",
        "zip_code": "CASE WHEN customer_id % 17 = 0 THEN NULL ELSE zip_code END",
    },
}
# Item number i of an order document; every third catalogue number is unknown.
DOCUMENT_PRODUCT = "(customer_id * i) % 300"
DOCUMENT_QUANTITY = "i + order_id % 3"

BATCH_TIMES = {1: "2000-01-01 06:00:00", 2: "2000-02-01 06:00:00", 3: "2000-03-01 06:00:00"}
BATCH_COLUMNS = [name for name, _ in PROJECTIONS["customers"][1] if name != "is_current"]

AS_OF = "2001-08-02"  # the day after the last order date


# Declared, so that no job has to look them up in file footers.
TABLE_SCHEMAS = {
    "orders": (
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
        "o_orderdate timestamp_ntz, o_orderpriority string"
    ),
    "lineitem": (
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
        "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, "
        "l_linestatus string, l_shipdate timestamp_ntz"
    ),
    "part": (
        "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double"
    ),
    "customer": (
        "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"
    ),
}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.schema(TABLE_SCHEMAS[name]).parquet(f"{folder}/{name}.parquet")


def load(spark: SparkSession, folder: str, name: str) -> DataFrame:
    source, columns = PROJECTIONS[name]
    return table(spark, folder, source).selectExpr(*[f"{e} AS `{c}`" for c, e in columns])


def batch(spark: SparkSession, folder: str, number: int) -> DataFrame:
    changes = BATCH_CHANGES[number]
    rows = load(spark, folder, "customers").filter(BATCH_FILTERS[number])
    return rows.selectExpr(*[f"{changes.get(c, c)} AS `{c}`" for c in BATCH_COLUMNS])


def order_documents(spark: SparkSession, folder: str) -> DataFrame:
    item = (
        f"named_struct('product_id', {DOCUMENT_PRODUCT}, 'quantity', CAST({DOCUMENT_QUANTITY} AS BIGINT))"
    )
    items = f"filter(transform(sequence(0, item_count), i -> if(i = 0, NULL, {item})), x -> x IS NOT NULL)"
    return load(spark, folder, "order_documents").selectExpr(
        "order_id", "customer_id", "order_date", "status", f"{items} AS items"
    )


def order_document_lines_sql() -> str:
    return (
        f"SELECT order_id, customer_id, order_date, status, {DOCUMENT_PRODUCT} AS product_id, "
        f"{DOCUMENT_QUANTITY} AS quantity FROM ({select_sql('order_documents')}), range(1, 5) AS r(i) "
        "WHERE i <= item_count"
    )


def select_sql(name: str) -> str:
    """The same input as a SELECT for the comparison engine."""
    source, columns = PROJECTIONS[name]
    return f"SELECT {', '.join(f'{e} AS {c}' for c, e in columns)} FROM {source}"


def batch_sql(number: int) -> str:
    changes = BATCH_CHANGES[number]
    columns = ", ".join(f"{changes.get(c, c)} AS {c}" for c in BATCH_COLUMNS)
    return f"SELECT {columns} FROM ({select_sql('customers')}) WHERE {BATCH_FILTERS[number]}"

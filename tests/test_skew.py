"""One key holds a third of all rows: results by brute force, and plans that cope."""

import datetime as dt
import re
from collections import Counter, defaultdict
from contextlib import contextmanager
from decimal import ROUND_HALF_UP, Decimal

import pytest

from marlstone.operators import gold, marts
from marlstone.operators.dedup import latest_per_key
from marlstone.sources.writers import write_table

N = 6000  # order lines
REVENUE = {"completed", "delivered", "shipped"}
STATUS = ["completed", "pending", "shipped", "cancelled"]


def _line(i):
    hot = i % 3 == 0
    order = 7 if hot else i % 500
    product = 3 if i % 3 == 1 else i % 40
    return order, product, 1 + i % 5, float(i % 4), round(0.37 * (i % 1000) + 0.01, 2)


LINES = [_line(i) for i in range(N)]
# Customer 1 places a third of the orders, and a third of them fall on one day.
ORDERS = [
    (o, 1 if o % 3 == 0 else o % 60, dt.date(2024, 1, 1) + dt.timedelta(0 if o % 3 == 1 else o % 90), STATUS[o % 4] if o != 7 else "completed", 10.0 + o)
    for o in range(500)
]
PRODUCTS = [(p, f"C{p % 4}", f"S{p % 7}", 10.0 + p, 5.0 + p % 3) for p in range(40)]


@pytest.fixture(scope="module")
def tables(spark):
    orders = spark.createDataFrame(
        ORDERS, "order_id bigint, customer_id bigint, order_date date, status string, total double"
    ).selectExpr("*", "year(order_date) AS order_year", "month(order_date) AS order_month")
    items = spark.createDataFrame(
        LINES, "order_id bigint, product_id bigint, quantity int, discount_pct double, line_total double"
    ).repartition(8)
    products = spark.createDataFrame(
        PRODUCTS, "product_id bigint, category string, sub_category string, price double, cost double"
    )
    return orders, items, products


@contextmanager
def settings(spark, **values):
    values = {k.replace("__", "."): v for k, v in values.items()}
    before = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def cents(value, places="0.01"):
    return float(Decimal(value).quantize(Decimal(places), ROUND_HALF_UP))


def test_daily_revenue_by_brute_force(tables):
    headers = {o[0]: o for o in ORDERS}
    catalogue = {p[0]: p for p in PRODUCTS}
    revenue, seen, units = defaultdict(Decimal), defaultdict(set), Counter()
    for order, product, quantity, _, total in LINES:
        _, _, day, status, _ = headers[order]
        if status in REVENUE:
            key = (day, catalogue[product][1], catalogue[product][2])
            revenue[key] += Decimal(str(total))
            seen[key].add(order)
            units[key] += quantity
    rows = gold.daily_revenue_by_category(*tables).collect()
    got = {(r.order_date, r.category, r.sub_category): (r.total_revenue, r.order_count, r.item_count) for r in rows}
    assert got == {k: (cents(v), len(seen[k]), units[k]) for k, v in revenue.items()}
    warehouse = marts.daily_revenue(*tables).collect()
    assert {(r.order_date, r.category, r.sub_category): r.gross_revenue for r in warehouse} == {
        k: float(v) for k, v in revenue.items()
    }


def test_customer_stats_by_brute_force(tables):
    orders, items, _ = tables
    headers = {o[0]: o for o in ORDERS}
    per_order = defaultdict(Decimal)
    for order, *_, total in LINES:
        if headers[order][3] in REVENUE:
            per_order[order] += Decimal(str(total))
    spent, count = defaultdict(Decimal), Counter()
    for order, total in per_order.items():
        spent[headers[order][1]] += total
        count[headers[order][1]] += 1
    got = {r.customer_id: (r.order_count, r.total_revenue, r.avg_order_value) for r in gold.customer_stats(orders, items).collect()}
    assert got == {c: (count[c], cents(spent[c]), cents(spent[c] / count[c])) for c in spent}


def test_preferred_category_by_brute_force(tables):
    headers = {o[0]: o for o in ORDERS}
    catalogue = {p[0]: p for p in PRODUCTS}
    units = defaultdict(Counter)
    for order, product, quantity, *_ in LINES:
        if headers[order][3] in REVENUE:
            units[headers[order][1]][catalogue[product][1]] += quantity
    expected = {c: min(u, key=lambda k: (-u[k], k)) for c, u in units.items()}
    assert {r.customer_id: r.preferred_category for r in marts.preferred_category(*tables).collect()} == expected


def test_cohorts_by_brute_force(tables):
    months = defaultdict(set)
    for _, customer, day, status, _ in ORDERS:
        if status in REVENUE:
            months[customer].add(day.year * 12 + day.month)
    expected = Counter((min(m), x - min(m)) for m in months.values() for x in m)
    got = {
        (r.cohort_year * 12 + r.cohort_month_num, r.period_number): r.retained_customers
        for r in gold.cohort_retention(tables[0]).collect()
    }
    assert got == expected


@pytest.mark.parametrize("build", [gold.daily_revenue_by_category, marts.daily_revenue, marts.category_units])
def test_lines_are_folded_before_they_are_shuffled_by_order(spark, tables, build):
    with settings(spark, spark__sql__autoBroadcastJoinThreshold="-1"):
        text = plan(build(*tables))
    # Below the exchange that brings lines to their order sits the fold per order and product group.
    exchange = text.index("Exchange hashpartitioning(order_id#")
    below = text[exchange:]
    assert re.search(r"HashAggregate\(keys=\[order_id#\d+L, category", below.split("Exchange", 2)[1])
    # Every grouping exchange is preceded by a partial aggregation.
    for match in re.finditer(r"HashAggregate\(keys=.*?functions=\[(partial_)?sum.*\n(.*\n)", text):
        if match.group(1) is None and "Exchange" in match.group(2):
            assert "partial_" in text[match.end() : match.end() + 400]


def test_copies_of_a_row_are_dropped_before_the_shuffle(spark):
    rows = spark.range(0, 9000, 1, 8).selectExpr(
        "CASE WHEN id % 3 = 0 THEN -1 ELSE id END AS id", "id % 97 AS at", "id % 11 AS v"
    )
    latest = latest_per_key(rows, "id", ("at",))
    text = plan(latest)
    assert text.index("Final") < text.index("Exchange") < text.index("Partial")
    got = {r.id: (r.at, r.v) for r in latest.collect()}
    copies = [(i % 97, i % 11) for i in range(0, 9000, 3)]
    newest = max(a for a, _ in copies)
    assert len(got) == 6001
    assert got[-1] == (newest, min(v for a, v in copies if a == newest))


def test_hot_keys_of_row_level_joins_are_split(spark, tables, tmp_path):
    orders, items, products = tables
    wide = orders.selectExpr(
        "*", "'t' AS order_timestamp", "'p' AS payment_method", "'c' AS shipping_city", "'s' AS shipping_state",
        "0.0 AS subtotal", "0.0 AS shipping_cost", "0.0 AS tax",
    )
    lines = items.selectExpr("*", "order_id AS order_item_id", "line_total AS unit_price")
    named = products.selectExpr("*", "'n' AS product_name", "'b' AS brand")
    write_table(lines, str(tmp_path / "lines"))
    stored = spark.read.parquet(str(tmp_path / "lines"))
    with settings(
        spark,
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="2KB",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="1.5",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="2KB",
    ):
        enriched = marts.order_enriched(wide, stored, named)
        assert len(enriched.collect()) == N
        assert "skew=true" in plan(enriched)


def test_hot_month_is_written_by_several_tasks(spark, tmp_path):
    rows = spark.range(0, 60_000, 1, 8).selectExpr(
        "id", "uuid() AS text", "2024 AS order_year", "IF(id % 3 = 0, 1, 2 + id % 11) AS order_month"
    )
    with settings(spark, spark__sql__adaptive__advisoryPartitionSizeInBytes="200KB"):
        write_table(rows, str(tmp_path / "t"), ("order_year", "order_month"))
    files = spark.read.parquet(str(tmp_path / "t")).selectExpr("order_month", "_metadata.file_name AS f")
    per_month = {r.order_month: r.n for r in files.groupBy("order_month").agg({"f": "count"}).withColumnRenamed("count(f)", "n").collect()}
    names = files.distinct().groupBy("order_month").count().collect()
    assert per_month[1] == 20_000
    assert {r.order_month: r["count"] for r in names}[1] > 1

"""Aggregates on small inputs with results worked out by hand."""

import datetime as dt

import pytest

from marlstone.operators import gold, marts, quality, ranking
from marlstone.operators.suites import SUITES, Suite
from marlstone.sources.scratch import written

D = dt.date
ORDERS = "order_id bigint, customer_id bigint, order_date date, status string, total double"


def orders(spark, *rows):
    return spark.createDataFrame(rows, ORDERS).selectExpr(
        "*", "year(order_date) AS order_year", "month(order_date) AS order_month"
    )


def items(spark, *rows):
    return spark.createDataFrame(
        rows,
        "order_id bigint, product_id bigint, quantity int, discount_pct double, line_total double",
    )


def products(spark, *rows):
    return spark.createDataFrame(
        rows, "product_id bigint, category string, sub_category string, price double, cost double"
    )


CATALOGUE = [(1, "A", "a1", 10.0, 6.0), (2, "A", "a2", 5.0, 5.0), (3, "B", "b1", 1.0, 0.25)]


def test_daily_revenue(spark):
    day = D(2024, 1, 31)
    df = gold.daily_revenue_by_category(
        orders(
            spark,
            (1, 1, day, "completed", 0.0),
            (2, 1, day, "shipped", 0.0),
            (3, 1, day, "cancelled", 0.0),
            (4, 1, None, "completed", 0.0),
        ),
        items(
            spark,
            (1, 1, 2, 10.0, 18.0),
            (1, 1, 1, 0.0, 10.0),
            (2, 1, 1, None, 10.0),
            (2, 3, 4, 0.0, 0.0),
            (3, 1, 9, 0.0, 90.0),
            (4, 1, 9, 0.0, 90.0),
            (9, 1, 9, 0.0, 90.0),
        ),
        products(spark, *CATALOGUE),
    )
    a, b = df.orderBy("category").collect()
    assert (a.total_revenue, a.order_count, a.item_count, a.avg_order_value) == (38.0, 2, 4, 19.0)
    assert (a.avg_discount_pct, a.gross_profit, a.margin_pct, a.revenue_share_pct) == (5.0, 16.0, 42.11, 100.0)
    # No revenue: no margin, and no division error.
    assert (b.total_revenue, b.margin_pct, b.revenue_share_pct, b.gross_profit) == (0.0, None, 0.0, 3.0)
    assert (a.order_year, a.order_month) == (2024, 1)


def test_warehouse_profit_is_after_discount(spark):
    day = D(2024, 1, 31)
    row = marts.daily_revenue(
        orders(spark, (1, 1, day, "delivered", 0.0)),
        items(spark, (1, 1, 2, 10.0, 18.0)),
        products(spark, *CATALOGUE),
    ).first()
    assert (row.gross_revenue, row.total_cost, row.gross_profit) == (18.0, 12.0, 6.0)


def customers(spark, *keys):
    return spark.createDataFrame(
        [(k, "f", "l", f"{k}@x", "c", "s", "low", D(2024, 1, 1), False, current) for k, current in keys],
        "customer_id bigint, first_name string, last_name string, email string, city string, state string, "
        "income_bracket string, registration_date date, is_churned boolean, is_current boolean",
    )


def test_lifetime_value(spark):
    df = gold.customer_lifetime_value(
        orders(
            spark,
            (1, 1, D(2024, 1, 1), "completed", 0.0),
            (2, 1, D(2024, 1, 11), "completed", 0.0),
            (3, 1, D(2024, 1, 16), "completed", 0.0),
            (4, 2, D(2024, 1, 5), "completed", 0.0),
            (5, 3, D(2024, 1, 5), "pending", 0.0),
        ),
        items(
            spark,
            (1, 1, 1, 0.0, 10.0),
            (1, 1, 1, 0.0, 10.01),
            (2, 1, 1, 0.0, 5.0),
            (3, 1, 1, 0.0, 5.0),
            (4, 1, 1, 0.0, 7.0),
            (5, 1, 1, 0.0, 70.0),
        ),
        customers(spark, (1, True), (2, True), (3, True), (4, False)),
        as_of="2024-02-01",
    )
    got = {r.customer_id: r for r in df.collect()}
    assert set(got) == {1, 2, 3}
    assert (got[1].order_count, got[1].total_revenue, got[1].avg_order_value) == (3, 30.01, 10.0)
    assert (got[1].avg_days_between_orders, got[1].days_since_last_order) == (7.5, 16)
    assert got[2].avg_days_between_orders is None
    assert (got[3].order_count, got[3].total_revenue, got[3].last_order_date) == (0, 0.0, None)
    assert {k: r.clv_segment for k, r in got.items()} == {1: "high", 2: "medium", 3: "low"}
    assert got[1].days_since_registration == 31


@pytest.mark.parametrize("n, k", [(1, 3), (2, 3), (3, 3), (7, 3), (10, 4), (50, 7), (0, 3)])
def test_tiles_match_the_window_function(spark, n, k):
    # A third of the rows share one value, and rows are spread over many partitions.
    rows = spark.range(n).selectExpr("id", "CASE WHEN id % 3 = 0 THEN 0.0 ELSE id % 5 END AS v").repartition(6)
    rows.createOrReplaceTempView("tile_rows")
    expected = spark.sql(f"SELECT id, ntile({k}) OVER (ORDER BY v, id) AS t FROM tile_rows").collect()
    got = ranking.with_tile(written(rows, "tiles"), k, ["v", "id"], "t").select("id", "t").collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, expected))


def test_funnels_differ_by_definition(spark):
    day = D(2024, 3, 1)
    rows = orders(
        spark,
        (1, 1, day, "completed", 10.0),
        (2, 1, day, "shipped", 20.0),
        (3, 2, day, "refunded", 30.0),
        (4, 2, day, "on_hold", 40.0),
        (5, 2, None, "completed", 50.0),
    )
    silver = {r.status: r for r in gold.conversion_funnel(rows).collect()}
    assert silver["refunded"].funnel_stage == "lost" and silver["on_hold"].funnel_stage == "other"
    assert silver["completed"].monthly_conversion_rate_pct == 50.0
    assert silver["completed"].monthly_total_orders == 4
    warehouse = {r.funnel_stage: r for r in marts.monthly_funnel(rows).collect()}
    assert set(warehouse) == {"converted", "in_transit", "refunded", "other"}
    assert warehouse["refunded"].monthly_conversion_rate_pct == 25.0
    assert warehouse["other"].converted_revenue == 10.0


def test_funnel_month_without_conversion(spark):
    row = marts.monthly_funnel(orders(spark, (1, 1, D(2024, 1, 1), "pending", 5.0))).first()
    assert (row.converted_orders, row.converted_revenue, row.monthly_conversion_rate_pct) == (0, 0.0, 0.0)


def test_cohorts_over_a_year_boundary(spark):
    rows = orders(
        spark,
        (1, 1, D(2023, 12, 1), "completed", 1.0),
        (2, 1, D(2023, 12, 31), "shipped", 1.0),
        (3, 1, D(2024, 2, 15), "delivered", 1.0),
        (4, 2, D(2023, 12, 5), "completed", 1.0),
        (5, 2, D(2024, 1, 5), "cancelled", 1.0),
        (6, 3, D(2024, 1, 5), "completed", 1.0),
        (7, 3, None, "completed", 1.0),
        (8, 4, None, "completed", 1.0),
        (9, None, D(2024, 1, 5), "completed", 1.0),
    )
    got = sorted(map(tuple, gold.cohort_retention(rows).fillna(-1, ["period_number"]).collect()))
    december, january = D(2023, 12, 1), D(2024, 1, 1)
    assert got == [
        (december, 2, 0, 2, 100.0, 2023, 12),
        (december, 2, 2, 1, 50.0, 2023, 12),
        (january, 1, -1, 1, 100.0, 2024, 1),
        (january, 1, 0, 1, 100.0, 2024, 1),
    ]


def test_customer_profile_edges(spark):
    everyone = customers(spark, *[(k, True) for k in range(1, 6)]).selectExpr(
        "*", "'US' AS country", "'m' AS gender", "DATE'1990-01-01' AS birth_date", "CAST(NULL AS date) AS churn_date"
    )
    today = D(2024, 7, 1)
    rows = orders(
        spark,
        (1, 1, today - dt.timedelta(90), "completed", 1000.0),
        (2, 2, today - dt.timedelta(180), "completed", 300.0),
        (3, 3, today - dt.timedelta(181), "completed", 299.99),
        (4, 4, today, "cancelled", 5000.0),
    )
    lines = items(spark, (1, 3, 2, 0.0, 1.0), (1, 1, 1, 0.0, 1.0), (1, 2, 1, 0.0, 1.0), (2, 3, 1, 0.0, 1.0))
    got = {
        r.customer_id: (r.engagement_status, r.value_segment, r.preferred_category, r.total_orders)
        for r in marts.customer_360(everyone, rows, lines, products(spark, *CATALOGUE), today).collect()
    }
    assert got == {
        1: ("active", "high_value", "A", 1),  # two units each: the alphabet decides
        2: ("at_risk", "mid_value", "B", 1),
        3: ("lapsed", "low_value", None, 1),
        4: ("never_purchased", "low_value", None, 0),
        5: ("never_purchased", "low_value", None, 0),
    }


# Quality ---------------------------------------------------------------------


def nulls(spark, n_null, n):
    return spark.range(n).selectExpr(f"CASE WHEN id < {n_null} THEN NULL ELSE id END AS a", "id AS b")


def test_null_limit_is_strict(spark):
    quality.enforce_null_limits(nulls(spark, 5, 100), {"a": 5.0, "absent": 0.0}, "t")
    with pytest.raises(quality.DataQualityError, match=r"a is NULL in 6 of 100 rows \(6.00%"):
        quality.enforce_null_limits(nulls(spark, 6, 100), {"a": 5.0}, "t")
    quality.enforce_null_limits(nulls(spark, 6, 100), {"a": 5.0}, "t", override=6.0)


def test_every_broken_limit_is_reported_and_empty_tables_fail(spark):
    both = nulls(spark, 6, 10).selectExpr("a", "a AS c")
    with pytest.raises(quality.DataQualityError, match="a is NULL.*; c is NULL"):
        quality.enforce_null_limits(both, {"a": 5.0, "c": 5.0}, "t")
    for limits in ({"a": 5.0}, {"absent": 5.0}):
        with pytest.raises(quality.DataQualityError, match="no rows"):
            quality.enforce_null_limits(nulls(spark, 0, 0), limits, "t")


def test_suite_counts_violations(spark):
    rows = spark.createDataFrame(
        [(1, "x", 1), (1, "y", 2), (None, None, 1), (None, "x", None)], "id int, kind string, parent int"
    )
    parent = spark.createDataFrame([(1,)], "key int")
    suite = Suite(
        not_null=("id", "kind"),
        unique=("id",),
        accepted_values={"kind": ("x",)},
        unique_combinations=(("kind", "parent"),),
    )
    report = quality.run_suite(rows, suite, {"parent": (parent, "key")}, store=True)
    assert sorted(map(tuple, report.collect())) == [
        ("accepted_values", "kind", 1),
        ("not_null", "id", 2),
        ("not_null", "kind", 1),
        ("relationships", "parent", 1),
        ("unique", "id", 1),
        ("unique_combination", "kind,parent", 0),
    ]
    assert not quality.all_hold(report)


def test_declared_checks_are_complete():
    assert sum(len(s.not_null) for s in SUITES.values()) == 101
    assert sum(len(s.unique) for s in SUITES.values()) == 10
    assert sum(len(s.accepted_values) for s in SUITES.values()) == 11
    assert sum(len(s.references) for s in SUITES.values()) == 3
    assert sum(len(s.unique_combinations) for s in SUITES.values()) == 2


def test_nonpositive_totals_and_days(spark):
    rows = orders(spark, (1, 1, D(2024, 1, 1), "x", 0.0), (2, 1, D(2024, 1, 1), "x", 0.01))
    assert [r.order_id for r in quality.nonpositive_totals(rows).collect()] == [1]
    daily = spark.createDataFrame(
        [(D(2024, 1, 1), 60.0), (D(2024, 1, 1), 39.5), (D(2024, 1, 2), 98.9)], "order_date date, revenue_share_pct double"
    )
    assert [r.order_date for r in quality.unbalanced_days(daily).collect()] == [D(2024, 1, 2)]

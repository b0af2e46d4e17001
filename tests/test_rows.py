"""Row-level operators on hand-made edge rows."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from marlstone.entities import ENTITIES, choose
from marlstone.functions import exact
from marlstone.operators import bronze, documents, marts, silver, staging
from marlstone.operators.dedup import latest_per_key
from marlstone.sources.writers import read_batches  # noqa: F401

DAY = dt.date


def one(df):
    (row,) = df.collect()
    return row


def test_coerce_turns_misfits_into_null_and_keeps_extras(spark):
    rows = spark.createDataFrame(
        [("1", "7", "x"), ("abc", "12.0", "y"), ("3000000000", None, "z")],
        "order_id string, quantity string, channel string",
    )
    out = bronze.coerce(rows, {"order_id": "bigint", "quantity": "int", "absent": "int"})
    assert dict(out.dtypes) == {"order_id": "bigint", "quantity": "int", "channel": "string"}
    assert [tuple(r) for r in out.collect()] == [(1, 7, "x"), (None, 12, "y"), (3000000000, None, "z")]


@pytest.mark.parametrize("kind", ["double", "string"])
def test_coerce_turns_amounts_that_are_no_numbers_into_null(spark, kind):
    texts = ["1.5", "NaN", "Infinity", "-Infinity", None, "-2"]
    rows = spark.createDataFrame([(t,) for t in texts], "total_amount string").select(F.col("total_amount").cast(kind))
    out = bronze.coerce(rows, {"total_amount": "double"})
    assert dict(out.dtypes) == {"total_amount": "double"}
    assert [r.total_amount for r in out.collect()] == [1.5, None, None, None, None, -2.0]


def test_missing_required_column_quarantines_everything(spark):
    rows = spark.createDataFrame([(1,), (2,)], "order_id bigint")
    valid, quarantine = bronze.split_required(rows, ["order_id", "customer_id"])
    assert valid.count() == 0 and quarantine.count() == 2


def test_valid_and_quarantine_partition_the_rows(spark):
    rows = spark.createDataFrame([(1, "a"), (None, "b"), (3, None)], "id bigint, email string")
    valid, quarantine = bronze.split_required(rows, ["id", "email"])
    assert [r.id for r in valid.collect()] == [1]
    assert quarantine.count() == 2


def test_late_flag_is_strict_and_null_for_bad_dates(spark):
    rows = spark.createDataFrame([("2024-01-03",), ("2024-01-02",), ("no date",)], "d string")
    flags = [r._is_late for r in bronze.flag_late(rows, "d", "2024-01-10").collect()]
    assert flags == [False, True, None]


def test_bad_dates_have_no_month(spark):
    rows = spark.createDataFrame([("2024-13-45",), ("2024-02-29",)], "d string")
    got = [(r.order_year, r.order_month) for r in bronze.with_order_month(rows, "d").collect()]
    assert got == [(None, None), (2024, 2)]


def test_dedup_prefers_recent_and_settles_ties(spark):
    rows = spark.createDataFrame(
        [(1, 10, "old"), (1, 20, "new"), (2, 5, "b"), (2, 5, "a"), (3, None, "only")],
        "id bigint, at int, v string",
    )
    for shuffled in (rows, rows.orderBy(F.desc("v")).repartition(3)):
        got = {r.id: r.v for r in latest_per_key(shuffled, "id", ("at",)).collect()}
        assert got == {1: "new", 2: "a", 3: "only"}


def test_orders_fill_total_from_filled_parts(spark):
    columns = ", ".join(f"{c} {t}" for c, t in ENTITIES["orders"].types.items())
    blank = (1, 2, "2024-02-03", "2024-02-03 04:05:06", None, None, None, None, None, 10.25, None, 1.5, None)
    shouting = (2, 2, "bad", "bad", " SHIPPED ", "paypal", "c", "s", "z", 1.0, 2.0, 3.0, 99.0)
    rows = spark.createDataFrame([blank, shouting], columns)
    a, b = silver.silver_rows("orders", rows).orderBy("order_id").collect()
    assert (a.total, a.status, a.shipping_zip, a.payment_method) == (11.75, "pending", "00000", "UNKNOWN")
    assert (a.order_year, a.order_month, a.order_date) == (2024, 2, DAY(2024, 2, 3))
    assert a.order_timestamp == dt.datetime(2024, 2, 3, 4, 5, 6)
    assert (b.status, b.total, b.order_date, b.order_year, b.order_timestamp) == ("shipped", 99.0, None, None, None)


def test_item_total_is_recomputed_only_when_missing(spark):
    rows = spark.createDataFrame(
        [(1, 3, 10.0, 15.0, None), (2, 3, 10.0, None, None), (3, 1, 1.0, 0.0, 5.0), (4, None, 1.0, 0.0, None)],
        "order_item_id int, quantity int, unit_price double, discount_pct double, line_total double",
    )
    got = [r.line_total for r in silver.repair_order_items(rows).orderBy("order_item_id").collect()]
    assert got == [25.5, 30.0, 5.0, None]


@pytest.mark.parametrize(
    "rating, silver_rating, staged_rating", [(None, 0.0, 5.0), (-1.0, 0.0, 0.0), (7.0, 5.0, 5.0), (3.2, 3.2, 3.2)]
)
def test_missing_rating_differs_between_layers(spark, rating, silver_rating, staged_rating):
    columns = ", ".join(f"{c} {t}" for c, t in ENTITIES["products"].types.items())
    row = (1, " P ", "c", None, None, 9.99, None, None, rating, None, None, "2020-01-01")
    rows = spark.createDataFrame([row], columns)
    clean = one(silver.silver_rows("products", rows))
    assert clean.rating == silver_rating
    assert (clean.cost, clean.sub_category, clean.brand, clean.is_active) == (5.0, "General", "UNKNOWN", True)
    assert (clean.weight_kg, clean.review_count) == (0.0, 0)
    staged = one(staging.stage_products(rows))
    assert (staged.rating, staged.product_name, staged.cost) == (staged_rating, "P", None)


def test_customers_keep_undeclared_columns(spark):
    columns = ", ".join(f"{c} {t}" for c, t in ENTITIES["customers"].types.items())
    row = (1, None, "L", "e", None, None, None, None, None, None, "bad", "1990-01-02", None, None, None, None)
    rows = spark.createDataFrame([row], columns).withColumns(
        {"loyalty": F.lit("gold"), "_batch_id": F.lit("b"), "_is_late": F.lit(True)}
    )
    clean = one(silver.silver_rows("customers", rows))
    assert clean.loyalty == "gold" and "_batch_id" not in clean.asDict() and "_is_late" not in clean.asDict()
    assert (clean.zip_code, clean.country, clean.is_churned, clean.phone) == ("00000", "US", False, "UNKNOWN")
    assert (clean.first_name, clean.address, clean.registration_date) == (None, None, None)


def test_staging_orders_mark_missing_zip_unknown(spark):
    columns = ", ".join(f"{c} string" for c in ENTITIES["orders"].types)
    row = ("1", "2", "2024-01-05", "2024-01-05 01:02:03", " Shipped ", "PayPal", None, None, None, "1", "2", "3", "6")
    staged = one(staging.stage_orders(spark.createDataFrame([row], columns)))
    assert (staged.shipping_zip, staged.status, staged.payment_method) == ("UNKNOWN", "shipped", "paypal")
    assert (staged.total, staged.order_year, staged.order_month) == (6.0, 2024, 1)


def test_staging_rejects_text_that_is_no_number(spark):
    columns = ", ".join(f"{c} string" for c in ENTITIES["order_items"].types)
    rows = spark.createDataFrame([("x", "1", "1", "1", "1", "1", "1")], columns)
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        staging.stage_order_items(rows).collect()


@pytest.mark.parametrize(
    "price, tier", [(24.99, "budget"), (25.0, "mid_range"), (100.0, "premium"), (500.0, "luxury")]
)
def test_price_tiers(spark, price, tier):
    rows = _product(spark, price, 1.0)
    assert one(marts.product_dimension(rows)).price_tier == tier


@pytest.mark.parametrize(
    "rating, tier", [(4.5, "top_rated"), (3.5, "well_rated"), (2.5, "average"), (2.49, "poorly_rated")]
)
def test_rating_tiers(spark, rating, tier):
    assert one(marts.product_dimension(_product(spark, 0.0, rating))).rating_tier == tier
    assert one(marts.product_dimension(_product(spark, 0.0, rating))).margin_pct is None


def _product(spark, price, rating):
    columns = ", ".join(f"{c} {t}" for c, t in ENTITIES["products"].types.items())
    return spark.createDataFrame([(1, "p", "c", "s", "b", price, 1.0, 1.0, rating, 1, True, "2020-01-01")], columns)


def test_orders_without_items_have_no_lines(spark):
    rows = spark.createDataFrame(
        [(1, 1, "d", "s", [(7, 2), (8, 1)]), (2, 1, "d", "s", []), (3, 1, "d", "s", None)],
        documents.ORDER_DOCUMENT,
    )
    assert [(r.order_id, r.product_id, r.quantity) for r in documents.order_lines(rows).collect()] == [
        (1, 7, 2),
        (1, 8, 1),
    ]


@pytest.mark.parametrize(
    "parts, cents", [(149, 100), (150, 200), (-150, -200), (-149, -100), (0, 0), (9_999_950, 10_000_000)]
)
def test_cent_rounding_is_half_away_from_zero(spark, parts, cents):
    assert one(spark.range(1).select(exact.to_cent(F.lit(parts).cast("bigint")).alias("c"))).c == cents


def test_sums_do_not_depend_on_order(spark):
    rows = spark.createDataFrame([(x,) for x in (0.1, 0.2, 0.3, 1e9, -1e9)] * 50, "v double")
    sums = {
        one(df.agg(exact.amount(exact.sum_parts(F.col("v"))).alias("s"))).s
        for df in (rows, rows.orderBy("v"), rows.repartition(7))
    }
    assert sums == {30.0}


def test_choose_validates_names():
    assert choose(None, ENTITIES) == list(ENTITIES)
    assert choose(["orders"], ENTITIES) == ["orders"]
    with pytest.raises(ValueError, match="invoices"):
        choose(["invoices"], ENTITIES)

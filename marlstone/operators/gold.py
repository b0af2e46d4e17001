"""The four gold aggregates, computed from silver tables.

Orders are unique by ``order_id`` here; the silver layer sees to that.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marlstone.entities import REVENUE_STATUSES
from marlstone.functions import exact
from marlstone.functions.rules import day, has_status, tiers
from marlstone.operators.lines import per_order_and_product_group, revenue_orders
from marlstone.operators.ranking import with_tile
from marlstone.sources.scratch import written

MONTH_KEYS = ("order_year", "order_month")


# Daily revenue ---------------------------------------------------------------


def daily_revenue_by_category(orders: DataFrame, order_items: DataFrame, products: DataFrame) -> DataFrame:
    """Revenue, volume, list-price margin and share of the day per category and sub-category."""
    group = ["category", "sub_category"]
    measures = [
        exact.sum_parts(F.col("line_total")).alias("revenue"),
        F.sum("quantity").alias("items"),
        exact.sum_parts(F.col("discount_pct")).alias("discounts"),
        F.count("discount_pct").alias("discounted"),
        exact.sum_parts(F.col("quantity") * (F.col("price") - F.col("cost"))).alias("profit"),
    ]
    per_order = per_order_and_product_group(order_items, products, group, measures)
    dated = revenue_orders(orders, "order_id", "order_date", *MONTH_KEYS).filter("order_date IS NOT NULL")
    daily = (
        per_order.join(dated, "order_id")
        .groupBy("order_date", *MONTH_KEYS, *group)
        .agg(
            exact.to_cent(F.sum("revenue")).alias("revenue"),
            # One row per order and group here, so counting rows counts distinct orders.
            F.count("order_id").alias("order_count"),
            F.sum("items").alias("item_count"),
            exact.mean(F.sum("discounts"), F.sum("discounted"), 2).alias("avg_discount_pct"),
            exact.amount(exact.to_cent(F.sum("profit"))).alias("gross_profit"),
        )
    )
    of_day = F.sum("revenue").over(Window.partitionBy("order_date"))
    total_revenue = exact.amount(F.col("revenue"))
    return daily.withColumn("of_day", of_day).select(
        "order_date",
        *group,
        total_revenue.alias("total_revenue"),
        "order_count",
        "item_count",
        exact.mean(F.col("revenue"), F.col("order_count"), 2).alias("avg_order_value"),
        "avg_discount_pct",
        "gross_profit",
        exact.percent(F.col("gross_profit"), total_revenue).alias("margin_pct"),
        exact.percent(total_revenue, exact.amount(F.col("of_day"))).alias("revenue_share_pct"),
        *MONTH_KEYS,
    )


# Customer lifetime value -----------------------------------------------------


def order_revenue(orders: DataFrame, order_items: DataFrame) -> DataFrame:
    """Revenue of each order from its lines, to the cent.

    Lines are folded per order before the join, which then needs no further
    shuffle on their side.
    """
    totals = order_items.groupBy("order_id").agg(
        exact.to_cent(exact.sum_parts(F.col("line_total"))).alias("revenue")
    )
    return totals.join(revenue_orders(orders, "order_id", "customer_id", "order_date"), "order_id")


def customer_stats(orders: DataFrame, order_items: DataFrame, as_of=None) -> DataFrame:
    """Frequency, spend and recency of every customer with a revenue order."""
    first, last, n = F.col("first_order_date"), F.col("last_order_date"), F.col("order_count")
    return (
        order_revenue(orders, order_items)
        .groupBy("customer_id")
        .agg(
            F.count("order_id").alias("order_count"),
            F.sum("revenue").alias("revenue"),
            F.count("revenue").alias("valued_orders"),
            F.min("order_date").alias("first_order_date"),
            F.max("order_date").alias("last_order_date"),
        )
        .select(
            "customer_id",
            "order_count",
            exact.amount(F.col("revenue")).alias("total_revenue"),
            exact.mean(F.col("revenue"), F.col("valued_orders"), 2).alias("avg_order_value"),
            "first_order_date",
            "last_order_date",
            F.datediff(day(as_of), last).alias("days_since_last_order"),
            F.when(n > 1, F.round(F.datediff(last, first) / (n - 1), 1)).alias("avg_days_between_orders"),
        )
    )


def customer_lifetime_value(
    orders: DataFrame, order_items: DataFrame, customers: DataFrame, as_of=None
) -> DataFrame:
    """One row per current customer with spend, recency and revenue tercile.

    Customers without a revenue order count as zero spend.  The tercile needs
    the table twice, so it is written to the shared folder in between.
    """
    current = customers.filter("is_current").select(
        *["customer_id", "first_name", "last_name", "email", "city", "state", "income_bracket"],
        "registration_date",
        F.datediff(day(as_of), "registration_date").alias("days_since_registration"),
        "is_churned",
    )
    spend = current.join(customer_stats(orders, order_items, as_of), "customer_id", "left").fillna(
        {"order_count": 0, "total_revenue": 0.0, "avg_order_value": 0.0}
    )
    tiled = with_tile(written(spend, "customer-spend"), 3, ["total_revenue", "customer_id"], "tile")
    segment = F.element_at(F.array(F.lit("low"), F.lit("medium"), F.lit("high")), F.col("tile"))
    return tiled.select(
        *["customer_id", "first_name", "last_name", "email", "city", "state", "income_bracket"],
        *["registration_date", "days_since_registration"],
        *["order_count", "total_revenue", "avg_order_value", "first_order_date", "last_order_date"],
        *["days_since_last_order", "avg_days_between_orders"],
        segment.alias("clv_segment"),
        "is_churned",
    )


# Conversion funnel -----------------------------------------------------------


def funnel_stage() -> Column:
    """Stage of an order; refunds count as lost."""
    return tiers(
        F.col("status"),
        [
            (has_status(["completed", "delivered"]), "converted"),
            (has_status(["shipped"]), "in_transit"),
            (has_status(["pending"]), "pending"),
            (has_status(["cancelled", "refunded"]), "lost"),
            (has_status(["returned"]), "returned"),
        ],
        otherwise="other",
    )


def conversion_funnel(orders: DataFrame) -> DataFrame:
    """Orders and revenue per month and status, with the month's conversion rate.

    The month's figures are sums over the status rows, so orders are read and
    shuffled once.
    """
    by_status = (
        orders.filter("order_date IS NOT NULL")
        .groupBy(
            F.year("order_date").alias("order_year"), F.month("order_date").alias("order_month"), "status"
        )
        .agg(
            F.count("order_id").alias("order_count"),
            F.count(F.lit(1)).alias("rows"),
            exact.amount(exact.to_cent(exact.sum_parts(F.col("total")))).alias("total_revenue"),
        )
    )
    month = Window.partitionBy(*MONTH_KEYS)
    converted = F.when(has_status(REVENUE_STATUSES), F.col("rows")).otherwise(0)
    monthly = by_status.withColumns(
        {
            "funnel_stage": funnel_stage(),
            "monthly_total_orders": F.sum("order_count").over(month),
            "monthly_converted_orders": F.sum(converted).over(month),
        }
    )
    return monthly.select(
        *MONTH_KEYS,
        "status",
        "funnel_stage",
        "order_count",
        "total_revenue",
        exact.percent(F.col("order_count"), F.col("monthly_total_orders")).alias("pct_of_monthly_orders"),
        "monthly_total_orders",
        "monthly_converted_orders",
        exact.percent(F.col("monthly_converted_orders"), F.col("monthly_total_orders")).alias(
            "monthly_conversion_rate_pct"
        ),
    )


# Cohort retention ------------------------------------------------------------


def cohort_retention(orders: DataFrame) -> DataFrame:
    """Share of each first-purchase cohort that buys again N months later.

    A customer's purchases shrink to the set of months they fall in before they
    are shuffled, so the size of a customer does not matter.  Being distinct per
    customer, the months can then simply be counted, and a cohort's size is the
    number of its customers active in month zero.
    """
    month_number = F.year("order_date") * 12 + F.month("order_date") - 1
    months = (
        revenue_orders(orders, "customer_id", "order_date")
        .filter("customer_id IS NOT NULL")
        .groupBy("customer_id")
        .agg(
            F.collect_set(month_number).alias("months"),
            F.bool_or(F.col("order_date").isNull()).alias("has_undated"),
        )
        .filter(F.size("months") > 0)
    )
    # Undated purchases of a customer with a cohort stay visible as period NULL.
    undated = F.when(F.col("has_undated"), F.array(F.lit(None).cast("int"))).otherwise(
        F.array().cast("array<int>")
    )
    active = months.select(
        F.array_min("months").alias("cohort"), F.explode(F.concat("months", undated)).alias("month")
    )
    retained = active.groupBy("cohort", (F.col("month") - F.col("cohort")).alias("period_number")).agg(
        F.count(F.lit(1)).alias("retained_customers")
    )
    in_month_zero = F.when(F.col("period_number") == 0, F.col("retained_customers"))
    sized = retained.withColumn("cohort_size", F.max(in_month_zero).over(Window.partitionBy("cohort")))
    year, month = F.floor(F.col("cohort") / 12).cast("int"), (F.col("cohort") % 12 + 1).cast("int")
    return sized.select(
        F.make_date(year, month, F.lit(1)).alias("cohort_month"),
        "cohort_size",
        "period_number",
        "retained_customers",
        exact.percent(F.col("retained_customers"), F.col("cohort_size")).alias("retention_rate_pct"),
        year.alias("cohort_year"),
        month.alias("cohort_month_num"),
    )

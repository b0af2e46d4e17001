"""Warehouse models over the staging views.

Several measures share a name with a gold aggregate but are defined differently
(profit after discount, conversion without shipped orders, fixed value bands);
the two families are kept apart on purpose.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marlstone.functions import exact
from marlstone.functions.rules import day, has_status, tiers
from marlstone.operators.dedup import top_per_key
from marlstone.operators.lines import per_order_and_product_group, revenue_orders

MONTH_KEYS = ("order_year", "order_month")
PRODUCT_GROUP = ("category", "sub_category")
TOTALS = ("units", "revenue", "costs", "profit", "discounts", "discounted")


def order_enriched(orders: DataFrame, order_items: DataFrame, products: DataFrame) -> DataFrame:
    """Every order line with its order and product attributes, cost and profit."""
    lines = order_items.join(
        products.select(
            *["product_id", "product_name", "category", "sub_category", "brand"],
            F.col("cost").alias("unit_cost"),
        ),
        "product_id",
    ).join(orders, "order_id")
    item_cost = F.col("quantity") * F.col("unit_cost")
    return lines.select(
        *["order_item_id", "order_id", "customer_id"],
        *["order_date", "order_timestamp", "status", "payment_method"],
        *["shipping_city", "shipping_state", *MONTH_KEYS],
        *["product_id", "product_name", "category", "sub_category", "brand"],
        *["quantity", "unit_price", "discount_pct", "line_total", "unit_cost"],
        item_cost.alias("item_cost"),
        (F.col("line_total") - item_cost).alias("item_gross_profit"),
        *["subtotal", "shipping_cost", "tax"],
        F.col("total").alias("order_total"),
    )


def daily_revenue(orders: DataFrame, order_items: DataFrame, products: DataFrame) -> DataFrame:
    """Revenue, cost and profit per day, category and sub-category."""
    return daily_measures(daily_totals(orders, order_items, products))


def daily_totals(orders: DataFrame, order_items: DataFrame, products: DataFrame) -> DataFrame:
    """What ``daily_measures`` is computed from; totals of disjoint sets of orders add up (``added_totals``)."""
    group = PRODUCT_GROUP
    cost = F.col("quantity") * F.col("cost")
    measures = [
        F.sum("quantity").alias("units"),
        exact.sum_parts(F.col("line_total")).alias("revenue"),
        exact.sum_parts(cost).alias("costs"),
        exact.sum_parts(F.col("line_total") - cost).alias("profit"),
        exact.sum_parts(F.col("discount_pct")).alias("discounts"),
        F.count("discount_pct").alias("discounted"),
    ]
    per_order = per_order_and_product_group(order_items, products, group, measures)
    return (
        per_order.join(revenue_orders(orders, "order_id", "order_date", *MONTH_KEYS), "order_id")
        .groupBy("order_date", *MONTH_KEYS, *group)
        .agg(F.count_distinct("order_id").alias("order_count"), *[F.sum(c).alias(c) for c in TOTALS])
    )


def added_totals(parts: DataFrame) -> DataFrame:
    """``daily_totals`` of all orders from those of disjoint sets of orders."""
    return parts.groupBy("order_date", *MONTH_KEYS, *PRODUCT_GROUP).agg(*[F.sum(c).alias(c) for c in ("order_count", *TOTALS)])


def daily_measures(totals: DataFrame) -> DataFrame:
    """Amounts, margins and shares of the day."""
    daily = totals.select(
        *["order_date", *MONTH_KEYS, *PRODUCT_GROUP, "order_count", "revenue"],
        F.col("units").alias("units_sold"),
        exact.amount(F.col("costs")).alias("total_cost"),
        exact.amount(F.col("profit")).alias("gross_profit"),
        exact.mean(F.col("discounts"), F.col("discounted"), 4).alias("avg_discount_pct"),
    )
    of_day = F.sum("revenue").over(Window.partitionBy("order_date"))
    revenue, day_revenue = exact.amount(F.col("revenue")), exact.amount(F.col("of_day"))
    return daily.withColumn("of_day", of_day).select(
        *["order_date", *MONTH_KEYS, *PRODUCT_GROUP, "order_count", "units_sold"],
        revenue.alias("gross_revenue"),
        "total_cost",
        "gross_profit",
        "avg_discount_pct",
        day_revenue.alias("daily_total_revenue"),
        exact.percent(F.col("gross_profit"), revenue).alias("margin_pct"),
        exact.percent(revenue, day_revenue).alias("revenue_share_pct"),
    )


def funnel_stage() -> Column:
    """Stage of an order; refunds are a stage of their own."""
    return tiers(
        F.col("status"),
        [
            (has_status(["completed", "delivered"]), "converted"),
            (has_status(["shipped"]), "in_transit"),
            (has_status(["pending"]), "pending"),
            (has_status(["cancelled"]), "lost"),
            (has_status(["returned"]), "returned"),
            (has_status(["refunded"]), "refunded"),
        ],
        otherwise="other",
    )


def monthly_funnel(orders: DataFrame) -> DataFrame:
    """Orders, customers and revenue per month and stage, with monthly totals."""
    by_stage = (
        orders.filter("order_year IS NOT NULL AND order_month IS NOT NULL")
        .groupBy(*MONTH_KEYS, funnel_stage().alias("funnel_stage"))
        .agg(
            F.count_distinct("order_id").alias("order_count"),
            F.count_distinct("customer_id").alias("customer_count"),
            exact.sum_parts(F.col("total")).alias("revenue"),
        )
    )
    month = Window.partitionBy(*MONTH_KEYS)
    is_converted = F.col("funnel_stage") == "converted"
    monthly = by_stage.withColumns(
        {
            "total_orders": F.sum("order_count").over(month),
            "converted_orders": F.sum(F.when(is_converted, F.col("order_count")).otherwise(0)).over(month),
            "converted": F.sum(F.when(is_converted, F.col("revenue")).otherwise(0)).over(month),
        }
    )
    return monthly.select(
        *[*MONTH_KEYS, "funnel_stage", "order_count", "customer_count"],
        exact.amount(F.col("revenue")).alias("stage_revenue"),
        *["total_orders", "converted_orders"],
        exact.amount(F.col("converted")).alias("converted_revenue"),
        exact.percent(F.col("order_count"), F.col("total_orders")).alias("stage_share_pct"),
        exact.percent(F.col("converted_orders"), F.col("total_orders")).alias("monthly_conversion_rate_pct"),
    )


def customer_order_stats(orders: DataFrame) -> DataFrame:
    first, last, n = F.col("first_order_date"), F.col("last_order_date"), F.col("total_orders")
    tenure = F.datediff(last, first)
    return (
        revenue_orders(orders, "customer_id", "order_id", "order_date", "total")
        .groupBy("customer_id")
        .agg(
            F.count_distinct("order_id").alias("total_orders"),
            F.min("order_date").alias("first_order_date"),
            F.max("order_date").alias("last_order_date"),
            exact.sum_parts(F.col("total")).alias("spent"),
            F.count("total").alias("valued_orders"),
        )
        .select(
            "customer_id",
            "total_orders",
            "first_order_date",
            "last_order_date",
            exact.amount(F.col("spent")).alias("total_revenue"),
            F.try_divide(exact.amount(F.col("spent")), F.col("valued_orders")).alias("avg_order_value"),
            tenure.alias("customer_tenure_days"),
            F.when(n > 1, tenure / (n - 1)).alias("avg_days_between_orders"),
        )
    )


def category_units(orders: DataFrame, order_items: DataFrame, products: DataFrame) -> DataFrame:
    """Units each customer bought per category."""
    per_order = per_order_and_product_group(
        order_items, products, ["category"], [F.sum("quantity").alias("units")]
    )
    return (
        per_order.join(revenue_orders(orders, "order_id", "customer_id"), "order_id")
        .groupBy("customer_id", "category")
        .agg(F.sum("units").alias("units_bought"))
    )


def preferred_category(orders: DataFrame, order_items: DataFrame, products: DataFrame) -> DataFrame:
    """The category a customer bought most units of; the alphabet settles ties."""
    ranked = top_per_key(
        category_units(orders, order_items, products),
        ["customer_id"],
        [F.desc("units_bought"), F.asc_nulls_last("category")],
    )
    return ranked.select("customer_id", F.col("category").alias("preferred_category"))


def customer_360(
    customers: DataFrame, orders: DataFrame, order_items: DataFrame, products: DataFrame, as_of=None
) -> DataFrame:
    """Customer profile with order statistics, favourite category and segments."""
    today, last_order = day(as_of), F.col("last_order_date")
    revenue = F.coalesce("total_revenue", F.lit(0.0))
    engagement = tiers(
        last_order,
        [
            (last_order >= F.date_sub(today, 90), "active"),
            (last_order >= F.date_sub(today, 180), "at_risk"),
            (F.col("total_orders").isNull(), "never_purchased"),
        ],
        otherwise="lapsed",
    )
    value = tiers(
        revenue, [(revenue >= 1000, "high_value"), (revenue >= 300, "mid_value")], otherwise="low_value"
    )
    profile = customers.join(customer_order_stats(orders), "customer_id", "left").join(
        preferred_category(orders, order_items, products), "customer_id", "left"
    )
    return profile.select(
        *["customer_id", "first_name", "last_name", "email", "city", "state", "country", "gender"],
        *["income_bracket", "registration_date", "birth_date", "is_churned", "churn_date"],
        F.coalesce("total_orders", F.lit(0)).alias("total_orders"),
        "first_order_date",
        "last_order_date",
        revenue.alias("total_revenue"),
        F.coalesce("avg_order_value", F.lit(0.0)).alias("avg_order_value"),
        "avg_days_between_orders",
        "customer_tenure_days",
        "preferred_category",
        F.datediff(today, "registration_date").alias("days_since_registration"),
        engagement.alias("engagement_status"),
        value.alias("value_segment"),
    )


def product_dimension(products: DataFrame) -> DataFrame:
    """Current catalogue with margin and tiers."""
    price, rating = F.col("price"), F.col("rating")
    margin = price - F.col("cost")
    return products.select(
        *["product_id", "product_name", "category", "sub_category", "brand", "price", "cost"],
        F.round(margin, 2).alias("unit_margin"),
        exact.percent(margin, price).alias("margin_pct"),
        *["weight_kg", "rating", "review_count", "is_active", "created_date"],
        tiers(
            price, [(price < 25, "budget"), (price < 100, "mid_range"), (price < 500, "premium")], "luxury"
        ).alias("price_tier"),
        tiers(
            rating,
            [(rating >= 4.5, "top_rated"), (rating >= 3.5, "well_rated"), (rating >= 2.5, "average")],
            "poorly_rated",
        ).alias("rating_tier"),
    )

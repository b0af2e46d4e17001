"""Typed staging views over untyped source rows.

These rules are stricter than the silver ones: text that does not fit its type
is an error, except for ``churn_date``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ID, WHOLE, AMOUNT, DAY, FLAG = "bigint", "int", "double", "date", "boolean"
UNKNOWN = "UNKNOWN"  # fixed value


def _as(kind: str, *names: str) -> list[Column]:
    return [F.col(n).cast(kind).alias(n) for n in names]


def _trimmed(*names: str) -> list[Column]:
    return [F.trim(n).alias(n) for n in names]


def _or_unknown(*names: str) -> list[Column]:
    return [F.coalesce(n, F.lit(UNKNOWN)).alias(n) for n in names]


def stage_customers(raw: DataFrame) -> DataFrame:
    return raw.select(
        *_as(ID, "customer_id"),
        *_trimmed("first_name", "last_name"),
        F.lower(F.trim("email")).alias("email"),
        *["phone", "address", "city", "state", "zip_code", "country"],
        *_as(DAY, "registration_date", "birth_date"),
        F.lower("gender").alias("gender"),
        "income_bracket",
        *_as(FLAG, "is_churned"),
        F.col("churn_date").try_cast(DAY).alias("churn_date"),
    )


def stage_orders(raw: DataFrame) -> DataFrame:
    ordered_on = F.col("order_date").cast(DAY)
    return raw.select(
        *_as(ID, "order_id", "customer_id"),
        *_as(DAY, "order_date"),
        *_as("timestamp", "order_timestamp"),
        F.lower(F.trim("status")).alias("status"),
        F.lower("payment_method").alias("payment_method"),
        *_or_unknown("shipping_city", "shipping_state", "shipping_zip"),
        *_as(AMOUNT, "subtotal", "shipping_cost", "tax", "total"),
        F.year(ordered_on).alias("order_year"),
        F.month(ordered_on).alias("order_month"),
    )


def stage_order_items(raw: DataFrame) -> DataFrame:
    return raw.select(
        *_as(ID, "order_item_id", "order_id", "product_id"),
        *_as(WHOLE, "quantity"),
        *_as(AMOUNT, "unit_price", "discount_pct", "line_total"),
    )


def stage_products(raw: DataFrame) -> DataFrame:
    # least() skips NULL, so a missing rating comes out as the upper bound.
    rating = F.greatest(F.lit(0.0), F.least(F.lit(5.0), F.col("rating").cast(AMOUNT)))
    return raw.select(
        *_as(ID, "product_id"),
        *_trimmed("product_name"),
        *["category", "sub_category", "brand"],
        *_as(AMOUNT, "price", "cost", "weight_kg"),
        rating.alias("rating"),
        *_as(WHOLE, "review_count"),
        *_as(FLAG, "is_active"),
        *_as(DAY, "created_date"),
    )


STAGES = {
    "customers": stage_customers,
    "orders": stage_orders,
    "order_items": stage_order_items,
    "products": stage_products,
}

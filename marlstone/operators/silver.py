"""Null rules of the silver layer, one operator per entity."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marlstone.entities import BRONZE_COLUMNS, ENTITIES
from marlstone.functions.rules import as_dates, filled, moment

# --- Fixed values: defaults for missing attributes. ---------------------------

ORDER_DEFAULTS = {
    "shipping_city": "UNKNOWN",
    "shipping_state": "UNKNOWN",
    "shipping_zip": "00000",
    "payment_method": "UNKNOWN",
    "subtotal": 0.0,
    "shipping_cost": 0.0,
    "tax": 0.0,
}
MISSING_STATUS = "pending"

CUSTOMER_DEFAULTS = {
    "phone": "UNKNOWN",
    "city": "UNKNOWN",
    "state": "UNKNOWN",
    "zip_code": "00000",
    "country": "US",
    "gender": "UNKNOWN",
    "income_bracket": "UNKNOWN",
    "is_churned": False,
}

PRODUCT_DEFAULTS = {
    "sub_category": "General",
    "brand": "UNKNOWN",
    "weight_kg": 0.0,
    "review_count": 0,
    "is_active": True,
}
LOWEST_RATING, HIGHEST_RATING = 0.0, 5.0
COST_SHARE_OF_PRICE = 0.5

# --- End of fixed values. -----------------------------------------------------


def repair_orders(df: DataFrame) -> DataFrame:
    status = F.coalesce(F.lower(F.trim("status")), F.lit(MISSING_STATUS))
    dated = df.withColumns(
        {
            **filled(ORDER_DEFAULTS),
            **as_dates(["order_date"]),
            "status": status,
            "order_timestamp": F.col("order_timestamp").try_cast("timestamp"),
        }
    )
    # The second step reads the values filled in and parsed by the first.
    return dated.withColumns(
        {
            "total": F.coalesce("total", F.col("subtotal") + F.col("shipping_cost") + F.col("tax")),
            "order_year": F.year("order_date"),
            "order_month": F.month("order_date"),
        }
    )


def repair_order_items(df: DataFrame) -> DataFrame:
    discount = F.coalesce("discount_pct", F.lit(0.0))
    net = F.col("quantity") * F.col("unit_price") * (F.lit(1) - discount / 100)
    return df.withColumns(
        {"discount_pct": discount, "line_total": F.coalesce("line_total", F.round(net, 2))}
    )


def repair_customers(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {**filled(CUSTOMER_DEFAULTS), **as_dates(["registration_date", "birth_date", "churn_date"])}
    )


def repair_products(df: DataFrame) -> DataFrame:
    rating = F.when(F.col("rating").isNull(), LOWEST_RATING).otherwise(
        F.greatest(F.lit(LOWEST_RATING), F.least(F.lit(HIGHEST_RATING), "rating"))
    )
    estimate = F.round(F.col("price") * COST_SHARE_OF_PRICE, 2)
    return df.withColumns(
        {
            **filled(PRODUCT_DEFAULTS),
            **as_dates(["created_date"]),
            "rating": rating,
            "cost": F.coalesce("cost", estimate),
        }
    )


REPAIRS = {
    "customers": repair_customers,
    "products": repair_products,
    "orders": repair_orders,
    "order_items": repair_order_items,
}


def without_bronze_columns(df: DataFrame) -> DataFrame:
    return df.drop(*BRONZE_COLUMNS)


def stamp_silver(df: DataFrame, processed_at=None) -> DataFrame:
    return df.withColumn("_silver_processed_at", moment(processed_at))


def silver_rows(entity_name: str, deduplicated: DataFrame) -> DataFrame:
    """Repaired rows of one entity in the silver column order."""
    entity = ENTITIES[entity_name]
    clean = without_bronze_columns(REPAIRS[entity_name](deduplicated))
    if entity.keeps_extras:
        return clean
    return clean.select(*entity.types, *entity.partition_by)

"""Joins and pre-aggregates over order lines that several marts build on."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame

from marlstone.entities import REVENUE_STATUSES
from marlstone.functions.rules import has_status


def revenue_orders(orders: DataFrame, *columns: str) -> DataFrame:
    """Orders whose payment was captured and kept."""
    return orders.filter(has_status(REVENUE_STATUSES)).select(*columns)


def revenue_lines(orders: DataFrame, order_items: DataFrame, products: DataFrame) -> DataFrame:
    """One row per line of a revenue order, with product and order attributes.

    No join is hinted: Spark broadcasts a side only when its size is known to
    be small, and otherwise splits skewed partitions at run time.
    """
    catalogue = products.select("product_id", "category", "sub_category", "price", "cost")
    headers = revenue_orders(
        orders, "order_id", "customer_id", "order_date", "order_year", "order_month", "total"
    )
    return order_items.join(catalogue, "product_id").join(headers, "order_id")


def per_order_and_product_group(
    order_items: DataFrame, products: DataFrame, group: Sequence[str], measures: Sequence[Column]
) -> DataFrame:
    """Line measures per order and product attributes, before any order is joined.

    Each task first folds its own lines, so an order with very many lines
    reaches the order join as a handful of rows.
    """
    used = [c for c in ("price", "cost") if c in products.columns]
    lines = order_items.join(products.select("product_id", *group, *used), "product_id")
    return lines.groupBy("order_id", *group).agg(*measures)

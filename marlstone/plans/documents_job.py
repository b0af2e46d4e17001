"""The document pipeline: nested orders to flat tables to two reports.

Its tables have other columns than the silver job's, so give it folders of its own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from marlstone.operators.documents import (
    CUSTOMER_DOCUMENT,
    ORDER_DOCUMENT,
    PRODUCT_DOCUMENT,
    contactable_customers,
    customer_summary,
    order_lines,
    priced_products,
    revenue_by_category,
)
from marlstone.sources.readers import CORRUPT, locate, read_json, read_parquet
from marlstone.sources.writers import write_table

SOURCES = {
    "customers": (CUSTOMER_DOCUMENT, contactable_customers),
    "products": (PRODUCT_DOCUMENT, priced_products),
    "orders": (ORDER_DOCUMENT, order_lines),
}


def flatten_documents(
    spark: SparkSession, source_base: str, silver_base: str, layout: str = "lines"
) -> dict[str, DataFrame]:
    """``<source_base>/<name>/<name>.json`` to ``<silver_base>/<name>``."""
    tables = {}
    for name, (schema, clean) in SOURCES.items():
        source = locate(source_base, name, f"{name}.json")
        raw = read_json(spark, source, layout=layout, schema=schema).drop(CORRUPT)
        tables[name] = write_table(clean(raw), locate(silver_base, name))
    return tables


def report_documents(spark: SparkSession, silver_base: str, gold_base: str) -> dict[str, DataFrame]:
    lines, products, customers = (
        read_parquet(spark, locate(silver_base, name)) for name in ("orders", "products", "customers")
    )
    reports = {
        "revenue_by_category": revenue_by_category(lines, products),
        "customer_summary": customer_summary(lines, customers),
    }
    return {name: write_table(report, locate(gold_base, name)) for name, report in reports.items()}

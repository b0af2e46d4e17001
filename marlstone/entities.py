"""The four business entities and the fixed values the layers agree on."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

# --- Fixed values: these must stay as they are for results to be right. ------

CUSTOMER_TYPES = {
    "customer_id": "bigint",
    "first_name": "string",
    "last_name": "string",
    "email": "string",
    "phone": "string",
    "address": "string",
    "city": "string",
    "state": "string",
    "zip_code": "string",
    "country": "string",
    "registration_date": "string",
    "birth_date": "string",
    "gender": "string",
    "income_bracket": "string",
    "is_churned": "boolean",
    "churn_date": "string",
}

PRODUCT_TYPES = {
    "product_id": "bigint",
    "product_name": "string",
    "category": "string",
    "sub_category": "string",
    "brand": "string",
    "price": "double",
    "cost": "double",
    "weight_kg": "double",
    "rating": "double",
    "review_count": "int",
    "is_active": "boolean",
    "created_date": "string",
}

ORDER_TYPES = {
    "order_id": "bigint",
    "customer_id": "bigint",
    "order_date": "string",
    "order_timestamp": "string",
    "status": "string",
    "payment_method": "string",
    "shipping_city": "string",
    "shipping_state": "string",
    "shipping_zip": "string",
    "subtotal": "double",
    "shipping_cost": "double",
    "tax": "double",
    "total": "double",
}

ORDER_ITEM_TYPES = {
    "order_item_id": "bigint",
    "order_id": "bigint",
    "product_id": "bigint",
    "quantity": "int",
    "unit_price": "double",
    "discount_pct": "double",
    "line_total": "double",
}

REVENUE_STATUSES = ("completed", "delivered", "shipped")

# Attributes whose change opens a new customer version.
TRACKED_CUSTOMER_COLUMNS = (
    "email",
    "phone",
    "address",
    "city",
    "state",
    "zip_code",
    "income_bracket",
    "is_churned",
)

LATE_AFTER_DAYS = 7
DEFAULT_NULL_LIMIT = 5.0  # percent
OPEN_END = "9999-12-31 00:00:00"

# Columns the bronze layer adds and the silver layer removes again.
BRONZE_COLUMNS = ("_ingested_at", "_source_file", "_batch_id", "_is_late")

# --- End of fixed values. -----------------------------------------------------


@dataclass(frozen=True)
class Entity:
    """What every layer needs to know about one table."""

    name: str
    key: str
    types: Mapping[str, str]
    required: tuple[str, ...]
    gated: tuple[str, ...]  # columns whose share of nulls is limited in silver
    partition_by: tuple[str, ...] = ()
    date_column: str | None = None
    keeps_extras: bool = False  # does silver keep undeclared columns?
    null_limit: float = field(default=DEFAULT_NULL_LIMIT)

    @property
    def file(self) -> str:
        return f"{self.name}.json"

    @property
    def null_limits(self) -> dict[str, float]:
        return dict.fromkeys(self.gated, self.null_limit)


ENTITIES: dict[str, Entity] = {
    e.name: e
    for e in (
        Entity(
            name="customers",
            key="customer_id",
            types=CUSTOMER_TYPES,
            required=("customer_id", "email"),
            gated=("customer_id", "email", "first_name"),
            keeps_extras=True,
        ),
        Entity(
            name="products",
            key="product_id",
            types=PRODUCT_TYPES,
            required=("product_id", "price"),
            gated=("product_id", "product_name", "price", "category"),
        ),
        Entity(
            name="orders",
            key="order_id",
            types=ORDER_TYPES,
            required=("order_id", "customer_id", "order_date"),
            gated=("order_id", "customer_id", "order_date", "total"),
            partition_by=("order_year", "order_month"),
            date_column="order_date",
        ),
        Entity(
            name="order_items",
            key="order_item_id",
            types=ORDER_ITEM_TYPES,
            required=("order_item_id", "order_id", "product_id"),
            gated=("order_item_id", "order_id", "product_id", "quantity", "unit_price"),
        ),
    )
}


def choose(names, available: Mapping[str, object]) -> list[str]:
    """Validate a user's selection; no selection means everything."""
    if not names:
        return list(available)
    unknown = sorted(set(names) - set(available))
    if unknown:
        raise ValueError(f"unknown name(s) {unknown}; choose from {sorted(available)}")
    return list(names)

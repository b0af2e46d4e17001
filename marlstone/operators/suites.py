"""The declared checks of every warehouse model.

Fixed values: column names, accepted values and references of the checks.
"""

from __future__ import annotations

from dataclasses import dataclass, field

STATUSES = ("completed", "shipped", "delivered", "cancelled", "returned", "refunded", "pending")
PAYMENT_METHODS = ("credit_card", "debit_card", "paypal", "apple_pay", "google_pay", "gift_card")
GENDERS = ("m", "f", "other")
INCOME_BRACKETS = ("low", "medium", "high", "premium")
FUNNEL_STAGES = ("converted", "in_transit", "pending", "lost", "returned", "refunded", "other")
ENGAGEMENT = ("active", "at_risk", "lapsed", "never_purchased")
VALUE_SEGMENTS = ("high_value", "mid_value", "low_value")
PRICE_TIERS = ("budget", "mid_range", "premium", "luxury")
RATING_TIERS = ("top_rated", "well_rated", "average", "poorly_rated")


@dataclass(frozen=True)
class Suite:
    not_null: tuple[str, ...]
    unique: tuple[str, ...] = ()
    accepted_values: dict[str, tuple[str, ...]] = field(default_factory=dict)
    references: dict[str, tuple[str, str]] = field(default_factory=dict)  # column -> (model, column)
    unique_combinations: tuple[tuple[str, ...], ...] = ()


SUITES = {
    "stg_customers": Suite(
        not_null=("customer_id", "first_name", "last_name", "email", "city", "state", "country", "registration_date", "gender", "income_bracket", "is_churned"),
        unique=("customer_id", "email"),
        accepted_values={"gender": GENDERS, "income_bracket": INCOME_BRACKETS},
    ),
    "stg_products": Suite(
        not_null=("product_id", "product_name", "category", "sub_category", "brand", "price", "cost", "rating", "review_count", "is_active", "created_date"),
        unique=("product_id",),
    ),
    "stg_orders": Suite(
        not_null=("order_id", "customer_id", "order_date", "order_timestamp", "status", "payment_method", "shipping_city", "shipping_state", "shipping_zip", "subtotal", "shipping_cost", "tax", "total", "order_year", "order_month"),
        unique=("order_id",),
        accepted_values={"status": STATUSES, "payment_method": PAYMENT_METHODS},
        references={"customer_id": ("stg_customers", "customer_id")},
    ),
    "stg_order_items": Suite(
        not_null=("order_item_id", "order_id", "product_id", "quantity", "unit_price", "discount_pct", "line_total"),
        unique=("order_item_id",),
        references={
            "order_id": ("stg_orders", "order_id"),
            "product_id": ("stg_products", "product_id"),
        },
    ),
    "int_order_enriched": Suite(
        not_null=("order_item_id", "order_id", "customer_id", "order_date", "order_year", "order_month", "status", "category", "sub_category", "quantity", "line_total", "unit_cost", "item_cost", "order_total"),
        unique=("order_item_id",),
    ),
    "int_customer_360": Suite(
        not_null=("customer_id", "email", "total_orders", "total_revenue", "avg_order_value", "days_since_registration", "engagement_status", "value_segment"),
        unique=("customer_id", "email"),
        accepted_values={"engagement_status": ENGAGEMENT, "value_segment": VALUE_SEGMENTS},
    ),
    "fct_daily_revenue": Suite(
        not_null=("order_date", "order_year", "order_month", "category", "sub_category", "order_count", "units_sold", "gross_revenue", "total_cost", "daily_total_revenue"),
        unique_combinations=(("order_date", "category", "sub_category"),),
    ),
    "fct_conversion_funnel": Suite(
        not_null=("order_year", "order_month", "funnel_stage", "order_count", "customer_count", "total_orders", "converted_orders", "converted_revenue", "monthly_conversion_rate_pct"),
        accepted_values={"funnel_stage": FUNNEL_STAGES},
        unique_combinations=(("order_year", "order_month", "funnel_stage"),),
    ),
    "dim_customers": Suite(
        not_null=("customer_key", "customer_id", "is_churned", "effective_from", "is_current", "last_updated_at"),
        unique=("customer_key",),
        accepted_values={"gender": GENDERS, "income_bracket": INCOME_BRACKETS},
    ),
    "dim_products": Suite(
        not_null=("product_id", "product_name", "category", "sub_category", "price", "cost", "rating", "is_active", "price_tier", "rating_tier"),
        unique=("product_id",),
        accepted_values={"price_tier": PRICE_TIERS, "rating_tier": RATING_TIERS},
    ),
}

"""Staging views, intermediate models, marts and document reports."""

from __future__ import annotations

from marlstone.operators import documents, marts, staging
from marlstone.workload.gold_queries import REVENUE
from marlstone.workload.inputs import AS_OF, load, order_document_lines_sql, order_documents
from marlstone.workload.registry import (
    double,
    exact_sum,
    instant,
    percent,
    query,
    whole,
    with_inputs,
)

STAGED_CUSTOMERS_SQL = f"""SELECT {whole('customer_id')} AS customer_id, trim(first_name) AS first_name,
      trim(last_name) AS last_name, lower(trim(email)) AS email, phone, address, city, state, zip_code,
      country, CAST(registration_date AS DATE) AS registration_date, CAST(birth_date AS DATE) AS birth_date,
      lower(gender) AS gender, income_bracket, is_churned, TRY_CAST(churn_date AS DATE) AS churn_date
    FROM e_raw_customers"""

STAGED_ORDERS_SQL = f"""SELECT {whole('order_id')} AS order_id, {whole('customer_id')} AS customer_id,
      CAST(order_date AS DATE) AS order_date,
      {instant('CAST(order_timestamp AS TIMESTAMP)')} AS order_timestamp,
      lower(trim(status)) AS status, lower(payment_method) AS payment_method,
      coalesce(shipping_city, 'UNKNOWN') AS shipping_city,
      coalesce(shipping_state, 'UNKNOWN') AS shipping_state,
      coalesce(shipping_zip, 'UNKNOWN') AS shipping_zip, subtotal, shipping_cost, tax, total,
      year(CAST(order_date AS DATE)) AS order_year, month(CAST(order_date AS DATE)) AS order_month
    FROM e_source_orders"""

STAGED_ITEMS_SQL = f"""SELECT {whole('order_item_id')} AS order_item_id, {whole('order_id')} AS order_id,
      {whole('product_id')} AS product_id, {whole('quantity')} AS quantity, unit_price, discount_pct,
      line_total FROM e_raw_order_items"""

STAGED_PRODUCTS_SQL = f"""SELECT {whole('product_id')} AS product_id, trim(product_name) AS product_name,
      category, sub_category, brand, price, cost, weight_kg,
      CASE WHEN rating IS NULL OR rating > 5 THEN 5.0 WHEN rating < 0 THEN 0.0 ELSE rating END AS rating,
      {whole('review_count')} AS review_count, is_active, CAST(created_date AS DATE) AS created_date
    FROM e_raw_products"""


@query("stg_customers", with_inputs(STAGED_CUSTOMERS_SQL, "raw_customers"))
def stg_customers(spark, folder):
    return staging.stage_customers(load(spark, folder, "raw_customers"))


@query("stg_orders", with_inputs(STAGED_ORDERS_SQL, "source_orders"))
def stg_orders(spark, folder):
    return staging.stage_orders(load(spark, folder, "source_orders"))


@query("stg_order_items", with_inputs(STAGED_ITEMS_SQL, "raw_order_items"))
def stg_order_items(spark, folder):
    return staging.stage_order_items(load(spark, folder, "raw_order_items"))


@query("stg_products", with_inputs(STAGED_PRODUCTS_SQL, "raw_products"))
def stg_products(spark, folder):
    return staging.stage_products(load(spark, folder, "raw_products"))


ENRICHED_SQL = f"""SELECT order_item_id, order_id, customer_id, order_date,
      {instant('order_timestamp')} AS order_timestamp, status, payment_method, shipping_city,
      shipping_state, {whole('order_year')} AS order_year, {whole('order_month')} AS order_month, product_id,
      product_name, category, sub_category, brand, {whole('quantity')} AS quantity, unit_price,
      discount_pct, line_total, cost AS unit_cost, quantity * cost AS item_cost,
      line_total - quantity * cost AS item_gross_profit, subtotal, shipping_cost, tax, total AS order_total
    FROM e_products JOIN e_order_items USING (product_id) JOIN e_orders USING (order_id)"""


@query("order_enriched", with_inputs(ENRICHED_SQL, "orders", "order_items", "products"))
def order_enriched(spark, folder):
    return marts.order_enriched(*(load(spark, folder, n) for n in ("orders", "order_items", "products")))


FCT_DAILY_SQL = f"""SELECT order_date, {whole('order_year')} AS order_year, {whole('order_month')} AS order_month,
      category, sub_category, order_count, units_sold, {double('revenue')} AS gross_revenue,
      {double('costs')} AS total_cost, {double('profit')} AS gross_profit,
      round({double('discounts')} / discounted, 4) AS avg_discount_pct,
      {double('day_revenue')} AS daily_total_revenue, {percent('profit', 'revenue')} AS margin_pct,
      {percent('revenue', 'day_revenue')} AS revenue_share_pct
    FROM daily JOIN days USING (order_date)"""
FCT_DAILY_PARTS = {
    "daily": f"""SELECT order_date, order_year, order_month, category, sub_category,
          count(DISTINCT order_id) AS order_count, {whole('sum(quantity)')} AS units_sold,
          {exact_sum('line_total')} AS revenue, {exact_sum('quantity * cost')} AS costs,
          {exact_sum('line_total - quantity * cost')} AS profit,
          {exact_sum('discount_pct')} AS discounts, count(discount_pct) AS discounted
        FROM e_orders JOIN e_order_items USING (order_id) JOIN e_products USING (product_id)
        WHERE status IN {REVENUE} GROUP BY ALL""",
    "days": "SELECT order_date, sum(revenue) AS day_revenue FROM daily GROUP BY order_date",
}


@query(
    "fct_daily_revenue",
    with_inputs(FCT_DAILY_SQL, "orders", "order_items", "products", **FCT_DAILY_PARTS),
)
def fct_daily_revenue(spark, folder):
    return marts.daily_revenue(*(load(spark, folder, n) for n in ("orders", "order_items", "products")))


FCT_FUNNEL_SQL = f"""SELECT {whole('order_year')} AS order_year, {whole('order_month')} AS order_month,
      funnel_stage, order_count, customer_count, {double('revenue')} AS stage_revenue, total_orders,
      converted_orders, {double('converted_revenue')} AS converted_revenue,
      {percent('order_count', 'total_orders')} AS stage_share_pct,
      {percent('converted_orders', 'total_orders')} AS monthly_conversion_rate_pct
    FROM stages JOIN months USING (order_year, order_month)"""
FCT_FUNNEL_PARTS = {
    "staged": """SELECT *, CASE status WHEN 'completed' THEN 'converted' WHEN 'delivered' THEN 'converted'
          WHEN 'shipped' THEN 'in_transit' WHEN 'pending' THEN 'pending' WHEN 'cancelled' THEN 'lost'
          WHEN 'returned' THEN 'returned' WHEN 'refunded' THEN 'refunded' ELSE 'other' END AS funnel_stage
        FROM e_orders""",
    "stages": f"""SELECT order_year, order_month, funnel_stage, count(DISTINCT order_id) AS order_count,
          count(DISTINCT customer_id) AS customer_count, {exact_sum('total')} AS revenue
        FROM staged GROUP BY ALL""",
    "months": f"""SELECT order_year, order_month, {whole('sum(order_count)')} AS total_orders,
          {whole("coalesce(sum(order_count) FILTER (WHERE funnel_stage = 'converted'), 0)")}
            AS converted_orders,
          coalesce(sum(revenue) FILTER (WHERE funnel_stage = 'converted'), 0) AS converted_revenue
        FROM stages GROUP BY ALL""",
}


@query("fct_conversion_funnel", with_inputs(FCT_FUNNEL_SQL, "orders", **FCT_FUNNEL_PARTS))
def fct_conversion_funnel(spark, folder):
    df = marts.monthly_funnel(load(spark, folder, "orders"))
    return df.orderBy("order_year", "order_month", "funnel_stage")


_TENURE = "date_diff('day', first_order_date, last_order_date)"
ORDER_STATS_SQL = f"""SELECT customer_id, total_orders, first_order_date, last_order_date,
      {double('spent')} AS total_revenue, {double('spent')} / valued AS avg_order_value,
      {_TENURE} AS customer_tenure_days,
      CASE WHEN total_orders > 1 THEN {_TENURE} / {double('total_orders - 1')} END AS avg_days_between_orders
    FROM (SELECT customer_id, count(DISTINCT order_id) AS total_orders, min(order_date) AS first_order_date,
            max(order_date) AS last_order_date, {exact_sum('total')} AS spent, count(total) AS valued
          FROM e_orders WHERE status IN {REVENUE} GROUP BY customer_id)"""
UNITS_SQL = f"""SELECT customer_id, category, {whole('sum(quantity)')} AS units_bought
    FROM e_orders JOIN e_order_items USING (order_id) JOIN e_products USING (product_id)
    WHERE status IN {REVENUE} GROUP BY ALL"""
PREFERRED_SQL = """SELECT customer_id, category AS preferred_category FROM units
    QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY units_bought DESC, category) = 1"""


@query("customer_order_stats", with_inputs(ORDER_STATS_SQL, "orders"))
def customer_order_stats(spark, folder):
    return marts.customer_order_stats(load(spark, folder, "orders"))


@query("category_units", with_inputs(UNITS_SQL, "orders", "order_items", "products"))
def category_units(spark, folder):
    return marts.category_units(*(load(spark, folder, n) for n in ("orders", "order_items", "products")))


@query(
    "preferred_category",
    with_inputs(PREFERRED_SQL, "orders", "order_items", "products", units=UNITS_SQL),
)
def preferred_category(spark, folder):
    return marts.preferred_category(*(load(spark, folder, n) for n in ("orders", "order_items", "products")))


PROFILE_SQL = f"""SELECT customer_id, first_name, last_name, email, city, state, country, gender,
      income_bracket, registration_date, birth_date, is_churned, churn_date,
      coalesce(total_orders, 0) AS total_orders, first_order_date, last_order_date,
      coalesce(total_revenue, 0) AS total_revenue, coalesce(avg_order_value, 0) AS avg_order_value,
      avg_days_between_orders, customer_tenure_days, preferred_category,
      date_diff('day', registration_date, DATE '{AS_OF}') AS days_since_registration,
      CASE WHEN total_orders IS NULL THEN 'never_purchased'
           WHEN date_diff('day', last_order_date, DATE '{AS_OF}') <= 90 THEN 'active'
           WHEN date_diff('day', last_order_date, DATE '{AS_OF}') <= 180 THEN 'at_risk'
           ELSE 'lapsed' END AS engagement_status,
      CASE WHEN total_revenue >= 1000 THEN 'high_value' WHEN total_revenue >= 300 THEN 'mid_value'
           ELSE 'low_value' END AS value_segment
    FROM e_customers LEFT JOIN stats USING (customer_id) LEFT JOIN preferred USING (customer_id)"""


@query(
    "customer_360",
    with_inputs(
        PROFILE_SQL,
        "customers",
        "orders",
        "order_items",
        "products",
        stats=ORDER_STATS_SQL,
        units=UNITS_SQL,
        preferred=PREFERRED_SQL,
    ),
)
def customer_360(spark, folder):
    inputs = (load(spark, folder, n) for n in ("customers", "orders", "order_items", "products"))
    return marts.customer_360(*inputs, AS_OF)


DIM_PRODUCTS_SQL = f"""SELECT product_id, product_name, category, sub_category, brand, price, cost,
      round(price - cost, 2) AS unit_margin, {percent('price - cost', 'price')} AS margin_pct, weight_kg, rating,
      {whole('review_count')} AS review_count, is_active, created_date,
      CASE WHEN price >= 500 THEN 'luxury' WHEN price >= 100 THEN 'premium' WHEN price >= 25 THEN 'mid_range'
           ELSE 'budget' END AS price_tier,
      CASE WHEN rating < 2.5 THEN 'poorly_rated' WHEN rating < 3.5 THEN 'average'
           WHEN rating < 4.5 THEN 'well_rated' ELSE 'top_rated' END AS rating_tier
    FROM e_products"""


@query("dim_products", with_inputs(DIM_PRODUCTS_SQL, "products"))
def dim_products(spark, folder):
    return marts.product_dimension(load(spark, folder, "products"))


# Document pipeline -----------------------------------------------------------

DOCUMENT_CUSTOMERS_SQL = """SELECT * FROM (SELECT * FROM e_customer_documents QUALIFY row_number() OVER (
      PARTITION BY customer_id ORDER BY city, created_at, email, name, state) = 1) WHERE email IS NOT NULL"""
DOCUMENT_PRODUCTS_SQL = "SELECT * FROM e_product_documents WHERE price > 0"


@query("contactable_customers", with_inputs(DOCUMENT_CUSTOMERS_SQL, "customer_documents"))
def contactable_customers(spark, folder):
    return documents.contactable_customers(load(spark, folder, "customer_documents"))


@query("priced_products", with_inputs(DOCUMENT_PRODUCTS_SQL, "product_documents"))
def priced_products(spark, folder):
    return documents.priced_products(load(spark, folder, "product_documents"))


@query("explode_order_items", order_document_lines_sql())
def explode_order_items(spark, folder):
    return documents.order_lines(order_documents(spark, folder))


CATEGORY_REVENUE_SQL = f"""SELECT category, {double(exact_sum('quantity * price'))} AS total_revenue,
      count(order_id) AS total_orders FROM lines JOIN known USING (product_id) GROUP BY category"""


@query(
    "revenue_by_category",
    with_inputs(
        CATEGORY_REVENUE_SQL,
        "product_documents",
        lines=order_document_lines_sql(),
        known=DOCUMENT_PRODUCTS_SQL,
    ),
)
def revenue_by_category(spark, folder):
    products = documents.priced_products(load(spark, folder, "product_documents"))
    return documents.revenue_by_category(documents.order_lines(order_documents(spark, folder)), products)


SUMMARY_SQL = f"""SELECT customer_id, name, city, state, count(DISTINCT order_id) AS num_orders,
      {whole('sum(quantity)')} AS total_items FROM lines JOIN known USING (customer_id) GROUP BY ALL"""


@query(
    "customer_summary",
    with_inputs(
        SUMMARY_SQL,
        "customer_documents",
        lines=order_document_lines_sql(),
        known=DOCUMENT_CUSTOMERS_SQL,
    ),
)
def customer_summary(spark, folder):
    customers = documents.contactable_customers(load(spark, folder, "customer_documents"))
    return documents.customer_summary(documents.order_lines(order_documents(spark, folder)), customers)

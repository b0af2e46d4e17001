"""Gold aggregates."""

from __future__ import annotations

from pyspark.sql import functions as F

from marlstone.entities import REVENUE_STATUSES
from marlstone.operators import gold
from marlstone.operators.lines import revenue_lines
from marlstone.operators.ranking import with_tile
from marlstone.sources.scratch import written
from marlstone.workload.inputs import AS_OF, load
from marlstone.workload.registry import (
    double,
    exact_sum,
    percent,
    query,
    rounded_mean,
    whole,
    with_inputs,
)

REVENUE = "('" + "', '".join(REVENUE_STATUSES) + "')"


def _orders_items_products(spark, folder):
    return (load(spark, folder, name) for name in ("orders", "order_items", "products"))


@query(
    "revenue_line_items",
    with_inputs(
        f"""SELECT i.order_id, i.product_id, o.customer_id, o.order_date, p.category, p.sub_category,
               p.price, p.cost, {whole('i.quantity')} AS quantity, i.line_total, o.total
            FROM e_order_items i JOIN e_orders o ON o.order_id = i.order_id AND o.status IN {REVENUE}
            JOIN e_products p ON p.product_id = i.product_id""",
        "orders",
        "order_items",
        "products",
    ),
)
def revenue_line_items(spark, folder):
    return revenue_lines(*_orders_items_products(spark, folder)).select(
        "order_id", "product_id", "customer_id", "order_date", "category", "sub_category",
        "price", "cost", "quantity", "line_total", "total",
    )


DAILY_SQL = with_inputs(
    f"""SELECT order_date, category, sub_category, {double('revenue')} AS total_revenue,
          order_count, item_count,
          {rounded_mean('CAST(revenue * 100 AS HUGEINT)', 'order_count')} AS avg_order_value,
          round({double('discounts')} / nullif(discounted, 0), 2) AS avg_discount_pct,
          {double('profit')} AS gross_profit, {percent('profit', 'revenue')} AS margin_pct,
          {percent('revenue', 'sum(revenue) OVER (PARTITION BY order_date)')} AS revenue_share_pct,
          {whole('order_year')} AS order_year, {whole('order_month')} AS order_month
        FROM daily""",
    "orders",
    "order_items",
    "products",
    daily=f"""SELECT order_date, order_year, order_month, category, sub_category,
          round({exact_sum('line_total')}, 2) AS revenue, count(DISTINCT order_id) AS order_count,
          {whole('sum(quantity)')} AS item_count, {exact_sum('discount_pct')} AS discounts,
          count(discount_pct) AS discounted, round({exact_sum('quantity * (price - cost)')}, 2) AS profit
        FROM e_order_items JOIN e_products USING (product_id) JOIN e_orders USING (order_id)
        WHERE status IN {REVENUE} GROUP BY ALL""",
)


@query("daily_revenue_by_category", DAILY_SQL)
def daily_revenue_by_category(spark, folder):
    return gold.daily_revenue_by_category(*_orders_items_products(spark, folder))


ORDER_REVENUE_SQL = f"""SELECT order_id, customer_id, order_date, round({exact_sum('line_total')}, 2) AS revenue
    FROM e_order_items JOIN e_orders USING (order_id) WHERE status IN {REVENUE} GROUP BY ALL"""


@query(
    "order_revenue",
    with_inputs(
        f"SELECT order_id, customer_id, order_date, {double('revenue')} AS order_total FROM per_order",
        "orders",
        "order_items",
        per_order=ORDER_REVENUE_SQL,
    ),
)
def order_revenue(spark, folder):
    rows = gold.order_revenue(load(spark, folder, "orders"), load(spark, folder, "order_items"))
    return rows.select(
        "order_id", "customer_id", "order_date", gold.exact.amount(F.col("revenue")).alias("order_total")
    )


_GAP = "date_diff('day', first_order_date, last_order_date)"
STATS_SQL = f"""SELECT customer_id, order_count, {double('revenue')} AS total_revenue,
      {rounded_mean('CAST(revenue * 100 AS HUGEINT)', 'order_count')} AS avg_order_value,
      first_order_date, last_order_date,
      date_diff('day', last_order_date, DATE '{AS_OF}') AS days_since_last_order,
      CASE WHEN order_count > 1 THEN {rounded_mean(f'10 * {_GAP}', '(order_count - 1)', 10)} END
        AS avg_days_between_orders
    FROM (SELECT customer_id, count(*) AS order_count, sum(revenue) AS revenue,
            min(order_date) AS first_order_date, max(order_date) AS last_order_date
          FROM per_order GROUP BY customer_id)"""


@query(
    "customer_stats",
    with_inputs("SELECT * FROM stats", "orders", "order_items", per_order=ORDER_REVENUE_SQL, stats=STATS_SQL),
)
def customer_stats(spark, folder):
    return gold.customer_stats(load(spark, folder, "orders"), load(spark, folder, "order_items"), AS_OF)


LIFETIME_SQL = with_inputs(
    f"""SELECT customer_id, first_name, last_name, email, city, state, income_bracket, registration_date,
          date_diff('day', registration_date, DATE '{AS_OF}') AS days_since_registration,
          coalesce(order_count, 0) AS order_count, coalesce(total_revenue, 0) AS total_revenue,
          coalesce(avg_order_value, 0) AS avg_order_value, first_order_date, last_order_date,
          days_since_last_order, avg_days_between_orders,
          CASE ntile(3) OVER (ORDER BY coalesce(total_revenue, 0), customer_id)
            WHEN 3 THEN 'high' WHEN 2 THEN 'medium' ELSE 'low' END AS clv_segment,
          is_churned
        FROM e_customers LEFT JOIN stats USING (customer_id) WHERE is_current""",
    "orders",
    "order_items",
    "customers",
    per_order=ORDER_REVENUE_SQL,
    stats=STATS_SQL,
)


@query("customer_lifetime_value", LIFETIME_SQL)
def customer_lifetime_value(spark, folder):
    orders, items, customers = (load(spark, folder, n) for n in ("orders", "order_items", "customers"))
    df = gold.customer_lifetime_value(orders, items, customers, AS_OF)
    return df.orderBy(F.desc("total_revenue"), "customer_id")


@query(
    "ntile_distributed",
    with_inputs(
        "SELECT order_id, total, ntile(7) OVER (ORDER BY total, order_id) AS tile FROM e_orders", "orders"
    ),
)
def ntile_distributed(spark, folder):
    orders = load(spark, folder, "orders").select("order_id", "total")
    return with_tile(written(orders, "orders"), 7, ["total", "order_id"], "tile")


FUNNEL_BODY = f"""SELECT {whole('order_year')} AS order_year, {whole('order_month')} AS order_month, status,
      CASE WHEN status IN ('completed', 'delivered') THEN 'converted'
           WHEN status = 'shipped' THEN 'in_transit' WHEN status = 'pending' THEN 'pending'
           WHEN status IN ('cancelled', 'refunded') THEN 'lost'
           WHEN status = 'returned' THEN 'returned' ELSE 'other' END AS funnel_stage,
      order_count, {double('revenue')} AS total_revenue,
      {percent('order_count', 'all_orders')} AS pct_of_monthly_orders,
      all_orders AS monthly_total_orders, converted AS monthly_converted_orders,
      {percent('converted', 'all_orders')} AS monthly_conversion_rate_pct
    FROM by_status JOIN by_month USING (order_year, order_month)"""
FUNNEL_PARTS = dict(
    by_status=f"""SELECT order_year, order_month, status, count(order_id) AS order_count,
          round({exact_sum('total')}, 2) AS revenue FROM e_orders GROUP BY ALL""",
    by_month=f"""SELECT order_year, order_month, count(order_id) AS all_orders,
          count(*) FILTER (WHERE status IN {REVENUE}) AS converted FROM e_orders GROUP BY ALL""",
)
FUNNEL_SQL = with_inputs(FUNNEL_BODY, "orders", **FUNNEL_PARTS)


@query("conversion_funnel", FUNNEL_SQL)
def conversion_funnel(spark, folder):
    df = gold.conversion_funnel(load(spark, folder, "orders"))
    return df.orderBy("order_year", "order_month", "status")


COHORT_SQL = with_inputs(
    f"""SELECT CAST(cohort AS DATE) AS cohort_month, cohort_size, period_number, retained_customers,
          {percent('retained_customers', 'cohort_size')} AS retention_rate_pct,
          year(cohort) AS cohort_year, month(cohort) AS cohort_month_num
        FROM active JOIN sizes USING (cohort)""",
    "orders",
    bought=f"SELECT customer_id, date_trunc('month', order_date) AS m FROM e_orders WHERE status IN {REVENUE}",
    firsts="SELECT customer_id, min(m) AS cohort FROM bought GROUP BY customer_id",
    sizes="SELECT cohort, count(*) AS cohort_size FROM firsts GROUP BY cohort",
    active="""SELECT cohort, date_diff('month', cohort, m) AS period_number,
          count(DISTINCT customer_id) AS retained_customers
        FROM bought JOIN firsts USING (customer_id) GROUP BY ALL""",
)


@query("cohort_retention", COHORT_SQL)
def cohort_retention(spark, folder):
    return gold.cohort_retention(load(spark, folder, "orders")).orderBy("cohort_month", "period_number")

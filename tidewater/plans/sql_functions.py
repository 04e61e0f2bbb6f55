"""The callable functions as Spark SQL functions over the warehouse views.

``SELECT fn_customer_lifetime_value(42)`` runs as it does in the reference; a
function may also be applied to a column, which Spark turns into one grouped
join, never a call per row.  Parameters with a range (dates, days) are compared
outside the correlated part: the subquery gives a key's sums per day, a list
that the calendar bounds, and equality on the key is its only correlation.
Quotients are rounded half away from zero with exact integers, as everywhere.

The functions are temporary and bind to the views of the same session, so
:func:`register_functions` registers those first.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from tidewater import config as C
from tidewater.plans.pipeline import Warehouse
from tidewater.plans.views import register_views

#: Buckets of the first of two rankings, so that no task ranks all customers.
BUCKETS = 200


def ratio(num: str, den: str, scale: int = 2, factor: int = 1) -> str:
    """round(factor * num / den, scale) as a double, half away from zero."""
    m = 10 ** scale * factor
    wide = f"CAST(abs({num}) AS DECIMAL(28,0)) * {2 * m} + CAST({den} AS DECIMAL(19,0))"
    return (f"CASE WHEN {den} > 0 THEN CAST(sign({num}) AS DOUBLE) * "
            f"CAST(({wide}) div (CAST({den} AS DECIMAL(19,0)) * 2) AS DOUBLE) / {float(10 ** scale)} END")


def _days(dim: str, key: str, natural: str, param: str) -> str:
    """A key's sums and counts per day: at most one entry per calendar day."""
    return (f"(SELECT collect_list(struct(f.d AS d, f.q AS q, f.n AS n)) FROM "
            f"(SELECT {key}, transaction_date AS d, sum(quantity) AS q, count(quantity) AS n "
            f"FROM dwh_fact_sales GROUP BY {key}, transaction_date) f JOIN {dim} k ON f.{key} = k.{key} "
            f"WHERE k.{natural} = {param} AND k.is_current)")


def _between(column: str) -> str:
    return (f"(p_start_date IS NULL OR {column} >= p_start_date) "
            f"AND (p_end_date IS NULL OR {column} <= p_end_date)")


#: What the subqueries' lists and maps are handed to.
HELPERS = {
    "ratio_of_days":
        "(days ARRAY<STRUCT<d: DATE, q: BIGINT, n: BIGINT>>, p_from DATE, p_to DATE, p_den BIGINT) RETURNS DOUBLE "
        "RETURN coalesce(aggregate(filter(days, x -> (p_from IS NULL OR x.d >= p_from) AND (p_to IS NULL OR x.d <= p_to)), "
        "named_struct('q', 0L, 'n', 0L), (a, x) -> named_struct('q', a.q + x.q, 'n', a.n + x.n), "
        f"a -> {ratio('a.q', 'coalesce(p_den, a.n)')}), 0.0D)",
    "performance_json":
        "(name STRING, p_from DATE, p_to DATE, t STRUCT<q: BIGINT, n: BIGINT, c: BIGINT, p: BIGINT, first: DATE, "
        "last: DATE>) RETURNS STRING RETURN to_json(named_struct('product_group', name, "
        "'total_quantity', coalesce(t.q, 0L), 'total_transactions', coalesce(t.n, 0L), "
        "'unique_customers', coalesce(t.c, 0L), 'unique_products', coalesce(t.p, 0L), "
        f"'avg_quantity_per_transaction', coalesce({ratio('t.q', 't.n')}, 0.0D), "
        "'start_date', coalesce(p_from, t.first), 'end_date', coalesce(p_to, t.last)), "
        "map('ignoreNullFields', 'false'))",
    "growth_of":
        "(now BIGINT, before BIGINT) RETURNS DOUBLE "
        f"RETURN {ratio('(coalesce(now, 0L) - coalesce(before, 0L))', 'coalesce(before, 0L)', 2, 100)}",
}


def definitions() -> dict[str, str]:
    """Function name -> its parameters, result and body."""
    customer = _days("dwh_dim_customers", "customer_key", "customer_id", "p_customer_id")
    product = _days("dwh_dim_products", "product_key", "product_id", "p_product_id")
    a_customer = ("FROM dwh_fact_sales s JOIN dwh_dim_customers c ON s.customer_key = c.customer_key "
                  "WHERE c.customer_id = p_customer_id AND c.is_current")
    months = ("(SELECT map_from_entries(collect_list(struct(m, q))) FROM (SELECT trunc(transaction_date, 'MM') AS m, "
              "sum(quantity) AS q FROM dwh_fact_sales GROUP BY 1))")
    month = "make_date(p_year, p_month, 1)"
    before = f"add_months({month}, -1)"
    dates = "p_start_date DATE DEFAULT NULL, p_end_date DATE DEFAULT NULL"
    group = ("FROM dwh_fact_sales s JOIN dwh_dim_products p ON s.product_key = p.product_key "
             f"WHERE p.is_current AND p.product_group = p_product_group AND {_between('s.transaction_date')}")
    return {
        "fn_avg_quantity_per_customer":
            f"(p_customer_id BIGINT, {dates}) RETURNS DOUBLE "
            f"RETURN ratio_of_days({customer}, p_start_date, p_end_date, NULL)",
        "fn_product_sales_velocity":
            f"(p_product_id BIGINT, p_days INT DEFAULT {C.VELOCITY_DAYS}, p_as_of DATE DEFAULT NULL) RETURNS DOUBLE "
            f"RETURN ratio_of_days({product}, date_sub(coalesce(p_as_of, current_date()), p_days), NULL, p_days)",
        "fn_customer_lifetime_value":
            f"(p_customer_id BIGINT) RETURNS BIGINT RETURN (SELECT coalesce(sum(s.quantity), 0) {a_customer})",
        "fn_customer_recency":
            "(p_customer_id BIGINT, p_as_of DATE DEFAULT NULL) RETURNS INT RETURN "
            f"datediff(coalesce(p_as_of, current_date()), (SELECT max(s.transaction_date) {a_customer}))",
        "fn_month_over_month_growth":
            "(p_year INT, p_month INT) RETURNS DOUBLE RETURN "
            f"growth_of(try_element_at({months}, {month}), try_element_at({months}, {before}))",
        "fn_product_group_performance":
            f"(p_product_group STRING, {dates}) RETURNS STRING RETURN performance_json("
            "p_product_group, p_start_date, p_end_date, (SELECT struct(sum(s.quantity) AS q, count(1) AS n, "
            "count(DISTINCT s.customer_key) AS c, count(DISTINCT s.product_key) AS p, "
            f"min(s.transaction_date) AS first, max(s.transaction_date) AS last) {group}))",
        "fn_top_customers":
            f"(p_limit INT DEFAULT {C.TOP_N}, {dates}) RETURNS TABLE (customer_id BIGINT, customer_name STRING, "
            "country STRING, total_quantity BIGINT, total_transactions BIGINT, avg_quantity_per_transaction DOUBLE) "
            "RETURN SELECT customer_id, customer_name, country, q, n, " + ratio("q", "n") + " FROM ("
            "SELECT *, row_number() OVER (ORDER BY q DESC, customer_id) AS place FROM ("
            f"SELECT *, row_number() OVER (PARTITION BY pmod(xxhash64(customer_id), {BUCKETS}) "
            "ORDER BY q DESC, customer_id) AS in_bucket FROM ("
            "SELECT c.customer_id, c.customer_name, c.country, sum(f.q) AS q, sum(f.n) AS n FROM ("
            "SELECT customer_key, sum(quantity) AS q, count(1) AS n FROM dwh_fact_sales "
            f"WHERE {_between('transaction_date')} GROUP BY customer_key) f "
            "JOIN dwh_dim_customers c ON f.customer_key = c.customer_key WHERE c.is_current "
            "GROUP BY c.customer_id, c.customer_name, c.country)) WHERE in_bucket <= p_limit) WHERE place <= p_limit",
    }


def register_functions(wh: Warehouse) -> list[str]:
    """Create the views and the functions in the warehouse's session."""
    register_views(wh)
    spark: SparkSession = wh.spark
    for name, body in {**HELPERS, **definitions()}.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}{body}")
    return list(definitions())

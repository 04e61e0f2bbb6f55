"""Independent SQL (DuckDB dialect) for every registered query.

The warehouse is rebuilt here from the raw tables with plain SQL: latest row
per key by ``row_number()``, surrogate keys by ``row_number() OVER (ORDER BY
natural key)``, SCD2 by a full join.  Rounded values use exact integer
arithmetic, ``(2*m*num + den) // (2*den) / 10^s``, which is what the Spark
side computes as well.  Spark results are compared with these on the same
Parquet tables.
"""

from __future__ import annotations

from tidewater import config as C


def _ts(v: str) -> str:
    return f"TIMESTAMP '{v}'"


def _d(v) -> str:
    return f"DATE '{v}'"


def rnd(num: str, den: str, scale: int = 2, factor: int = 1) -> str:
    """round(factor*num/den, scale) half up for num >= 0; NULL unless den > 0."""
    m = 10 ** scale * factor
    return (f"CASE WHEN ({den}) > 0 THEN CAST((2 * {m} * CAST({num} AS HUGEINT) + ({den})) "
            f"// (2 * CAST({den} AS HUGEINT)) AS DOUBLE) / {10 ** scale} END")


def rnd_signed(num: str, den: str, scale: int = 2, factor: int = 1) -> str:
    m = 10 ** scale * factor
    mag = f"((2 * {m} * abs(CAST({num} AS HUGEINT)) + ({den})) // (2 * CAST({den} AS HUGEINT)))"
    return (f"CASE WHEN ({den}) > 0 THEN CAST(CASE WHEN ({num}) < 0 THEN -{mag} ELSE {mag} END "
            f"AS DOUBLE) / {10 ** scale} END")


R1_TS, R2_TS = _ts(C.RUN1_TS), _ts(C.RUN2_TS)
R1_DAY, R2_DAY = _d(C.RUN1_DAY), _d(C.RUN2_DAY)
OPEN = _d(C.OPEN_END)


def _calendar_cols(d: str) -> str:
    return (f"CAST(strftime({d}, '%Y%m%d') AS INTEGER) AS date_key, {d} AS date, "
            f"CAST(year({d}) AS INTEGER) AS year, CAST(quarter({d}) AS INTEGER) AS quarter, "
            f"CAST(month({d}) AS INTEGER) AS month, rpad(monthname({d}), 9, ' ') AS month_name, "
            f"CAST(week({d}) AS INTEGER) AS week, CAST(day({d}) AS INTEGER) AS day_of_month, "
            f"CAST(dayofweek({d}) AS INTEGER) AS day_of_week, "
            f"rpad(dayname({d}), 9, ' ') AS day_name, dayofweek({d}) IN (0, 6) AS is_weekend, "
            f"FALSE AS is_holiday")


def _series(start, end) -> str:
    return (f"SELECT CAST(unnest(generate_series({_d(start)}, {_d(end)}, INTERVAL 1 DAY)) "
            f"AS DATE) AS d")


def _window(day):
    """The calendar window of a run, by SQL interval arithmetic."""
    import duckdb
    back, ahead = C.CALENDAR_YEARS_BACK, C.CALENDAR_YEARS_AHEAD
    return duckdb.connect().execute(f"SELECT CAST({_d(day)} - INTERVAL {back} YEAR AS DATE), "
                                    f"CAST({_d(day)} + INTERVAL {ahead} YEAR AS DATE)").fetchone()


SALES_LATEST = "ORDER BY transaction_date DESC, product_id DESC, qty DESC, customer_id DESC"


def base_ctes() -> str:
    w1, w2 = _window(C.RUN1_DAY), _window(C.RUN2_DAY)
    return f"""
first_order AS (SELECT o_custkey, min(o_orderdate) AS first_order FROM orders GROUP BY o_custkey),
src_c1 AS (
  SELECT c.c_custkey AS id, c.c_name AS name, n.n_name AS country,
         COALESCE(f.first_order, {_ts(C.DEFAULT_CREATED)}) AS created_at
  FROM customer c LEFT JOIN nation n ON n.n_nationkey = c.c_nationkey
  LEFT JOIN first_order f ON f.o_custkey = c.c_custkey
  WHERE c.c_custkey % {C.NEW_CUSTOMER_MOD} <> 0),
src_c2 AS (
  SELECT c.c_custkey AS id, c.c_name AS name, n.n_name AS country,
         COALESCE(f.first_order, {_ts(C.DEFAULT_CREATED)}) AS created_at
  FROM customer c
  LEFT JOIN nation n ON n.n_nationkey = CASE WHEN c.c_custkey % {C.MOVED_CUSTOMER_MOD} = 0
       THEN (c.c_nationkey + 1) % {C.NATION_COUNT} ELSE c.c_nationkey END
  LEFT JOIN first_order f ON f.o_custkey = c.c_custkey),
src_p1 AS (
  SELECT p_partkey AS id, p_name AS name, p_type AS group_name,
         {_ts(C.DEFAULT_CREATED)} AS created_at
  FROM part WHERE p_partkey % {C.NEW_PRODUCT_MOD} <> 0),
src_p2 AS (
  SELECT p_partkey AS id,
         CASE WHEN p_partkey % {C.RENAMED_PRODUCT_MOD} = 0 THEN p_name || '{C.RENAMED_SUFFIX}'
              ELSE p_name END AS name,
         p_type AS group_name, {_ts(C.DEFAULT_CREATED)} AS created_at
  FROM part),
src_s2 AS (
  SELECT l_orderkey * 10 + l_linenumber AS id, o_custkey AS customer_id,
         l_partkey AS product_id, CAST(l_quantity AS INTEGER) AS qty,
         l_shipdate AS transaction_date, greatest(o_orderdate, l_shipdate) AS created_at
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
src_s1 AS (SELECT * FROM src_s2 WHERE created_at < {_ts(C.RUN1_CUT)}),
-- run 1 ------------------------------------------------------------------
mrr_s1 AS (
  SELECT id, customer_id, product_id, qty, transaction_date, {R1_TS} AS loaded_at FROM (
    SELECT *, row_number() OVER (PARTITION BY id {SALES_LATEST}) AS rn FROM src_s1) WHERE rn = 1),
mrr_c1 AS (SELECT id, name, country, {R1_TS} AS loaded_at FROM src_c1),
mrr_p1 AS (SELECT id, name, group_name, {R1_TS} AS loaded_at FROM src_p1),
stg_c1 AS (
  SELECT id AS customer_id, COALESCE(trim(name), '') AS customer_name, country,
         COALESCE(upper(trim(country)), '') AS country_normalized,
         {R1_TS} AS valid_from, {R1_TS} AS loaded_at FROM mrr_c1),
stg_p1 AS (
  SELECT id AS product_id, COALESCE(trim(name), '') AS product_name, group_name AS product_group,
         COALESCE(upper(trim(group_name)), '') AS product_group_normalized,
         {R1_TS} AS valid_from, {R1_TS} AS loaded_at FROM mrr_p1),
stg_s1 AS (
  SELECT id AS sale_id, customer_id, product_id, qty AS quantity, transaction_date,
         CAST(year(transaction_date) AS INTEGER) AS transaction_year,
         CAST(month(transaction_date) AS INTEGER) AS transaction_month,
         CAST(day(transaction_date) AS INTEGER) AS transaction_day,
         CAST(quarter(transaction_date) AS INTEGER) AS transaction_quarter,
         CAST(dayofweek(transaction_date) AS INTEGER) AS day_of_week,
         {R1_TS} AS loaded_at FROM mrr_s1),
dim_c1 AS (
  SELECT row_number() OVER (ORDER BY customer_id) AS customer_key, customer_id, customer_name,
         country, CAST(NULL AS VARCHAR) AS region, {R1_DAY} AS valid_from, {OPEN} AS valid_to,
         TRUE AS is_current, {R1_TS} AS loaded_at FROM stg_c1),
dim_p1 AS (
  SELECT row_number() OVER (ORDER BY product_id) AS product_key, product_id, product_name,
         product_group, {R1_DAY} AS valid_from, {OPEN} AS valid_to, TRUE AS is_current,
         {R1_TS} AS loaded_at FROM stg_p1),
cal1 AS (SELECT {_calendar_cols('d')} FROM ({_series(*w1)})),
fact1 AS (
  SELECT row_number() OVER (ORDER BY s.sale_id) AS sale_key, c.customer_key, p.product_key,
         CAST(strftime(s.transaction_date, '%Y%m%d') AS INTEGER) AS date_key,
         s.sale_id AS original_sale_id, s.quantity,
         CAST(s.transaction_date AS DATE) AS transaction_date,
         s.transaction_date AS transaction_timestamp, {R1_TS} AS loaded_at
  FROM stg_s1 s JOIN dim_c1 c ON c.customer_id = s.customer_id AND c.is_current
  JOIN dim_p1 p ON p.product_id = s.product_id AND p.is_current),
hwm1 AS (SELECT max(transaction_timestamp) AS m FROM fact1),
-- run 2 ------------------------------------------------------------------
delta_s2 AS (SELECT * FROM src_s2 WHERE transaction_date > (SELECT m FROM hwm1)),
batch_s2 AS (
  SELECT id, customer_id, product_id, qty, transaction_date, {R2_TS} AS loaded_at FROM (
    SELECT *, row_number() OVER (PARTITION BY id {SALES_LATEST}) AS rn FROM delta_s2) WHERE rn = 1),
mrr_s2 AS (
  SELECT * FROM mrr_s1 WHERE id NOT IN (SELECT id FROM batch_s2)
  UNION ALL SELECT * FROM batch_s2),
mrr_c2 AS (
  SELECT * FROM mrr_c1 WHERE id NOT IN (SELECT id FROM src_c2)
  UNION ALL SELECT id, name, country, {R2_TS} FROM src_c2),
mrr_p2 AS (
  SELECT * FROM mrr_p1 WHERE id NOT IN (SELECT id FROM src_p2)
  UNION ALL SELECT id, name, group_name, {R2_TS} FROM src_p2),
stg_c2 AS (
  SELECT COALESCE(o.customer_id, n.id) AS customer_id,
         CASE WHEN n.id IS NOT NULL THEN COALESCE(trim(n.name), '') ELSE o.customer_name END AS customer_name,
         CASE WHEN n.id IS NOT NULL THEN n.country ELSE o.country END AS country,
         CASE WHEN n.id IS NOT NULL THEN COALESCE(upper(trim(n.country)), '') ELSE o.country_normalized END AS country_normalized,
         CASE WHEN o.customer_id IS NOT NULL THEN o.valid_from ELSE {R2_TS} END AS valid_from,
         CASE WHEN n.id IS NOT NULL THEN {R2_TS} ELSE o.loaded_at END AS loaded_at
  FROM stg_c1 o FULL JOIN mrr_c2 n ON o.customer_id = n.id),
stg_p2 AS (
  SELECT COALESCE(o.product_id, n.id) AS product_id,
         CASE WHEN n.id IS NOT NULL THEN COALESCE(trim(n.name), '') ELSE o.product_name END AS product_name,
         CASE WHEN n.id IS NOT NULL THEN n.group_name ELSE o.product_group END AS product_group,
         CASE WHEN n.id IS NOT NULL THEN COALESCE(upper(trim(n.group_name)), '') ELSE o.product_group_normalized END AS product_group_normalized,
         CASE WHEN o.product_id IS NOT NULL THEN o.valid_from ELSE {R2_TS} END AS valid_from,
         CASE WHEN n.id IS NOT NULL THEN {R2_TS} ELSE o.loaded_at END AS loaded_at
  FROM stg_p1 o FULL JOIN mrr_p2 n ON o.product_id = n.id),
stg_s2_new AS (
  SELECT id AS sale_id, customer_id, product_id, qty AS quantity, transaction_date,
         CAST(year(transaction_date) AS INTEGER) AS transaction_year,
         CAST(month(transaction_date) AS INTEGER) AS transaction_month,
         CAST(day(transaction_date) AS INTEGER) AS transaction_day,
         CAST(quarter(transaction_date) AS INTEGER) AS transaction_quarter,
         CAST(dayofweek(transaction_date) AS INTEGER) AS day_of_week,
         {R2_TS} AS loaded_at FROM mrr_s2),
stg_s2 AS (
  SELECT * FROM stg_s1 WHERE sale_id NOT IN (SELECT sale_id FROM stg_s2_new)
  UNION ALL SELECT * FROM stg_s2_new),
cj AS (
  SELECT c.customer_key, COALESCE(c.customer_id, s.customer_id) AS customer_id,
         c.customer_name AS old_name, c.country AS old_country, c.region, c.valid_from,
         c.loaded_at, s.customer_name AS new_name, s.country AS new_country,
         c.customer_id IS NOT NULL AS in_c, s.customer_id IS NOT NULL AS in_s
  FROM (SELECT * FROM dim_c1 WHERE is_current) c
  FULL JOIN stg_c2 s ON c.customer_id = s.customer_id),
dim_c2 AS (
  SELECT * FROM dim_c1 WHERE NOT is_current
  UNION ALL
  SELECT customer_key, customer_id, old_name, old_country, region, valid_from,
         CASE WHEN in_s AND (old_name IS DISTINCT FROM new_name OR old_country IS DISTINCT FROM new_country)
              THEN {R2_DAY} ELSE {OPEN} END,
         NOT (in_s AND (old_name IS DISTINCT FROM new_name OR old_country IS DISTINCT FROM new_country)),
         loaded_at
  FROM cj WHERE in_c
  UNION ALL
  SELECT (SELECT max(customer_key) FROM dim_c1) + row_number() OVER (ORDER BY customer_id),
         customer_id, new_name, new_country, CAST(NULL AS VARCHAR), {R2_DAY}, {OPEN}, TRUE, {R2_TS}
  FROM cj WHERE in_s AND (NOT in_c OR old_name IS DISTINCT FROM new_name
                          OR old_country IS DISTINCT FROM new_country)),
pj AS (
  SELECT p.product_key, COALESCE(p.product_id, s.product_id) AS product_id,
         p.product_name AS old_name, p.product_group AS old_group, p.valid_from, p.loaded_at,
         s.product_name AS new_name, s.product_group AS new_group,
         p.product_id IS NOT NULL AS in_c, s.product_id IS NOT NULL AS in_s
  FROM (SELECT * FROM dim_p1 WHERE is_current) p
  FULL JOIN stg_p2 s ON p.product_id = s.product_id),
dim_p2 AS (
  SELECT * FROM dim_p1 WHERE NOT is_current
  UNION ALL
  SELECT product_key, product_id, old_name, old_group, valid_from,
         CASE WHEN in_s AND (old_name IS DISTINCT FROM new_name OR old_group IS DISTINCT FROM new_group)
              THEN {R2_DAY} ELSE {OPEN} END,
         NOT (in_s AND (old_name IS DISTINCT FROM new_name OR old_group IS DISTINCT FROM new_group)),
         loaded_at
  FROM pj WHERE in_c
  UNION ALL
  SELECT (SELECT max(product_key) FROM dim_p1) + row_number() OVER (ORDER BY product_id),
         product_id, new_name, new_group, {R2_DAY}, {OPEN}, TRUE, {R2_TS}
  FROM pj WHERE in_s AND (NOT in_c OR old_name IS DISTINCT FROM new_name
                          OR old_group IS DISTINCT FROM new_group)),
cal2 AS (
  SELECT * FROM cal1 UNION ALL
  SELECT {_calendar_cols('d')} FROM ({_series(*w2)})
  WHERE CAST(strftime(d, '%Y%m%d') AS INTEGER) NOT IN (SELECT date_key FROM cal1)),
lookup2 AS (
  SELECT s.sale_id AS original_sale_id, c.customer_key, p.product_key,
         CAST(strftime(s.transaction_date, '%Y%m%d') AS INTEGER) AS date_key, s.quantity,
         CAST(s.transaction_date AS DATE) AS transaction_date,
         s.transaction_date AS transaction_timestamp
  FROM stg_s2 s JOIN dim_c2 c ON c.customer_id = s.customer_id AND c.is_current
  JOIN dim_p2 p ON p.product_id = s.product_id AND p.is_current),
fact2 AS (
  SELECT f.sale_key, f.customer_key, f.product_key, f.date_key, f.original_sale_id,
         CASE WHEN l.original_sale_id IS NOT NULL THEN l.quantity ELSE f.quantity END AS quantity,
         f.transaction_date, f.transaction_timestamp,
         CASE WHEN l.original_sale_id IS NOT NULL THEN {R2_TS} ELSE f.loaded_at END AS loaded_at
  FROM fact1 f LEFT JOIN lookup2 l ON l.original_sale_id = f.original_sale_id
  UNION ALL
  SELECT (SELECT max(sale_key) FROM fact1) + row_number() OVER (ORDER BY l.original_sale_id),
         l.customer_key, l.product_key, l.date_key, l.original_sale_id, l.quantity,
         l.transaction_date, l.transaction_timestamp, {R2_TS}
  FROM lookup2 l WHERE l.original_sale_id NOT IN (SELECT original_sale_id FROM fact1)),
hwm2 AS (SELECT max(transaction_timestamp) AS m FROM fact2),
marks2 AS (
  SELECT 'sales' AS table_name, (SELECT m FROM hwm2) AS last_updated, {R2_TS} AS updated_at
  UNION ALL SELECT 'customers', {_ts(C.EPOCH_MARK)}, {_ts(C.EPOCH_MARK)}
  UNION ALL SELECT 'products', {_ts(C.EPOCH_MARK)}, {_ts(C.EPOCH_MARK)}),
run_log AS (
  SELECT event_id AS log_id, '{C.RUN_LOG_PREFIX}' || CAST(user_id % {C.RUN_LOG_JOBS} AS VARCHAR) AS process_name,
         ts AS start_time,
         CASE WHEN event_id % {C.RUNNING_EVERY} = 0 THEN NULL
              ELSE ts + to_microseconds(CAST(round(value * 1000000) AS BIGINT)) END AS end_time,
         CASE WHEN event_id % {C.RUNNING_EVERY} = 0 THEN 'RUNNING'
              WHEN event_type = 'error' THEN 'FAILED'
              WHEN event_type = 'signup' THEN 'WARNING' ELSE 'SUCCESS' END AS status,
         CAST(json_extract_string(props, '$.k') AS INTEGER) AS rows_processed,
         CASE WHEN event_id % {C.RUNNING_EVERY} = 0 THEN NULL
              ELSE CAST(round(value * 1000000) AS BIGINT) END AS duration_us,
         CASE WHEN event_id % {C.RUNNING_EVERY} <> 0 AND event_type = 'error'
              THEN 'error in ' || '{C.RUN_LOG_PREFIX}' || CAST(user_id % {C.RUN_LOG_JOBS} AS VARCHAR) END AS error_message,
         ts AS created_at
  FROM events)
"""


def _with(body: str) -> str:
    body = body.strip()
    if body[:5].upper() == "WITH ":  # merge the body's own CTEs into the list
        return f"WITH {base_ctes()},\n{body[5:]}"
    return f"WITH {base_ctes()}\n{body}"


def _cur_c() -> str:
    return "(SELECT * FROM dim_c2 WHERE is_current)"


def _cur_p() -> str:
    return "(SELECT * FROM dim_p2 WHERE is_current)"


def queries_sql() -> dict[str, str]:
    rs, re_ = _d(C.REPORT_START), _d(C.REPORT_END)
    since = _d(C.AS_OF_DAY - __import__("datetime").timedelta(days=C.VELOCITY_DAYS))
    q: dict[str, str] = {}
    q["sales_report"] = f"""
SELECT c.customer_name, c.country, p.product_group,
       CAST(date_trunc('month', f.transaction_date) AS DATE) AS sales_month,
       CAST(sum(f.quantity) AS BIGINT) AS total_quantity,
       CAST(count(DISTINCT f.sale_key) AS BIGINT) AS transaction_count,
       CAST(count(DISTINCT f.product_key) AS BIGINT) AS unique_products,
       {rnd('sum(f.quantity)', 'count(DISTINCT f.sale_key)')} AS avg_quantity_per_transaction
FROM fact2 f JOIN {_cur_c()} c ON f.customer_key = c.customer_key
JOIN {_cur_p()} p ON f.product_key = p.product_key
WHERE f.transaction_date BETWEEN {rs} AND {re_}
GROUP BY 1, 2, 3, 4 ORDER BY sales_month, customer_name, product_group"""
    q["delta_customers"] = "SELECT id, name, country, created_at FROM src_c2 WHERE created_at > TIMESTAMP '1900-01-01'"
    q["delta_products"] = "SELECT id, name, group_name, created_at FROM src_p2 WHERE created_at > TIMESTAMP '1900-01-01'"
    q["delta_sales"] = "SELECT id, customer_id, product_id, qty, transaction_date FROM delta_s2"
    q["mrr_upsert_sales"] = "SELECT * FROM mrr_s2"
    q["mrr_upsert_customers"] = "SELECT * FROM mrr_c2"
    q["mrr_upsert_products"] = "SELECT * FROM mrr_p2"
    q["upsert_partial"] = """
SELECT f1.sale_key, f2.original_sale_id, f2.customer_key, f2.transaction_date,
       CAST(s.transaction_date AS DATE) AS staged_transaction_date,
       f1.quantity AS quantity_before, f2.quantity AS quantity_after
FROM fact1 f1 JOIN fact2 f2 ON f1.sale_key = f2.sale_key
JOIN stg_s2 s ON s.sale_id = f2.original_sale_id
WHERE s.transaction_date <> f2.transaction_timestamp OR f1.quantity <> f2.quantity"""
    q["upsert_do_nothing"] = """
SELECT id, customer_id, product_id, qty, transaction_date FROM mrr_s1
UNION ALL
SELECT id, customer_id, product_id, qty, transaction_date FROM batch_s2
WHERE id NOT IN (SELECT id FROM mrr_s1)"""
    q["high_water_mark"] = "SELECT * FROM marks2"
    q["late_rows"] = """
SELECT * FROM src_s2 WHERE transaction_date <= (SELECT m FROM hwm1)
AND id NOT IN (SELECT id FROM mrr_s2)"""
    q["stg_customers"] = "SELECT * FROM stg_c2"
    q["stg_products"] = "SELECT * FROM stg_p2"
    q["stg_sales"] = "SELECT * FROM stg_s2"
    q["dim_date"] = f"""
SELECT * FROM cal2 UNION ALL
SELECT {_calendar_cols('d')} FROM (
  SELECT CAST(unnest(generate_series((SELECT min(transaction_date) FROM fact2),
                                     (SELECT max(transaction_date) FROM fact2),
                                     INTERVAL 1 DAY)) AS DATE) AS d)
WHERE CAST(strftime(d, '%Y%m%d') AS INTEGER) NOT IN (SELECT date_key FROM cal2)"""
    q["scd2_customers"] = "SELECT * FROM dim_c2"
    q["scd2_products"] = "SELECT * FROM dim_p2"
    q["fact_sales"] = "SELECT * FROM fact2"
    skipped = []
    for run in (1, 2):
        skipped.append(f"""
SELECT {run} AS run, s.sale_id, s.customer_id, s.product_id,
       CASE WHEN c.customer_id IS NULL AND p.product_id IS NULL THEN 'missing customer and product'
            WHEN c.customer_id IS NULL THEN 'missing customer' ELSE 'missing product' END AS reason
FROM stg_s{run} s
LEFT JOIN (SELECT customer_id FROM dim_c{run} WHERE is_current) c ON c.customer_id = s.customer_id
LEFT JOIN (SELECT product_id FROM dim_p{run} WHERE is_current) p ON p.product_id = s.product_id
WHERE c.customer_id IS NULL OR p.product_id IS NULL""")
    q["fact_skipped"] = "\nUNION ALL\n".join(skipped)
    q["customer_metrics"] = f"""
SELECT c.customer_key, c.customer_id, c.customer_name, c.country,
       CAST(count(DISTINCT f.sale_key) AS BIGINT) AS total_transactions,
       CAST(sum(f.quantity) AS BIGINT) AS total_quantity_purchased,
       CAST(count(DISTINCT f.product_key) AS BIGINT) AS unique_products_purchased,
       min(f.transaction_date) AS first_purchase_date,
       max(f.transaction_date) AS last_purchase_date,
       {rnd('sum(f.quantity)', 'count(f.quantity)')} AS avg_quantity_per_transaction
FROM {_cur_c()} c LEFT JOIN fact2 f ON c.customer_key = f.customer_key
GROUP BY c.customer_key, c.customer_id, c.customer_name, c.country"""
    q["top_customer_metrics"] = q["customer_metrics"] + \
        "\nORDER BY total_transactions DESC, c.customer_id ASC LIMIT 10"
    q["avg_quantity"] = f"""
SELECT c.customer_id, COALESCE({rnd('sum(f.quantity)', 'count(f.quantity)')}, 0.0) AS avg_quantity
FROM {_cur_c()} c LEFT JOIN (SELECT * FROM fact2 WHERE transaction_date >= {rs}
                             AND transaction_date <= {re_}) f ON f.customer_key = c.customer_key
GROUP BY c.customer_id"""
    q["velocity"] = f"""
SELECT p.product_id, COALESCE({rnd('sum(f.quantity)', str(C.VELOCITY_DAYS))}, 0.0) AS velocity
FROM {_cur_p()} p LEFT JOIN (SELECT * FROM fact2 WHERE transaction_date >= {since}) f
  ON f.product_key = p.product_key
GROUP BY p.product_id"""
    q["lifetime_quantity"] = f"""
SELECT c.customer_id, CAST(COALESCE(sum(f.quantity), 0) AS BIGINT) AS lifetime_quantity
FROM {_cur_c()} c LEFT JOIN fact2 f ON f.customer_key = c.customer_key GROUP BY c.customer_id"""
    q["recency"] = f"""
SELECT c.customer_id, CAST({_d(C.AS_OF_DAY)} - max(f.transaction_date) AS INTEGER) AS days_since_last_purchase
FROM {_cur_c()} c LEFT JOIN fact2 f ON f.customer_key = c.customer_key GROUP BY c.customer_id"""
    q["group_performance"] = f"""
SELECT g.product_group,
       CAST(COALESCE(sum(f.quantity), 0) AS BIGINT) AS total_quantity,
       CAST(count(DISTINCT f.sale_key) AS BIGINT) AS total_transactions,
       CAST(count(DISTINCT f.customer_key) AS BIGINT) AS unique_customers,
       CAST(count(DISTINCT f.product_key) AS BIGINT) AS unique_products,
       COALESCE({rnd('sum(f.quantity)', 'count(f.quantity)')}, 0.0) AS avg_quantity_per_transaction,
       min(f.transaction_date) AS start_date, max(f.transaction_date) AS end_date
FROM (SELECT DISTINCT product_group FROM {_cur_p()}) g
LEFT JOIN (SELECT f.*, p.product_group FROM fact2 f JOIN {_cur_p()} p
           ON f.product_key = p.product_key) f ON f.product_group = g.product_group
GROUP BY g.product_group"""
    q["mom_growth"] = f"""
WITH monthly AS (
  SELECT CAST(date_trunc('month', transaction_date) AS DATE) AS m, sum(quantity) AS q
  FROM fact2 GROUP BY 1),
months AS (
  SELECT CAST(unnest(generate_series((SELECT min(m) FROM monthly), (SELECT max(m) FROM monthly),
                                     INTERVAL 1 MONTH)) AS DATE) AS m),
j AS (
  SELECT ms.m, CAST(COALESCE(c.q, 0) AS BIGINT) AS cur, CAST(COALESCE(p.q, 0) AS BIGINT) AS prev
  FROM months ms LEFT JOIN monthly c ON c.m = ms.m
  LEFT JOIN monthly p ON CAST(p.m + INTERVAL 1 MONTH AS DATE) = ms.m)
SELECT CAST(year(m) AS INTEGER) AS year, CAST(month(m) AS INTEGER) AS month,
       cur AS current_quantity, prev AS previous_quantity,
       {rnd_signed('cur - prev', 'prev', 2, 100)} AS growth_pct
FROM j"""
    q["top_customers"] = f"""
SELECT c.customer_id, c.customer_name, c.country,
       CAST(sum(f.quantity) AS BIGINT) AS total_quantity,
       CAST(count(DISTINCT f.sale_key) AS BIGINT) AS total_transactions,
       {rnd('sum(f.quantity)', 'count(f.quantity)')} AS avg_quantity_per_transaction
FROM {_cur_c()} c JOIN fact2 f ON c.customer_key = f.customer_key
GROUP BY c.customer_id, c.customer_name, c.country
ORDER BY total_quantity DESC, customer_id ASC LIMIT {C.TOP_N}"""
    q["monthly_group_sales"] = """
SELECT CAST(year(f.transaction_date) AS INTEGER) AS year,
       CAST(month(f.transaction_date) AS INTEGER) AS month, p.product_group,
       CAST(sum(f.quantity) AS BIGINT) AS total_quantity
FROM fact2 f JOIN dim_p2 p ON f.product_key = p.product_key GROUP BY 1, 2, 3"""
    q["top_groups"] = f"""
SELECT p.group_name, CAST(count(*) AS BIGINT) AS sales_count,
       CAST(sum(s.qty) AS BIGINT) AS total_quantity
FROM src_s2 s JOIN src_p2 p ON s.product_id = p.id
GROUP BY p.group_name ORDER BY sales_count DESC, group_name LIMIT {C.TOP_GROUPS}"""
    q["source_profile"] = """
SELECT (SELECT count(*) FROM src_c2) AS customers, (SELECT count(*) FROM src_p2) AS products,
       (SELECT count(*) FROM src_s2) AS sales,
       (SELECT CAST(min(transaction_date) AS DATE) FROM src_s2) AS earliest,
       (SELECT CAST(max(transaction_date) AS DATE) FROM src_s2) AS latest"""
    q["current_counts"] = """
SELECT (SELECT count(*) FROM fact2) AS fact_rows,
       (SELECT count(*) FROM dim_c2 WHERE is_current) AS current_customers,
       (SELECT count(*) FROM dim_p2 WHERE is_current) AS current_products"""
    q["point_in_time_sales"] = """
WITH versions AS (
  SELECT customer_id, country,
         CASE WHEN valid_from = min(valid_from) OVER (PARTITION BY customer_id)
              THEN DATE '1900-01-01' ELSE valid_from END AS valid_from, valid_to
  FROM dim_c2),
f AS (SELECT c.customer_id, f.transaction_date, f.quantity
      FROM fact2 f JOIN dim_c2 c ON f.customer_key = c.customer_key)
SELECT v.country AS country_at_sale, CAST(year(f.transaction_date) AS INTEGER) AS sales_year,
       CAST(sum(f.quantity) AS BIGINT) AS total_quantity,
       CAST(count(*) AS BIGINT) AS transaction_count
FROM f JOIN versions v ON v.customer_id = f.customer_id
  AND v.valid_from <= f.transaction_date AND f.transaction_date < v.valid_to
GROUP BY 1, 2"""
    q["weekend_quantity"] = """
SELECT d.is_weekend, CAST(sum(f.quantity) AS BIGINT) AS total_quantity,
       CAST(count(*) AS BIGINT) AS transaction_count
FROM fact2 f JOIN cal2 d ON f.date_key = d.date_key GROUP BY d.is_weekend"""
    q["recent_runs"] = f"""
SELECT log_id, process_name, start_time, end_time,
       {rnd('duration_us', '1000000')} AS duration_seconds, status, rows_processed,
       error_message, created_at
FROM run_log ORDER BY start_time DESC, log_id DESC LIMIT {C.RECENT_RUNS}"""
    q["performance_summary"] = f"""
SELECT process_name, CAST(count(*) AS BIGINT) AS total_runs,
       CAST(sum(CASE WHEN status = 'SUCCESS' THEN 1 ELSE 0 END) AS BIGINT) AS successful_runs,
       CAST(sum(CASE WHEN status = 'FAILED' THEN 1 ELSE 0 END) AS BIGINT) AS failed_runs,
       {rnd('sum(duration_us)', 'count(duration_us) * 1000000')} AS avg_duration_seconds,
       {rnd('max(duration_us)', '1000000')} AS max_duration_seconds,
       {rnd('min(duration_us)', '1000000')} AS min_duration_seconds,
       CAST(sum(rows_processed) AS BIGINT) AS total_rows_processed,
       max(start_time) AS last_run_time
FROM run_log WHERE end_time IS NOT NULL GROUP BY process_name ORDER BY last_run_time DESC"""
    q["daily_trend"] = f"""
SELECT process_name, CAST(start_time AS DATE) AS day,
       {rnd('sum(duration_us)', 'count(duration_us) * 1000000', 6)} AS avg_duration,
       CAST(max(duration_us) AS DOUBLE) / 1000000.0 AS max_duration
FROM run_log WHERE status = 'SUCCESS' GROUP BY 1, 2 ORDER BY day DESC, process_name"""
    q["failed_runs"] = """
SELECT log_id, process_name, start_time, end_time, status, error_message, rows_processed
FROM run_log WHERE status = 'FAILED' ORDER BY start_time DESC, log_id DESC"""
    q["runs_like"] = f"""
SELECT log_id, process_name, start_time, status FROM run_log
WHERE process_name LIKE '{C.LIKE_PATTERN}' ORDER BY start_time DESC, log_id DESC"""
    q["freshness"] = f"""
SELECT table_name, last_updated,
       CAST(date_diff('second', last_updated, {_ts(C.AS_OF_TS)}) AS BIGINT) AS age_seconds
FROM marks2 ORDER BY age_seconds DESC, table_name"""
    q["layer_counts"] = """
SELECT 'operational' AS layer, CAST(count(*) AS BIGINT) AS row_count FROM src_s2
UNION ALL SELECT 'mrr', count(*) FROM mrr_s2
UNION ALL SELECT 'stg', count(*) FROM stg_s2
UNION ALL SELECT 'dwh', count(*) FROM fact2"""
    q["rejected_sales"] = """
SELECT id, customer_id, product_id, qty, transaction_date,
       concat_ws(',', CASE WHEN qty IS NULL OR qty <= 0 THEN 'qty_positive' END,
                 CASE WHEN id IS NULL OR customer_id IS NULL OR product_id IS NULL
                      OR transaction_date IS NULL THEN 'keys_not_null' END) AS failed_rules
FROM src_s2 WHERE qty IS NULL OR qty <= 0 OR id IS NULL OR customer_id IS NULL
  OR product_id IS NULL OR transaction_date IS NULL"""
    q["rule_summary"] = """
SELECT table_name, rule, CAST(rows_checked AS BIGINT) AS rows_checked,
       CAST(rows_failed AS BIGINT) AS rows_failed FROM (
SELECT 'sales' AS table_name, 'qty_positive' AS rule, CAST(count(*) AS BIGINT) AS rows_checked,
       CAST(sum(CASE WHEN qty IS NULL OR qty <= 0 THEN 1 ELSE 0 END) AS BIGINT) AS rows_failed FROM src_s2
UNION ALL SELECT 'sales', 'keys_not_null', count(*), sum(CASE WHEN id IS NULL OR customer_id IS NULL
       OR product_id IS NULL OR transaction_date IS NULL THEN 1 ELSE 0 END) FROM src_s2
UNION ALL SELECT 'customers', 'name_not_null', count(*), sum(CASE WHEN name IS NULL THEN 1 ELSE 0 END) FROM src_c2
UNION ALL SELECT 'customers', 'name_max_255', count(*), sum(CASE WHEN length(name) > 255 THEN 1 ELSE 0 END) FROM src_c2
UNION ALL SELECT 'customers', 'country_not_null', count(*), sum(CASE WHEN country IS NULL THEN 1 ELSE 0 END) FROM src_c2
UNION ALL SELECT 'customers', 'country_max_100', count(*), sum(CASE WHEN length(country) > 100 THEN 1 ELSE 0 END) FROM src_c2
UNION ALL SELECT 'products', 'name_not_null', count(*), sum(CASE WHEN name IS NULL THEN 1 ELSE 0 END) FROM src_p2
UNION ALL SELECT 'products', 'name_max_255', count(*), sum(CASE WHEN length(name) > 255 THEN 1 ELSE 0 END) FROM src_p2
UNION ALL SELECT 'products', 'group_not_null', count(*), sum(CASE WHEN group_name IS NULL THEN 1 ELSE 0 END) FROM src_p2
UNION ALL SELECT 'products', 'group_max_100', count(*), sum(CASE WHEN length(group_name) > 100 THEN 1 ELSE 0 END) FROM src_p2
UNION ALL SELECT 'etl_logs', 'status_allowed', count(*), sum(CASE WHEN status IN ('RUNNING', 'SUCCESS', 'FAILED', 'WARNING') THEN 0 ELSE 1 END) FROM run_log)"""
    q["broken_rules"] = """
SELECT table_name, rule, CAST(rows_checked AS BIGINT) AS rows_checked,
       CAST(rows_failed AS BIGINT) AS rows_failed FROM (
SELECT 'documents' AS table_name, 'text_max_255' AS rule, count(*) AS rows_checked,
       count(*) FILTER (length(text) > 255) AS rows_failed FROM documents
UNION ALL SELECT 'events', 'status_allowed', count(*), count(*) FILTER (event_type IS NULL
       OR event_type NOT IN ('RUNNING', 'SUCCESS', 'FAILED', 'WARNING')) FROM events
UNION ALL SELECT 'customer', 'balance_positive', count(*), count(*) FILTER (c_acctbal IS NULL
       OR c_acctbal <= 0) FROM customer
UNION ALL SELECT 'sales', 'parent_name_not_null', count(*), count(*) FILTER (c.name IS NULL)
       FROM src_s2 s LEFT JOIN src_c1 c ON s.customer_id = c.id)"""
    q["monthly_group_sales_table"] = q["monthly_group_sales"]
    # every key that a dimension ever had, and one that nobody has
    ids_c = "(SELECT DISTINCT customer_id FROM dim_c2 UNION ALL SELECT -1) k"
    ids_p = "(SELECT DISTINCT product_id FROM dim_p2 UNION ALL SELECT -1) k"
    of_c = f"""LEFT JOIN {_cur_c()} c ON c.customer_id = k.customer_id
LEFT JOIN fact2 f ON f.customer_key = c.customer_key"""
    q["sql_avg_quantity"] = f"""
SELECT k.customer_id, COALESCE({rnd('sum(f.quantity)', 'count(f.quantity)')}, 0.0) AS avg_quantity
FROM {ids_c} {of_c} AND f.transaction_date BETWEEN {rs} AND {re_} GROUP BY k.customer_id"""
    q["sql_velocity"] = f"""
SELECT k.product_id, COALESCE({rnd('sum(f.quantity)', str(C.VELOCITY_DAYS))}, 0.0) AS velocity
FROM {ids_p} LEFT JOIN {_cur_p()} p ON p.product_id = k.product_id
LEFT JOIN fact2 f ON f.product_key = p.product_key AND f.transaction_date >= {since} GROUP BY k.product_id"""
    q["sql_lifetime_value"] = f"""
SELECT k.customer_id, CAST(COALESCE(sum(f.quantity), 0) AS BIGINT) AS lifetime_quantity
FROM {ids_c} {of_c} GROUP BY k.customer_id"""
    q["sql_recency"] = f"""
SELECT k.customer_id, CAST({_d(C.AS_OF_DAY)} - max(f.transaction_date) AS INTEGER) AS days
FROM {ids_c} {of_c} GROUP BY k.customer_id"""
    q["sql_growth"] = f"""
WITH monthly AS (SELECT CAST(date_trunc('month', transaction_date) AS DATE) AS m, sum(quantity) AS q
                 FROM fact2 GROUP BY 1),
asked AS (SELECT DISTINCT year, month FROM cal2 UNION ALL SELECT 1950, 1),
j AS (SELECT a.year, a.month, CAST(COALESCE(c.q, 0) AS BIGINT) AS cur, CAST(COALESCE(p.q, 0) AS BIGINT) AS prev
      FROM asked a LEFT JOIN monthly c ON c.m = make_date(a.year, a.month, 1)
      LEFT JOIN monthly p ON CAST(p.m + INTERVAL 1 MONTH AS DATE) = make_date(a.year, a.month, 1))
SELECT year, month, {rnd_signed('cur - prev', 'prev', 2, 100)} AS growth_pct FROM j"""
    q["sql_top_customers"] = f"""
SELECT c.customer_id, c.customer_name, c.country, CAST(sum(f.quantity) AS BIGINT) AS total_quantity,
       CAST(count(*) AS BIGINT) AS total_transactions,
       {rnd('sum(f.quantity)', 'count(f.quantity)')} AS avg_quantity_per_transaction
FROM {_cur_c()} c JOIN fact2 f ON c.customer_key = f.customer_key
WHERE f.transaction_date BETWEEN {rs} AND {re_} GROUP BY c.customer_id, c.customer_name, c.country
ORDER BY total_quantity DESC, customer_id ASC LIMIT {C.TOP_N}"""
    from tidewater.plans.queries import FIRST_DAY, MOST_SOLD
    kept = f"qty <= {MOST_SOLD} AND transaction_date >= {_ts(FIRST_DAY)}"
    q["load_rejected"] = f"""
SELECT id, customer_id, product_id, qty, transaction_date,
       concat_ws(',', CASE WHEN qty > {MOST_SOLD} THEN 'qty_at_most' END,
                 CASE WHEN transaction_date < {_ts(FIRST_DAY)} THEN 'not_before_first_day' END) AS failed_rules,
       1 AS run
FROM src_s1 WHERE transaction_date > {_ts(C.EPOCH_MARK)} AND NOT ({kept})"""
    q["load_accepted"] = f"""
SELECT id, customer_id, product_id, qty, transaction_date FROM (
  SELECT *, row_number() OVER (PARTITION BY id {SALES_LATEST}) AS rn FROM src_s1 WHERE {kept}) WHERE rn = 1"""
    q["rejected_documents"] = """
SELECT doc_id, concat_ws(',', CASE WHEN length(text) > 255 THEN 'text_max_255' END,
                         CASE WHEN text IS NULL THEN 'text_not_null' END) AS failed_rules
FROM documents WHERE text IS NULL OR length(text) > 255"""
    steps = [("mrr_to_stg_customers", "mrr_c"), ("mrr_to_stg_products", "mrr_p"),
             ("mrr_to_stg_sales", "mrr_s"), ("stg_to_dwh_customers", "stg_c"),
             ("stg_to_dwh_products", "stg_p"), ("stg_to_dwh_sales", "stg_s")]
    q["etl_run_log"] = " UNION ALL ".join(
        [f"SELECT '{step}' AS process_name, CAST({run} AS BIGINT) AS run, 'SUCCESS' AS status, "
         f"CAST(count(*) AS BIGINT) AS rows_processed FROM {table}{run}"
         for step, table in steps for run in (1, 2)]
        + ["SELECT 'stg_to_dwh_date_dimension', 1, 'SUCCESS', count(*) FROM cal1",
           "SELECT 'stg_to_dwh_date_dimension', 2, 'SUCCESS', "
           "(SELECT count(*) FROM cal2) - (SELECT count(*) FROM cal1)"])
    q["orphans"] = """
SELECT 'source' AS layer, id AS sale_id, 'missing customer' AS reason FROM src_s2
WHERE customer_id NOT IN (SELECT id FROM src_c1)
UNION ALL SELECT 'source', id, 'missing product' FROM src_s2 WHERE product_id NOT IN (SELECT id FROM src_p1)
UNION ALL SELECT 'warehouse', original_sale_id, 'missing customer' FROM fact2
WHERE customer_key NOT IN (SELECT customer_key FROM dim_c2)
UNION ALL SELECT 'warehouse', original_sale_id, 'missing product' FROM fact2
WHERE product_key NOT IN (SELECT product_key FROM dim_p2)
UNION ALL SELECT 'warehouse', original_sale_id, 'missing date' FROM fact2
WHERE date_key NOT IN (SELECT date_key FROM cal2)"""
    q["duplicate_keys"] = """
SELECT 'sales' AS table_name, CAST(id AS VARCHAR) AS key_value, CAST(count(*) AS BIGINT) AS copies
FROM src_s2 GROUP BY id HAVING count(*) > 1
UNION ALL SELECT 'dwh_fact_sales', CAST(original_sale_id AS VARCHAR), count(*) FROM fact2
GROUP BY original_sale_id HAVING count(*) > 1
UNION ALL SELECT 'dwh_dim_date', CAST(date_key AS VARCHAR), count(*) FROM cal2
GROUP BY date_key HAVING count(*) > 1"""
    q["cascade_delete"] = """
SELECT id, customer_id, product_id, qty, transaction_date FROM src_s2
WHERE customer_id IN (SELECT id FROM src_c1) AND product_id IN (SELECT id FROM src_p1)"""
    q["stream_mirror_sales"] = f"""
SELECT id, customer_id, product_id, qty, transaction_date FROM (
  SELECT *, row_number() OVER (PARTITION BY id ORDER BY created_at >= {_ts(C.RUN1_CUT)} DESC,
         transaction_date DESC, product_id DESC, qty DESC, customer_id DESC) AS rn
  FROM src_s2) WHERE rn = 1"""
    q["customer_metrics_table"] = q["customer_metrics"]
    q["group_performance_json"] = q["group_performance"]
    return {k: _with(v) for k, v in q.items()}

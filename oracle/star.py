"""DuckDB views of the star schema, written apart from the Spark code.

``sql`` puts in front of a query the common table expressions it names.
"""

from __future__ import annotations

import re

AS_OF = "DATE '2000-11-15'"
SUBS_AS_OF = "DATE '2024-01-30'"
SPIKE = "fiscal_year = 2000 AND fiscal_month = 6"
RETENTION = "calendar_date BETWEEN DATE '2024-01-08' AND DATE '2024-01-21'"

VIEWS: dict[str, str] = {
    "weeks": """
        SELECT CAST(i AS INTEGER) AS i, CAST(i // 7 AS INTEGER) AS w FROM range(0, 11293) t(i)
    """,
    "dim_date": """
        SELECT i + 1 AS date_key, CAST(DATE '1994-01-31' + i AS DATE) AS calendar_date,
               CAST(1994 + w // 52 AS INTEGER) AS fiscal_year,
               CAST(CASE WHEN w % 52 < 4 THEN 1 WHEN w % 52 < 8 THEN 2 WHEN w % 52 < 13 THEN 3
                         WHEN w % 52 < 17 THEN 4 WHEN w % 52 < 21 THEN 5 WHEN w % 52 < 26 THEN 6
                         WHEN w % 52 < 30 THEN 7 WHEN w % 52 < 34 THEN 8 WHEN w % 52 < 39 THEN 9
                         WHEN w % 52 < 43 THEN 10 WHEN w % 52 < 47 THEN 11 ELSE 12 END AS INTEGER) AS fiscal_month,
               CAST((w % 52) // 13 + 1 AS INTEGER) AS fiscal_quarter,
               CAST(weekofyear(DATE '1994-01-31' + i) AS INTEGER) AS iso_week,
               strftime(DATE '1994-01-31' + i, '%Y-%m-%d') AS date_label
        FROM weeks
    """,
    "dim_geo": """
        SELECT n_nationkey AS geo_key, printf('GEO-%04d', n_nationkey) AS geo_code, n_name AS city_name,
               printf('C%02d', n_nationkey) AS country_code, replace(r_name, ' ', '_') AS region_code,
               r_name AS region_name
        FROM nation JOIN region ON n_regionkey = r_regionkey
    """,
    "dim_product": """
        SELECT p_partkey AS product_key, printf('SKU-%06d', p_partkey) AS sku_code, p_name AS product_name,
               p_brand AS product_family,
               CASE WHEN p_type IN ('LARGE', 'PROMO') THEN 'DEVICE'
                    WHEN p_type IN ('SMALL', 'MEDIUM') THEN 'ACCESSORY' ELSE 'SUBSCRIPTION' END AS product_class,
               p_retailprice AS list_price
        FROM part
    """,
    "dim_campaign": """
        SELECT s_suppkey AS campaign_key, s_name AS campaign_code, 'Campaign ' || s_suppkey AS campaign_name,
               ['AWARENESS', 'CONVERSION', 'RETENTION'][CAST(s_suppkey % 3 AS INTEGER) + 1] AS campaign_objective
        FROM supplier
    """,
    "dim_member": """
        SELECT c_custkey AS member_key, c_name AS member_id, 'member_' || c_custkey AS display_handle,
               c_mktsegment AS member_tier, c_nationkey AS home_geo_key,
               CAST(DATE '1994-01-31' + CAST(c_custkey % 730 AS INTEGER) AS DATE) AS signup_date
        FROM customer
    """,
    "fact_order": """
        SELECT o_orderkey AS order_key, 'ORD-' || o_orderkey AS order_id, o_custkey AS member_key,
               CAST(o_orderkey % 25 AS INTEGER) AS geo_key, o_orderkey % 10 AS campaign_key,
               CAST(datediff('day', DATE '1994-01-31', CAST(o_orderdate AS DATE)) + 1 AS INTEGER) AS order_date_key,
               CAST(datediff('day', DATE '1994-01-31', CAST(o_orderdate AS DATE)) + 1 + o_orderkey % 8 AS INTEGER)
                   AS ship_date_key,
               CAST(datediff('day', DATE '1994-01-31', CAST(o_orderdate AS DATE)) + 1 + o_orderkey % 15 AS INTEGER)
                   AS recognition_date_key,
               CAST(o_totalprice AS DECIMAL(12,2)) AS order_gross_amount,
               CASE o_orderstatus WHEN 'F' THEN 'FULFILLED' WHEN 'P' THEN 'SHIPPED' ELSE 'OPEN' END AS order_status
        FROM orders
    """,
    "line_amounts": """
        SELECT *, CAST(l_extendedprice AS DECIMAL(12,2)) AS gross,
               CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(l_discount AS DECIMAL(4,2)) AS returned,
               CASE WHEN l_returnflag = 'R' THEN 'RETURNED'
                    WHEN l_returnflag = 'A' AND l_linestatus = 'O' THEN 'CANCELLED' ELSE 'FULFILLED' END AS status
        FROM lineitem
    """,
    "bronze_order_line": """
        SELECT l_orderkey * 10 + l_linenumber AS order_line_key, l_orderkey AS order_key, l_partkey AS product_key,
               CAST(l_quantity AS INTEGER) AS qty, returned AS return_amount,
               CAST(datediff('day', DATE '1994-01-31', CAST(l_shipdate AS DATE)) + 1 AS INTEGER) AS ship_date_key,
               gross AS gross_amount,
               CASE WHEN status = 'FULFILLED' THEN gross - returned ELSE 0 END AS net_recognized_amount,
               status AS line_status, o_custkey AS member_key, s_nationkey AS geo_key, l_suppkey AS campaign_key,
               CAST(datediff('day', DATE '1994-01-31', CAST(o_orderdate AS DATE)) + 1 AS INTEGER) AS order_date_key,
               CAST(datediff('day', DATE '1994-01-31', CAST(l_shipdate AS DATE)) + 1 AS INTEGER)
                   AS recognition_date_key
        FROM line_amounts LEFT JOIN orders ON l_orderkey = o_orderkey LEFT JOIN supplier ON l_suppkey = s_suppkey
    """,
    "fact_order_line": """
        SELECT * FROM bronze_order_line QUALIFY row_number() OVER (PARTITION BY order_line_key
        ORDER BY product_key, campaign_key, qty, gross_amount, recognition_date_key, return_amount, line_status) = 1
    """,
    "sales": """
        SELECT * FROM fact_order_line JOIN dim_date ON recognition_date_key = date_key
        WHERE line_status = 'FULFILLED'
    """,
    "event_rows": """
        SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events
    """,
    "bronze_subscription_event": """
        SELECT event_id AS subscription_event_key, user_id AS member_key,
               CASE event_type WHEN 'signup' THEN 'ACTIVATE' WHEN 'purchase' THEN 'RENEW' WHEN 'error' THEN 'CANCEL'
                    ELSE upper(event_type) END AS event_type,
               CAST(datediff('day', DATE '1994-01-31', CAST(ts AS DATE)) + 1 AS INTEGER) AS event_date_key,
               CASE WHEN event_type = 'error' THEN -CAST(value AS DECIMAL(12,2))
                    ELSE CAST(value AS DECIMAL(12,2)) END AS mrr_delta,
               CAST(k % 20 AS BIGINT) AS attribution_campaign_key
        FROM event_rows
    """,
    "fact_subscription_event": """
        SELECT * FROM bronze_subscription_event WHERE event_type IN ('ACTIVATE', 'RENEW', 'CANCEL')
    """,
    "subs": """
        SELECT * FROM fact_subscription_event JOIN dim_date ON event_date_key = date_key
    """,
    "fact_usage_event": """
        SELECT event_id AS usage_event_key, user_id AS member_key, CAST(k AS BIGINT) AS product_key,
               CAST(datediff('day', DATE '1994-01-31', CAST(ts AS DATE)) + 1 AS INTEGER) AS event_date_key,
               CAST(trunc(value) AS INTEGER) AS duration_sec, CAST(trunc(value / 2) AS INTEGER) AS calories,
               ['RIDE', 'RUN', 'STRENGTH', 'YOGA', 'ROW'][k % 5 + 1] AS workout_type
        FROM event_rows WHERE event_type IN ('click', 'view')
    """,
    "anchor": f"""
        SELECT t.fiscal_year AS current_fy, t.fiscal_month AS current_fm, t.fiscal_quarter AS current_fq,
               m.fiscal_year AS last_fm_year, m.fiscal_month AS last_fm_month,
               q.fiscal_year AS last_fq_year, q.fiscal_quarter AS last_fq
        FROM dim_date t, dim_date m, dim_date q
        WHERE t.calendar_date = {AS_OF} AND m.calendar_date = {AS_OF} - INTERVAL 1 MONTH
          AND q.calendar_date = {AS_OF} - INTERVAL 3 MONTH
    """,
    "subs_anchor": f"""
        SELECT t.fiscal_year AS current_fy, t.fiscal_month AS current_fm, t.fiscal_quarter AS current_fq,
               m.fiscal_year AS last_fm_year, m.fiscal_month AS last_fm_month,
               q.fiscal_year AS last_fq_year, q.fiscal_quarter AS last_fq
        FROM dim_date t, dim_date m, dim_date q
        WHERE t.calendar_date = {SUBS_AS_OF} AND m.calendar_date = {SUBS_AS_OF} - INTERVAL 1 MONTH
          AND q.calendar_date = {SUBS_AS_OF} - INTERVAL 3 MONTH
    """,
    "last_events": """
        SELECT member_key, max(CASE WHEN event_type IN ('ACTIVATE', 'RENEW') THEN calendar_date END) AS last_active_dt,
               max(CASE WHEN event_type = 'CANCEL' THEN calendar_date END) AS last_cancel_dt
        FROM subs, subs_anchor WHERE fiscal_year = current_fy GROUP BY member_key
    """,
    "active_flags": f"""
        SELECT *, coalesce(last_active_dt >= {SUBS_AS_OF} - INTERVAL 7 DAY
                  AND (last_cancel_dt IS NULL OR last_cancel_dt < last_active_dt), false) AS is_active
        FROM last_events
    """,
}


def sql(query: str) -> str:
    """``query`` with the views it uses, in the order they depend on."""
    used: dict[str, None] = {}

    def need(text: str) -> None:
        for name in VIEWS:
            if name not in used and re.search(rf"\b{name}\b", text):
                need(VIEWS[name])
                used[name] = None

    own = set(re.findall(r"(?:WITH|\),)\s+(\w+) AS \(", query))
    if own & set(VIEWS):
        raise ValueError(f"query redefines {own & set(VIEWS)}")
    need(query)
    if not used:
        return query.strip()
    views = ",\n".join(f"{name} AS ({VIEWS[name].strip()})" for name in used)
    body = query.strip()
    if body.upper().startswith("WITH "):
        return f"WITH {views},\n{body[5:]}"
    return f"WITH {views}\n{body}"


def money(total: str) -> str:
    return f"CAST(round({total}, 2) AS DOUBLE)"


def ratio(top: str, bottom: str) -> str:
    return f"CAST({top} AS DOUBLE) / nullif(CAST({bottom} AS DOUBLE), 0)"

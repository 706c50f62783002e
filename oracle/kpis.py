"""Oracle SQL of the calendar and KPI queries."""

from oracle.star import RETENTION, money, ratio, sql

NET = "net_recognized_amount"

LAST_FM = "fiscal_year = last_fm_year AND fiscal_month = last_fm_month"
LAST_FQ = "fiscal_year = last_fq_year AND fiscal_quarter = last_fq"

Q01 = f"SELECT {money(f'sum({NET})')} AS total_recognized_revenue FROM sales, anchor WHERE {LAST_FM}"

Q02 = f"""
    SELECT region_name, {money(f'sum({NET})')} AS recognized_revenue
    FROM sales JOIN dim_geo USING (geo_key), anchor WHERE {LAST_FQ} GROUP BY region_name
"""

Q03 = f"""
    SELECT member_id, display_handle, {money(f'sum({NET})')} AS hardware_revenue_fytd
    FROM sales JOIN dim_product USING (product_key) JOIN dim_member USING (member_key), anchor
    WHERE fiscal_year = current_fy AND product_class IN ('DEVICE', 'ACCESSORY')
    GROUP BY member_id, display_handle ORDER BY hardware_revenue_fytd DESC, member_id LIMIT 10
"""

Q04 = f"""
    SELECT r.recognized_revenue_fytd, s.ending_mrr, s.churn_rate_fytd
    FROM (SELECT {money(f'sum({NET})')} AS recognized_revenue_fytd FROM sales, anchor
          WHERE fiscal_year = current_fy) r,
         (SELECT {money('sum(mrr_delta)')} AS ending_mrr,
                 round({ratio("count(DISTINCT CASE WHEN event_type = 'CANCEL' THEN member_key END)",
                              "count(DISTINCT member_key)")}, 4) AS churn_rate_fytd
          FROM subs, subs_anchor WHERE fiscal_year = current_fy) s
"""

Q05 = """
    SELECT count(*) AS active_members FROM active_flags JOIN dim_member USING (member_key)
    JOIN dim_geo ON home_geo_key = geo_key WHERE is_active AND region_code = 'EUROPE'
"""

Q06 = f"""
    SELECT product_family,
           {money(f'sum(CASE WHEN fiscal_quarter = 1 THEN {NET} ELSE 0 END)')} AS q1_revenue,
           {money(f'sum(CASE WHEN fiscal_quarter = 2 THEN {NET} ELSE 0 END)')} AS q2_revenue
    FROM sales JOIN dim_product USING (product_key), anchor
    WHERE fiscal_year = current_fy AND fiscal_quarter IN (1, 2) GROUP BY product_family
"""

SPIKE_GROUPS = f"""
    SELECT product_family, sku_code, campaign_code, campaign_name, fiscal_year, fiscal_month,
           {money(f'sum({NET})')} AS recognized_revenue, count(DISTINCT order_key) AS order_count
    FROM sales JOIN dim_product USING (product_key) JOIN dim_campaign USING (campaign_key)
    WHERE fiscal_month = 6 AND fiscal_year = 2000
    GROUP BY product_family, sku_code, campaign_code, campaign_name, fiscal_year, fiscal_month
"""
Q07 = SPIKE_GROUPS + " ORDER BY recognized_revenue DESC, sku_code, campaign_code LIMIT 20"

CHURN = f"""
    SELECT campaign_code, campaign_name,
           count(DISTINCT CASE WHEN event_type = 'CANCEL' THEN member_key END) AS cancels,
           count(DISTINCT member_key) AS touched_members,
           {ratio("count(DISTINCT CASE WHEN event_type = 'CANCEL' THEN member_key END)",
                  "count(DISTINCT member_key)")} AS churn_rate
    FROM subs JOIN dim_campaign ON attribution_campaign_key = campaign_key WHERE {RETENTION}
    GROUP BY campaign_code, campaign_name
"""
Q08 = CHURN + " ORDER BY churn_rate, campaign_code LIMIT 10"


def sku_revenue(sku: str) -> str:
    return f"""
    SELECT '{sku}' AS sku_code, CAST(round(coalesce(sum({NET}), 0), 2) AS DOUBLE) AS recognized_revenue
    FROM fact_order_line JOIN dim_product USING (product_key)
    WHERE sku_code = '{sku}' AND line_status = 'FULFILLED'
"""


CALENDAR_LOAD = """
    SELECT d.date_key, date_label, d.fiscal_year, d.fiscal_month, d.fiscal_quarter, d.iso_week,
           coalesce(o.n, 0) AS n_orders, coalesce(l.n, 0) AS n_lines, coalesce(e.n, 0) AS n_events
    FROM dim_date d
    LEFT JOIN (SELECT order_date_key AS k, count(*) AS n FROM fact_order GROUP BY 1) o ON o.k = d.date_key
    LEFT JOIN (SELECT recognition_date_key AS k, count(*) AS n FROM fact_order_line GROUP BY 1) l ON l.k = d.date_key
    LEFT JOIN (SELECT event_date_key AS k, count(*) AS n FROM bronze_subscription_event GROUP BY 1) e
           ON e.k = d.date_key
"""

ANCHORS = """
    SELECT strftime(x.as_of, '%Y-%m-%d') AS as_of, n_orders, t.fiscal_year AS current_fy, t.fiscal_month AS current_fm,
           t.fiscal_quarter AS current_fq, m.fiscal_year AS last_fm_year, m.fiscal_month AS last_fm_month,
           m.fiscal_quarter AS last_fm_quarter, q.fiscal_year AS last_fq_year, q.fiscal_quarter AS last_fq
    FROM (SELECT CAST(o_orderdate AS DATE) AS as_of, count(*) AS n_orders FROM orders GROUP BY 1) x
    JOIN dim_date t ON t.calendar_date = x.as_of
    JOIN dim_date m ON m.calendar_date = x.as_of - INTERVAL 1 MONTH
    JOIN dim_date q ON q.calendar_date = x.as_of - INTERVAL 3 MONTH
"""

FLAGS = f"""
    SELECT {LAST_FM} AS is_last_fiscal_month, {LAST_FQ} AS is_last_fiscal_quarter,
           fiscal_year = current_fy AS is_current_fiscal_year,
           fiscal_year = current_fy AND fiscal_month <= current_fm AS is_current_fytd,
           fiscal_year = current_fy AND fiscal_quarter = 1 AS is_current_fiscal_q1,
           fiscal_year = current_fy AND fiscal_quarter = 2 AS is_current_fiscal_q2,
           fiscal_year = 2000 AND fiscal_month = 6 AS is_spike_window,
           count(*) AS n_lines, {money(f'sum({NET})')} AS revenue
    FROM sales, anchor GROUP BY ALL
"""

ORACLE = {
    "fiscal_calendar": sql(CALENDAR_LOAD),
    "fiscal_anchor": sql(ANCHORS),
    "fiscal_flags": sql(FLAGS),
    "q01_revenue_last_fiscal_month": sql(Q01),
    "q02_revenue_by_region_last_quarter": sql(Q02),
    "q03_top_members_hardware": sql(Q03),
    "q04_business_health": sql(Q04),
    "q05_active_members_in_region": sql(Q05),
    "q06_quarter_revenue_by_family": sql(Q06),
    "q07_spike_attribution": sql(Q07),
    "q08_campaign_churn": sql(Q08),
    "q09_revenue_unknown_sku": sql(sku_revenue("ZX-NOEXIST-999")),
    "spike_attribution_all": sql(SPIKE_GROUPS),
    "campaign_churn_all": sql(CHURN),
    "fn_revenue_last_fiscal_month": sql(
        f"SELECT coalesce({money(f'sum({NET})')}, 0) AS recognized_revenue FROM sales, anchor WHERE {LAST_FM}"
    ),
    "fn_revenue_by_region_last_quarter": sql(Q02),
    "fn_top_members_hardware": sql(Q03),
    "fn_business_health": sql(Q04),
    "fn_active_members_in_region": sql(Q05),
    "fn_quarter_revenue_by_family": sql(Q06),
    "fn_spike_attribution": sql(Q07),
    "fn_campaign_churn": sql(Q08),
    "fn_revenue_for_sku": sql(sku_revenue("SKU-000007")),
    "param_revenue_by_region": sql(f"""
        SELECT {money(f'sum({NET})')} AS recognized_revenue FROM fact_order_line JOIN dim_geo USING (geo_key)
        WHERE line_status = 'FULFILLED' AND region_code = 'EUROPE'"""),
    "param_revenue_by_period": sql(f"""
        SELECT {money(f'sum({NET})')} AS recognized_revenue FROM sales
        WHERE fiscal_year = 2000 AND fiscal_month = 6"""),
    "param_members_by_region": sql("""
        SELECT count(*) AS active_members FROM dim_member JOIN dim_geo ON home_geo_key = geo_key
        WHERE region_code = 'EUROPE'"""),
}

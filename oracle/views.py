"""Oracle SQL of the wide views and the metric views."""

from oracle.kpis import LAST_FM, LAST_FQ, NET
from oracle.star import RETENTION, SPIKE, ratio, sql

FYTD = "fiscal_year = current_fy AND fiscal_month <= current_fm"
HARDWARE = "product_class IN ('DEVICE', 'ACCESSORY')"

ALL_JOINS = """
    sales LEFT JOIN dim_geo USING (geo_key) LEFT JOIN dim_product USING (product_key)
    LEFT JOIN dim_member USING (member_key) LEFT JOIN dim_campaign USING (campaign_key)
"""
SUBS_JOINS = """
    subs LEFT JOIN dim_member USING (member_key) LEFT JOIN dim_geo ON home_geo_key = geo_key
    LEFT JOIN dim_campaign ON attribution_campaign_key = campaign_key
"""


def total(value: str, where: str | None = None) -> str:
    return f"CAST(sum({value}) {f'FILTER (WHERE {where}) ' if where else ''}AS DOUBLE)"


def distinct(value: str, where: str | None = None) -> str:
    return f"count(DISTINCT {value}) {f'FILTER (WHERE {where})' if where else ''}"


def bucket(flag: str, alias: str) -> str:
    return f"CAST(CASE WHEN {flag} THEN {NET} ELSE 0 END AS DOUBLE) AS {alias}"


CANCELS = distinct("member_key", "event_type = 'CANCEL'")
WINDOW_CANCELS = distinct("member_key", f"event_type = 'CANCEL' AND {RETENTION}")
WINDOW_TOUCHED = distinct("member_key", RETENTION)

BASIC = f"""{total(NET)} AS recognized_revenue, count(*) AS order_line_count,
            {distinct('member_key')} AS distinct_members"""

MEMBERSHIP = f"""
    {distinct('member_key', "event_type = 'ACTIVATE'")} AS new_activations, {CANCELS} AS cancellations,
    {distinct('member_key')} AS touched_members, {ratio(CANCELS, distinct('member_key'))} AS churn_rate,
    {total('mrr_delta')} AS ending_mrr, {WINDOW_CANCELS} AS retention_window_cancellations,
    {WINDOW_TOUCHED} AS retention_window_touched,
    {ratio(WINDOW_CANCELS, WINDOW_TOUCHED)} AS retention_window_churn_rate,
    {distinct('member_key', "event_type IN ('ACTIVATE', 'RENEW') AND calendar_date >= DATE '2024-01-23'")}
        AS active_members_approx,
    count(*) AS subscription_event_count
"""


def conformed(fiscal_year: str) -> str:
    """Both grains stacked, the fiscal-year flag as given."""
    return f"""
    SELECT 'order' AS fact_family, member_key, {NET}, NULL AS mrr_delta, NULL AS event_type, product_class,
           campaign_code, region_name, region_code, {fiscal_year} AS is_current_fiscal_year,
           coalesce(is_active, false) AS is_active
    FROM sales LEFT JOIN dim_geo USING (geo_key) LEFT JOIN dim_product USING (product_key)
    LEFT JOIN dim_campaign USING (campaign_key) LEFT JOIN active_flags USING (member_key), {{anchor}}
    UNION ALL BY NAME
    SELECT 'subscription' AS fact_family, member_key, mrr_delta, event_type, campaign_code, region_name, region_code,
           {fiscal_year} AS is_current_fiscal_year, coalesce(is_active, false) AS is_active
    FROM {SUBS_JOINS} LEFT JOIN active_flags USING (member_key), {{anchor}}
    """


TOUCHED = distinct("member_key", "fact_family = 'subscription'")
CONFORMED = f"""
    {total(NET)} AS recognized_revenue, {total(NET, HARDWARE)} AS hardware_revenue,
    {total('mrr_delta')} AS ending_mrr, {CANCELS} AS cancellations, {TOUCHED} AS touched_members,
    {ratio(CANCELS, TOUCHED)} AS churn_rate, {distinct('member_key', 'is_active')} AS active_members,
    {distinct('member_key', "fact_family = 'order'")} AS distinct_members,
    count(*) FILTER (WHERE fact_family = 'order') AS order_line_count
"""

STACK = conformed("fiscal_year = current_fy").format(anchor="anchor")
SUBS_STACK = conformed("fiscal_year = current_fy").format(anchor="subs_anchor")

MONTHS = f"""
    SELECT {{dims}} date_trunc('month', calendar_date) AS m, sum({NET}) AS v FROM {ALL_JOINS} GROUP BY ALL
"""


def monthly(dims: str = "") -> str:
    """Value and prior value per month; the prior one by a self-join."""
    listed = f"{dims}, " if dims else ""
    same = f"a.{dims} IS NOT DISTINCT FROM b.{dims} AND " if dims else ""
    return f"""
    SELECT {f'a.{dims}, ' if dims else ''}a.m, CAST(a.v AS DOUBLE) AS cur, CAST(b.v AS DOUBLE) AS pri
    FROM ({MONTHS.format(dims=listed)}) a
    LEFT JOIN ({MONTHS.format(dims=listed)}) b ON {same} b.m = a.m - INTERVAL 1 MONTH
    """


MOM = """cur AS current_month_revenue, pri AS prior_month_revenue, (cur - pri) / nullif(pri, 0) AS mom_revenue_growth"""

ORACLE = {
    "wide_members": sql("""
        SELECT member_key, member_id, display_handle, member_tier, home_geo_key,
               strftime(signup_date, '%Y-%m-%d') AS signup_date, region_name, region_code,
               coalesce(is_active, false) AS is_active_member,
               CAST(coalesce(is_active, false) AS INTEGER) AS active_member_flag
        FROM dim_member LEFT JOIN dim_geo ON home_geo_key = geo_key LEFT JOIN active_flags USING (member_key)"""),
    "wide_orders": sql(f"""
        SELECT member_key, order_line_key, order_key, member_id, display_handle,
               CAST({NET} AS DOUBLE) AS {NET}, {bucket(HARDWARE, 'hardware_amount')},
               {bucket(f'{HARDWARE} AND {FYTD}', 'hardware_fytd_amount')}, {bucket(LAST_FM, 'last_fm_amount')},
               {bucket(LAST_FQ, 'last_fq_amount')}, {bucket(FYTD, 'fytd_amount')},
               {bucket('fiscal_year = current_fy AND fiscal_quarter = 1', 'q1_amount')},
               {bucket('fiscal_year = current_fy AND fiscal_quarter = 2', 'q2_amount')},
               {bucket(SPIKE, 'spike_amount')}, fiscal_year, fiscal_month, fiscal_quarter,
               region_name AS order_region_name, region_code AS order_region_code, product_family, product_class,
               sku_code, campaign_code, campaign_name
        FROM {ALL_JOINS}, anchor"""),
    "wide_subs": sql(f"""
        SELECT member_key, subscription_event_key, event_type, CAST(mrr_delta AS DOUBLE) AS mrr_delta,
               CAST(CASE WHEN {FYTD} THEN mrr_delta ELSE 0 END AS DOUBLE) AS fytd_mrr_delta,
               CAST(event_type = 'CANCEL' AS INTEGER) AS is_cancel,
               CAST({RETENTION} AS INTEGER) AS in_retention_window,
               CAST(event_type = 'CANCEL' AND {RETENTION} AS INTEGER) AS retention_cancel,
               fiscal_year, fiscal_month, campaign_code, campaign_name
        FROM subs JOIN dim_campaign ON attribution_campaign_key = campaign_key, subs_anchor"""),
    "active_members_exact": sql("SELECT member_key, is_active AS is_active_member FROM active_flags"),
    "relationship_contract": sql("""
        WITH k AS (
            SELECT 'dim_geo' AS relationship, CAST(geo_key AS BIGINT) AS key FROM dim_geo
            UNION ALL SELECT 'dim_product', product_key FROM dim_product
            UNION ALL SELECT 'dim_campaign', campaign_key FROM dim_campaign
            UNION ALL SELECT 'dim_member', member_key FROM dim_member
            UNION ALL SELECT 'fact_order', order_key FROM fact_order
            UNION ALL SELECT 'fact_order_line', order_line_key FROM fact_order_line)
        SELECT relationship, CAST(sum(n) AS BIGINT) AS n_rows, count(*) AS n_keys, max(n) AS most_matches,
               count(*) FILTER (WHERE n > 1) AS violations
        FROM (SELECT relationship, key, count(*) AS n FROM k GROUP BY ALL) GROUP BY relationship"""),
    "mv_basic_by_family": sql(f"SELECT product_family, {BASIC} FROM {ALL_JOINS} GROUP BY ALL"),
    "mv_basic_by_tier_and_year": sql(
        f"SELECT member_tier, fiscal_year, {BASIC} FROM {ALL_JOINS} GROUP BY member_tier, fiscal_year"
    ),
    "mv_rich_by_region": sql(f"""
        SELECT region_name AS region, {BASIC}, {total('gross_amount')} AS gross_line_amount,
               {total(NET, HARDWARE)} AS hardware_revenue, {distinct('order_key')} AS distinct_orders,
               {ratio(f'sum({NET})', distinct('member_key'))} AS avg_recognized_revenue_per_member
        FROM {ALL_JOINS}, anchor WHERE {LAST_FQ} GROUP BY region_name"""),
    "mv_rich_avg_per_member": sql(f"""
        SELECT member_tier, {distinct('member_key')} AS distinct_members,
               {ratio(f'sum({NET})', distinct('member_key'))} AS avg_recognized_revenue_per_member
        FROM {ALL_JOINS}, anchor WHERE {FYTD} GROUP BY member_tier"""),
    "mv_rich_top_members": sql(f"""
        SELECT member_id, {total(NET, HARDWARE)} AS hardware_revenue FROM {ALL_JOINS}, anchor WHERE {FYTD}
        GROUP BY member_id ORDER BY hardware_revenue DESC NULLS LAST, member_id LIMIT 10"""),
    "mv_rich_by_flag": sql(f"""
        SELECT fiscal_year = current_fy AND fiscal_quarter = 1 AS is_current_fiscal_q1,
               fiscal_year = current_fy AND fiscal_quarter = 2 AS is_current_fiscal_q2, product_class,
               {total(NET)} AS recognized_revenue, count(*) AS order_line_count
        FROM {ALL_JOINS}, anchor WHERE fiscal_year = current_fy AND region_code = 'EUROPE' GROUP BY ALL"""),
    "mv_membership_churn": sql(f"SELECT campaign_code, {MEMBERSHIP} FROM {SUBS_JOINS} GROUP BY campaign_code"),
    "mv_membership_by_region": sql(f"""
        SELECT region_name AS region, member_tier, {MEMBERSHIP} FROM {SUBS_JOINS}, subs_anchor WHERE {FYTD}
        GROUP BY region_name, member_tier"""),
    "mv_membership_window_churn": sql(f"""
        SELECT campaign_code, {ratio(CANCELS, distinct('member_key'))} AS churn_rate
        FROM {SUBS_JOINS} WHERE {RETENTION} GROUP BY campaign_code"""),
    "mv_conformed_union": sql(f"""
        SELECT fact_family, campaign_code, {CONFORMED} FROM ({STACK}) GROUP BY fact_family, campaign_code"""),
    "mv_conformed_by_region": sql(f"""
        SELECT region_name AS region, is_current_fiscal_year, {CONFORMED} FROM ({SUBS_STACK})
        GROUP BY region_name, is_current_fiscal_year"""),
    "mv_conformed_active": sql(f"""
        SELECT {distinct('member_key', 'is_active')} AS active_members FROM ({SUBS_STACK})
        WHERE is_current_fiscal_year AND region_code = 'EUROPE'"""),
    "mv_wide_periods": sql(f"""
        SELECT product_family, {BASIC}, {total(f'CASE WHEN {HARDWARE} THEN {NET} ELSE 0 END')} AS hardware_revenue,
               {total(f'CASE WHEN {HARDWARE} AND {FYTD} THEN {NET} ELSE 0 END')} AS hardware_fytd_revenue,
               {total(f'CASE WHEN {LAST_FM} THEN {NET} ELSE 0 END')} AS last_fiscal_month_revenue,
               {total(f'CASE WHEN {LAST_FQ} THEN {NET} ELSE 0 END')} AS last_fiscal_quarter_revenue,
               {total(f'CASE WHEN {FYTD} THEN {NET} ELSE 0 END')} AS fytd_recognized_revenue,
               {total(f'CASE WHEN fiscal_year = current_fy AND fiscal_quarter = 1 THEN {NET} ELSE 0 END')}
                   AS q1_recognized_revenue,
               {total(f'CASE WHEN fiscal_year = current_fy AND fiscal_quarter = 2 THEN {NET} ELSE 0 END')}
                   AS q2_recognized_revenue,
               {total(f'CASE WHEN {SPIKE} THEN {NET} ELSE 0 END')} AS spike_revenue
        FROM {ALL_JOINS}, anchor GROUP BY product_family"""),
    "mv_window_current_and_prior": sql(f"""
        SELECT product_class, strftime(m, '%Y-%m-%d') AS fiscal_month_start, {MOM}
        FROM ({monthly('product_class')})"""),
    "mv_window_mom_last": sql(f"""
        SELECT region_name AS region, {MOM} FROM ({monthly('region_name')})
        QUALIFY row_number() OVER (PARTITION BY region_name ORDER BY m DESC) = 1"""),
    "mv_window_prior_of_one_month": sql(f"""
        SELECT strftime(m, '%Y-%m-%d') AS fiscal_month_start, {MOM} FROM ({monthly()})
        WHERE m = DATE '2000-03-01'"""),
    "mv_window_fytd": sql(f"""
        SELECT region_name AS region, fiscal_year, {total(NET)} AS fytd_window_revenue,
               {total(NET)} AS recognized_revenue FROM {ALL_JOINS} GROUP BY region_name, fiscal_year"""),
    "mv_window_fytd_daily": sql(f"""
        SELECT strftime(a.calendar_date, '%Y-%m-%d') AS calendar_date, a.fiscal_year,
               CAST(sum(b.v) AS DOUBLE) AS fytd_window_revenue
        FROM (SELECT DISTINCT calendar_date, fiscal_year FROM sales WHERE fiscal_year = 2000) a
        JOIN (SELECT calendar_date, sum({NET}) AS v FROM sales WHERE fiscal_year = 2000 GROUP BY 1) b
          ON b.calendar_date <= a.calendar_date GROUP BY ALL"""),
    "snippet_last_month_by_family": sql(f"""
        SELECT product_family, {total(NET)} AS recognized_revenue,
               {total(f'CASE WHEN {HARDWARE} THEN {NET} ELSE 0 END')} AS hardware_revenue
        FROM {ALL_JOINS}, anchor WHERE {LAST_FM} GROUP BY product_family"""),
    "snippet_region_last_quarter": sql(f"""
        SELECT fiscal_month, {total(NET)} AS recognized_revenue FROM {ALL_JOINS}, anchor
        WHERE {LAST_FQ} AND region_code = 'EUROPE' GROUP BY fiscal_month"""),
    "snippet_spike": sql(f"""
        SELECT product_family, {total(NET)} AS recognized_revenue FROM {ALL_JOINS} WHERE {SPIKE}
        GROUP BY product_family"""),
    "snippet_churn": sql(f"""
        SELECT fiscal_year, {ratio(CANCELS, distinct('member_key'))} AS churn_rate, {total('mrr_delta')} AS ending_mrr
        FROM subs, subs_anchor WHERE {FYTD} AND {RETENTION} GROUP BY fiscal_year"""),
    "snippet_active_members": sql("SELECT count(*) AS active_members FROM active_flags WHERE is_active"),
    "mv_window_distinct_beside": sql(f"""
        WITH j AS (SELECT *, date_trunc('month', calendar_date) AS m FROM {ALL_JOINS}),
        last AS (SELECT region_name, max(m) AS m FROM j GROUP BY 1),
        ends AS (SELECT region_name, max(fiscal_year) AS fiscal_year FROM j GROUP BY 1)
        SELECT a.region, a.distinct_members, c.v AS current_month_revenue, f.v AS fytd_window_revenue, a.order_line_count
        FROM (SELECT region_name AS region, {distinct('member_key')} AS distinct_members, count(*) AS order_line_count
              FROM j GROUP BY 1) a
        JOIN (SELECT region_name, {total(NET)} AS v FROM j JOIN last USING (region_name, m) GROUP BY 1) c
          ON c.region_name IS NOT DISTINCT FROM region
        JOIN (SELECT region_name, {total(NET)} AS v FROM j JOIN ends USING (region_name, fiscal_year) GROUP BY 1) f
          ON f.region_name IS NOT DISTINCT FROM region"""),
    "mv_window_distinct_along": sql(f"""
        WITH j AS (SELECT *, date_trunc('month', calendar_date) AS m FROM {ALL_JOINS}),
        months AS (SELECT product_class, m, {distinct('member_key')} AS n, {total(NET)} AS v FROM j GROUP BY 1, 2)
        SELECT a.product_class, strftime(a.m, '%Y-%m-%d') AS fiscal_month_start, a.n AS members, p.n AS prior_members,
               (SELECT {distinct('member_key')} FROM j WHERE j.product_class = a.product_class AND j.m <= a.m)
                   AS members_so_far,
               (SELECT {distinct('member_key', HARDWARE)} FROM j WHERE j.product_class = a.product_class AND j.m <= a.m)
                   AS hardware_members_so_far,
               a.v AS current_month_revenue
        FROM months a LEFT JOIN months p ON p.product_class = a.product_class AND p.m = a.m - INTERVAL 1 MONTH"""),
    "mv_window_distinct_fytd": sql(f"""
        SELECT region_name AS region, fiscal_year, {distinct('member_key')} AS members_this_year_so_far,
               {distinct('order_key')} AS orders_this_year_so_far, {distinct('member_key')} AS distinct_members,
               {total(NET)} AS fytd_window_revenue
        FROM {ALL_JOINS} GROUP BY region_name, fiscal_year"""),
    "mv_window_distinct_daily": sql(f"""
        WITH d AS (SELECT calendar_date, {total(NET)} AS v FROM sales WHERE fiscal_year = 2000 GROUP BY 1)
        SELECT strftime(a.calendar_date, '%Y-%m-%d') AS calendar_date, 2000 AS fiscal_year,
               (SELECT {distinct('member_key')} FROM sales b WHERE fiscal_year = 2000 AND b.calendar_date <= a.calendar_date)
                   AS members_this_year_so_far, a.v AS recognized_revenue
        FROM d a WHERE a.calendar_date >= DATE '2000-03-01'"""),
    "rollup_sales_by_region": sql(f"""
        SELECT region_name, CAST(count(*) AS BIGINT) AS n_rows, {total(NET)} AS net_recognized_amount,
               {distinct('member_key')} AS member_key, {distinct('order_key')} AS order_key FROM {ALL_JOINS} GROUP BY region_name"""),
    "rollup_sales_by_class_and_year": sql(f"""
        SELECT product_class, fiscal_year, CAST(count(*) AS BIGINT) AS n_rows, {total(NET)} AS net_recognized_amount,
               {distinct('member_key')} AS member_key, {distinct('order_key')} AS order_key FROM {ALL_JOINS} GROUP BY ALL"""),
    "rollup_sales_total": sql(f"""
        SELECT CAST(count(*) AS BIGINT) AS n_rows, {total(NET)} AS net_recognized_amount,
               {distinct('member_key')} AS member_key, {distinct('order_key')} AS order_key FROM sales"""),
    "sql_last_month": sql(f"""
        SELECT {total(NET)} AS "measure(Recognized Revenue)" FROM sales, anchor WHERE {LAST_FM}"""),
    "sql_quarter_by_region": sql(f"""
        SELECT region_name AS "Region", {total(NET)} AS recognized_revenue FROM {ALL_JOINS}, anchor WHERE {LAST_FQ}
        GROUP BY region_name"""),
    "sql_active_members": sql(f"""
        SELECT {distinct('member_key', 'is_active')} AS "measure(Active Members)" FROM ({SUBS_STACK})
        WHERE is_current_fiscal_year AND region_code = 'EUROPE'"""),
    "sql_window_churn": sql(f"""
        SELECT campaign_code AS "Campaign Code", {ratio(CANCELS, distinct('member_key'))} AS churn_rate
        FROM {SUBS_JOINS} WHERE {RETENTION} GROUP BY campaign_code
        ORDER BY churn_rate NULLS FIRST, campaign_code NULLS FIRST LIMIT 10"""),
    "sql_top_members": sql(f"""
        SELECT member_id AS "Member ID", {total(NET, HARDWARE)} AS hw FROM {ALL_JOINS}, anchor WHERE {FYTD}
        GROUP BY member_id ORDER BY hw DESC NULLS LAST, member_id LIMIT 10"""),
    "sql_wide_last_month": sql(f"""
        SELECT {total(f'CASE WHEN {LAST_FM} THEN {NET} ELSE 0 END')} AS "measure(Last Fiscal Month Revenue)"
        FROM sales, anchor"""),
    "sql_windowed_flag": sql(f"""
        SELECT {total(NET, LAST_FM)} AS "measure(Last Fiscal Month Revenue Flag)" FROM sales, anchor"""),
    "sql_membership_churn": sql(f"""
        SELECT {ratio(CANCELS, distinct('member_key'))} AS "measure(Churn Rate)" FROM subs WHERE {RETENTION}"""),
    "sql_expressions": sql(f"""
        SELECT lower(region_name) AS market, fiscal_year % 2 AS parity, fiscal_year AS "Fiscal Year",
               {total(NET)} / count(*) AS per_line, {distinct('member_key')} AS "measure(Distinct Members)"
        FROM {ALL_JOINS} WHERE product_class IN ('DEVICE', 'ACCESSORY') AND NOT member_tier = 'BUILDING'
        GROUP BY 1, 2, 3 HAVING count(*) > 3 AND fiscal_year > 1994"""),
    "sql_windowed_months": sql(f"""
        SELECT strftime(a.m, '%Y-%m-%d') AS month, p.v AS prior, a.n AS members
        FROM (SELECT date_trunc('month', calendar_date) AS m, {distinct('member_key')} AS n FROM sales GROUP BY 1) a
        LEFT JOIN (SELECT date_trunc('month', calendar_date) AS m, {total(NET)} AS v FROM sales GROUP BY 1) p
          ON p.m = a.m - INTERVAL 1 MONTH
        WHERE a.m >= DATE '2000-03-01'"""),
    "mv_window_last_month_flag": sql(f"""
        SELECT region_name AS region, {total(NET, LAST_FM)} AS last_fiscal_month_revenue_flag,
               {total(NET, HARDWARE)} AS hardware_revenue, count(*) AS order_line_count
        FROM {ALL_JOINS}, anchor GROUP BY region_name"""),
}

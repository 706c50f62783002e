"""Oracle SQL of scoring, costs and rollups."""

from oracle import star
from oracle.kpis import CHURN, LAST_FM, NET
from oracle.star import sql

WINDOW_START, WINDOW_END = "TIMESTAMP '2024-01-08 00:30:00'", "TIMESTAMP '2024-01-21 12:15:00'"

star.VIEWS.update(
    {
        "answers": """
            SELECT *, status = 'COMPLETED' AND CAST(floor(value) AS BIGINT) % 2 = 0 AS correct,
                   reply IS NOT NULL AND sql_text IS NULL AND status = 'COMPLETED' AS clarification_asked
            FROM (
                SELECT printf('run_%05d', user_id) AS run_id, 'T' || (k % 10) AS tier,
                       'Q' || (event_id % 10 + 1) AS question_id, CAST((k // 10) % 4 AS INTEGER) AS attempt,
                       'space_' || (k % 10) AS space_id, 'wh_' || (k % 5) AS warehouse_id,
                       'sp_' || (k % 10) AS run_as_sp, event_id AS message_id, value,
                       CAST(value AS DECIMAL(12,2)) AS latency_ms, ts AS started_at,
                       ts + to_seconds(CAST(floor(value) AS INTEGER)) AS finished_at,
                       CASE WHEN event_type = 'error' THEN 'FAILED'
                            WHEN event_type = 'click' AND k % 7 = 0 THEN 'TIMEOUT' ELSE 'COMPLETED' END AS status,
                       ['SELECT MEASURE(`Recognized Revenue`) FROM mv_sales_rich WHERE `Is Last Fiscal Month`',
                        'SELECT SUM(duration_sec) AS revenue FROM fact_usage_event',
                        'SELECT SUM(order_gross_amount) FROM fact_order',
                        'SELECT SUM(amount) FROM distractor_orders_v1',
                        'SELECT * FROM fn_business_health_kpi_pack()',
                        'SELECT p.product_family, c.campaign_code FROM fact_order_line JOIN dim_campaign c WHERE d.fiscal_month = 6'
                       ][(event_id + k) % 7 + 1] AS sql_text,
                       ['Could you clarify which KPI you mean?', 'Revenue and MRR are up, churn is down.',
                        'The June spike came from the launch.', 'June spike by product family and campaign.',
                        'Here is the result.'][(event_id // 7 + k) % 6 + 1] AS reply
                FROM event_rows)
        """,
        "latest": """
            SELECT * FROM answers QUALIFY row_number() OVER (
                PARTITION BY run_id, tier, question_id ORDER BY attempt DESC, message_id DESC) = 1
        """,
        "judged": """
            SELECT *, CASE question_id WHEN 'Q4' THEN
                        hits >= 2 OR contains(blob, 'clarif') OR contains(blob, 'fn_business_health_kpi_pack')
                      ELSE (contains(blob, 'june') OR contains(blob, 'fiscal_month = 6'))
                           AND (contains(blob, 'launch') OR (
                                (contains(blob, 'product_family') OR contains(blob, 'product family'))
                                AND contains(blob, 'campaign')))
                      END AS ok,
                   CAST(hits AS DOUBLE) / 4 AS health_share
            FROM (SELECT *, list_sum([CAST(contains(blob, w) AS INTEGER) FOR w IN
                         ['revenue', 'mrr', 'churn', 'clarif', 'kpi_pack', 'business_health', 'fn_business_health']
                         ]) AS hits
                  FROM (SELECT *, lower(coalesce(reply, '') || chr(10) || coalesce(sql_text, '')) AS blob
                        FROM answers WHERE question_id IN ('Q4', 'Q7')))
        """,
        "scores": """
            SELECT run_id, tier, question_id, attempt, message_id, status, sql_text, clarification_asked, ok AS correct,
                   CASE WHEN question_id = 'Q4' THEN least(health_share, 1.0) ELSE CAST(ok AS DOUBLE) END AS answer_score
            FROM judged WHERE message_id IN (SELECT message_id FROM latest)
            UNION ALL
            SELECT run_id, tier, question_id, attempt, message_id, status, sql_text, clarification_asked, correct,
                   CAST(correct AS DOUBLE) FROM latest WHERE question_id NOT IN ('Q4', 'Q7')
        """,
        "usage_rows": """
            SELECT CASE k % 3 WHEN 0 THEN 'AGENT_ANSWERS' WHEN 1 THEN 'SERVERLESS_SQL_STD'
                   ELSE 'SERVERLESS_SQL_PRO' END AS sku_name,
                   CAST(ts AS DATE) AS usage_date, CAST(date_trunc('hour', ts) AS TIMESTAMP) AS starts,
                   CAST(date_trunc('hour', ts) AS TIMESTAMP) + INTERVAL 1 HOUR AS ends,
                   CAST(CAST(value AS DECIMAL(12,2)) * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(14,4)) AS units,
                   'sp_' || (k % 10) AS run_as_sp, CASE WHEN k % 2 = 0 THEN 'chat' ELSE 'api' END AS surface,
                   'wh_' || (k % 4) AS warehouse_id, k % 3 = 0 AS is_agent
            FROM event_rows WHERE event_type = 'purchase'
        """,
        "price_list": """
            SELECT sku_name, CASE WHEN late THEN TIMESTAMP '2024-01-15' ELSE TIMESTAMP '2023-12-01' END AS valid_from,
                   CASE WHEN late THEN NULL ELSE TIMESTAMP '2024-01-15' END AS valid_to,
                   CAST(price AS DECIMAL(10,4)) AS price
            FROM (VALUES ('AGENT_ANSWERS', false, 0.07), ('AGENT_ANSWERS', true, 0.085),
                         ('SERVERLESS_SQL_STD', false, 0.70), ('SERVERLESS_SQL_STD', true, 0.75),
                         ('SERVERLESS_SQL_PRO', false, 0.90), ('SERVERLESS_SQL_PRO', true, 0.95)) t(sku_name, late, price)
        """,
        "priced": """
            SELECT u.*, p.price, CAST(units * price AS DECIMAL(38,8)) AS cost FROM usage_rows u JOIN price_list p
            ON u.sku_name = p.sku_name AND starts >= valid_from AND (valid_to IS NULL OR starts < valid_to)
        """,
        "run_windows": """
            SELECT *, date_trunc('hour', start_ts) AS bill_start,
                   CASE WHEN date_trunc('hour', end_ts) < end_ts THEN date_trunc('hour', end_ts) + INTERVAL 1 HOUR
                        ELSE end_ts END AS bill_end
            FROM (SELECT run_id, min(started_at) - INTERVAL 5 MINUTE AS start_ts,
                         max(finished_at) + INTERVAL 5 MINUTE AS end_ts FROM answers GROUP BY run_id)
        """,
        "asks": """
            SELECT run_id, tier, run_as_sp, date_trunc('hour', started_at) AS h, count(*) AS n
            FROM answers GROUP BY ALL
        """,
        "shares": """
            SELECT run_id, tier, run_as_sp,
                   CAST(sum(CAST(coalesce(CAST(u AS DOUBLE), 0) * n / greatest(all_n, 1) AS DECIMAL(28,10))) AS DOUBLE)
                       AS agent_units,
                   CAST(sum(CAST(coalesce(CAST(c AS DOUBLE), 0) * n / greatest(all_n, 1) AS DECIMAL(28,10))) AS DOUBLE)
                       AS agent_cost_usd
            FROM (SELECT *, sum(n) OVER (PARTITION BY run_as_sp, h) AS all_n FROM asks)
            LEFT JOIN (SELECT run_as_sp, starts AS h, sum(units) AS u, sum(cost) AS c FROM priced WHERE is_agent
                       GROUP BY ALL) USING (run_as_sp, h)
            GROUP BY run_id, tier, run_as_sp
        """,
        "tier_names": """
            SELECT 'T' || i AS tier, axis, lever, lever || ' tier' AS tier_name, 'isolate ' || lever AS intent
            FROM (VALUES (0, 'control', 'none'), (1, 'baseline', 'raw_tables'), (2, 'data_surface', 'basic_metric_view'),
                  (3, 'data_surface', 'rich_metric_view'), (4, 'full', 'all_levers'), (5, 'anti_pattern', 'distractors'),
                  (6, 'metadata', 'column_comments'), (7, 'metadata', 'synonyms'), (8, 'joins', 'join_specs'),
                  (9, 'examples', 'ten_examples')) t(i, axis, lever)
        """,
        "tco": """
            SELECT q.*, agent_units, agent_cost_usd, agent_cost_usd AS total_cost_usd, axis, lever, tier_name, intent,
                   agent_cost_usd / nullif(n_correct, 0) AS cost_per_correct_usd,
                   agent_cost_usd * (1.0 - eventual_accuracy) AS waste_index,
                   eventual_accuracy >= 0.5 AS above_quality_floor
            FROM (
                SELECT run_id, tier, count(*) AS n_questions,
                       CAST(count(*) FILTER (WHERE first_pass) AS DOUBLE) / count(*) AS first_pass_accuracy,
                       CAST(count(*) FILTER (WHERE ever) AS DOUBLE) / count(*) AS eventual_accuracy,
                       CAST(sum(latency) AS DOUBLE) / count(*) AS avg_latency_ms,
                       CAST(quantile_disc(latency, 0.5) AS DOUBLE) AS p50_latency_ms,
                       CAST(quantile_disc(latency, 0.95) AS DOUBLE) AS p95_latency_ms,
                       CAST(sum(coalesce(regen, 0)) AS DOUBLE) / count(*) AS avg_regenerations,
                       count(*) FILTER (WHERE ever) AS n_correct
                FROM (SELECT run_id, tier, question_id, bool_or(correct) FILTER (WHERE attempt = 0) AS first_pass,
                             bool_or(correct) AS ever, max(latency_ms) AS latency,
                             max(attempt) FILTER (WHERE correct) AS regen
                      FROM answers GROUP BY run_id, tier, question_id)
                GROUP BY run_id, tier) q
            JOIN shares USING (run_id, tier) JOIN tier_names USING (tier)
        """,
        "copied": f"""
            SELECT sku_code || '|' || fiscal_year AS answer_id, region_name, CAST(sum({NET}) AS DOUBLE) AS v
            FROM bronze_order_line JOIN dim_date ON recognition_date_key = date_key JOIN dim_product USING (product_key)
            JOIN dim_geo USING (geo_key) GROUP BY ALL
        """,
        "copied_clean": """
            SELECT answer_id, region_name, v FROM (SELECT *, max(abs(v) > 0.01) OVER (PARTITION BY answer_id) AS any_big
            FROM copied) WHERE NOT any_big OR abs(v) > 0.01
        """,
        "clean_sales": """
            SELECT *, sku_code || '|' || fiscal_year AS answer_id FROM fact_order_line
            JOIN dim_date ON recognition_date_key = date_key JOIN dim_product USING (product_key)
            WHERE line_status = 'FULFILLED'
        """,
        "raw_sales": """
            SELECT *, sku_code || '|' || fiscal_year AS answer_id FROM bronze_order_line
            JOIN dim_date ON recognition_date_key = date_key JOIN dim_product USING (product_key)
            WHERE line_status = 'FULFILLED'
        """,
        "golden": f"""
            SELECT answer_id, region_name, CAST(sum({NET}) AS DOUBLE) AS v
            FROM clean_sales JOIN dim_geo USING (geo_key) GROUP BY ALL
        """,
    }
)

FAILURE = """
    CASE WHEN correct THEN NULL WHEN clarification_asked THEN 'clarification'
         WHEN status IN ('FAILED', 'TIMEOUT', 'CANCELLED') THEN 'no_sql_or_error'
         WHEN sql_text IS NULL THEN 'no_sql_generated'
         WHEN sql_text LIKE '%fact_usage_event%' AND lower(sql_text) LIKE '%revenue%'
             THEN 'wrong_table_usage_for_revenue'
         WHEN sql_text LIKE '%order_gross_amount%' THEN 'wrong_revenue_definition'
         WHEN sql_text LIKE '%distractor\\_%' ESCAPE '\\' THEN 'distractor_table' ELSE 'wrong_result' END
"""

EQUAL = """(abs(coalesce(o.{0}, 0) - coalesce(g.{0}, 0)) <= 0.01
            OR abs(coalesce(o.{0}, 0) - coalesce(g.{0}, 0)) <= abs(coalesce(o.{0}, 0)) * 0.001)"""


def diff(gold: str, got: str, keys: list[str], measures: list[str]) -> str:
    """Full outer comparison per answer, as the keyed diff defines it."""
    on = " AND ".join(f"o.{k} IS NOT DISTINCT FROM g.{k}" for k in ["answer_id", *keys])
    oks = ", ".join(f"count(*) FILTER (WHERE both_here AND ok_{m}) AS ok_{m}" for m in measures)
    flags = ", ".join(f"{EQUAL.format(m)} AS ok_{m}" for m in measures)
    failing = ", ".join(f"CASE WHEN ok_{m} < n_both THEN CAST(ok_{m} AS DOUBLE) / n_both END" for m in measures)
    score = f"CASE WHEN n_both < n_keys THEN 0.0 ELSE coalesce({failing}, 1.0) END"
    return f"""
        SELECT answer_id, n_keys, n_keys - n_both AS n_unmatched, CAST({score} AS DOUBLE) = 1.0 AS correct,
               CAST({score} AS DOUBLE) AS answer_score
        FROM (SELECT answer_id, count(*) AS n_keys, count(*) FILTER (WHERE both_here) AS n_both, {oks}
              FROM (SELECT coalesce(o.answer_id, g.answer_id) AS answer_id,
                           o.answer_id IS NOT NULL AND g.answer_id IS NOT NULL AS both_here, {flags}
                    FROM ({gold}) o FULL JOIN ({got}) g ON {on})
              GROUP BY answer_id)
    """


def quarters(source: str) -> str:
    return f"""
        SELECT CAST(fiscal_year AS VARCHAR) AS answer_id, product_family,
               CAST(sum({NET}) FILTER (WHERE fiscal_quarter = 1) AS DOUBLE) AS q1,
               CAST(sum({NET}) FILTER (WHERE fiscal_quarter = 2) AS DOUBLE) AS q2
        FROM {source} WHERE fiscal_quarter IN (1, 2) GROUP BY ALL
    """


def totals(source: str) -> str:
    return f"SELECT answer_id, CAST(sum({NET}) AS DOUBLE) AS v FROM {source} GROUP BY answer_id"


def top_skus(source: str) -> str:
    return f"""
        SELECT answer_id, sku_code, CAST(v AS DOUBLE) AS v
        FROM (SELECT CAST(fiscal_year AS VARCHAR) AS answer_id, sku_code, sum({NET}) AS v FROM {source} GROUP BY ALL)
        QUALIFY row_number() OVER (PARTITION BY answer_id ORDER BY v DESC, sku_code) <= 10
    """


OVERLAP = f"starts < {WINDOW_END} AND ends > {WINDOW_START}"
TS = "'%Y-%m-%d %H:%M:%S'"
WHS = "('wh_0', 'wh_1', 'wh_3')"

COST_ZEROS = ", ".join(
    f"0.0::DOUBLE AS {c}"
    for c in (
        "warehouse_units warehouse_cost_usd warehouse_query_cost_usd warehouse_bill_cost_usd warehouse_hourly_usd "
        "bytes_scanned sql_statements total_duration_ms execution_duration_ms waiting_for_compute_ms "
        "total_task_duration_ms execution_duration_sec"
    ).split()
)
PER_CORRECT = """
    cost_per_correct_usd, cost_per_correct_usd AS agent_cost_per_correct_usd,
    0.0::DOUBLE / nullif(n_correct, 0) AS warehouse_cost_per_correct_usd,
    0.0::DOUBLE / nullif(n_correct, 0) AS bytes_per_correct,
    0.0::DOUBLE / nullif(n_correct, 0) AS execution_ms_per_correct
"""
TCO = f"""
    SELECT run_id, tier, n_questions, first_pass_accuracy, eventual_accuracy, avg_latency_ms, p50_latency_ms,
           p95_latency_ms, avg_regenerations, n_correct, agent_units, agent_cost_usd, total_cost_usd, {COST_ZEROS},
           {PER_CORRECT}, waste_index, above_quality_floor, axis, lever, tier_name, intent FROM tco
"""


def total(value: str) -> str:
    return f"CAST(sum(CAST({value} AS DECIMAL(30,13))) AS DOUBLE)"


def mean(value: str) -> str:
    return f"{total(value)} / nullif(CAST(count({value}) AS DOUBLE), 0)"


def spread(value: str) -> str:
    name = f"{value}_usd"
    return f"""
        {mean(name)} AS mean_{name},
        round(CASE WHEN count({name}) > 1 THEN stddev_samp({name}) ELSE 0 END, 8) AS std_{name},
        round(CASE WHEN count({name}) > 1 THEN stddev_samp({name}) / sqrt(count({name}))
                   WHEN count({name}) = 1 THEN 0 END, 8) AS se_{name},
        min({name}) AS min_{name}, max({name}) AS max_{name}
    """


SECONDS = "CAST(round(CAST(sum({0}) AS DECIMAL(18,3)) * CAST(0.001 AS DECIMAL(4,3)), 2) AS DOUBLE)"

# The interpolated percentile in hundredths, in whole numbers.
_RANK, _PART = "(95 * (count(*) - 1)) // 100", "(95 * (count(*) - 1)) % 100"
_SORTED = "list_sort(list(total))"
P95 = f"""({_SORTED}[{_RANK} + 1] * 100 + (coalesce({_SORTED}[{_RANK} + 2], 0) - {_SORTED}[{_RANK} + 1]) * ({_PART}))"""

HISTORY = f"""
    SELECT *, total // 2 AS execution, total // 10 AS waiting, CASE WHEN k % 11 > 0 THEN total // 20 ELSE 0 END AS capacity
    FROM (SELECT *, CAST(CAST(value AS DECIMAL(12,2)) * 100 AS BIGINT) AS total FROM event_rows)
    WHERE ts >= {WINDOW_START} AND ts < {WINDOW_END}
"""

ORACLE = {
    "message_parse": sql("""
        SELECT message_id, status, sql_text, reply AS text_response, clarification_asked FROM answers"""),
    "latest_attempt": sql("SELECT run_id, tier, question_id, attempt, message_id, status FROM latest"),
    "failure_classes": sql(f"SELECT message_id, coalesce({FAILURE}, 'correct') AS failure_type FROM answers"),
    "rubric_scores": sql("""
        SELECT message_id, question_id, ok AS correct,
               CASE WHEN question_id = 'Q4' THEN least(health_share, 1.0) ELSE CAST(ok AS DOUBLE) END AS answer_score
        FROM judged"""),
    "update_scores": sql(f"""
        SELECT a.message_id, a.run_id, a.tier, a.question_id, a.attempt,
               CASE WHEN s.message_id IS NULL THEN CAST(a.correct AS DOUBLE) ELSE s.answer_score END AS answer_score,
               CASE WHEN s.message_id IS NULL THEN a.correct ELSE s.correct END AS correct,
               coalesce(s.failure, '') AS failure_type,
               CASE WHEN a.attempt > 0 THEN -1
                    ELSE CAST(CASE WHEN s.message_id IS NULL THEN a.correct ELSE s.correct END AS INTEGER) END
                   AS first_pass
        FROM answers a LEFT JOIN (SELECT *, {FAILURE} AS failure FROM scores) s ON a.message_id = s.message_id"""),
    "update_scores_in_place": sql(f"""
        SELECT a.message_id, a.run_id, a.tier, a.question_id, a.attempt,
               CASE WHEN s.message_id IS NULL THEN CAST(a.correct AS DOUBLE) ELSE s.answer_score END AS answer_score,
               CASE WHEN s.message_id IS NULL THEN a.correct ELSE s.correct END AS correct,
               coalesce(s.failure, '') AS failure_type,
               CASE WHEN a.attempt > 0 THEN -1
                    ELSE CAST(CASE WHEN s.message_id IS NULL THEN a.correct ELSE s.correct END AS INTEGER) END
                   AS first_pass
        FROM answers a LEFT JOIN (SELECT *, {FAILURE} AS failure FROM scores) s ON a.message_id = s.message_id"""),
    "tier_accuracy": sql("""
        SELECT tier, count(*) AS n_answers, count(*) FILTER (WHERE correct) AS n_correct,
               CAST(count(*) FILTER (WHERE correct) AS DOUBLE) / count(*) AS accuracy FROM scores GROUP BY tier"""),
    "contamination_gate": sql("""
        SELECT *, CASE WHEN control_first_pass > 0.35 THEN 'FAIL'
                       WHEN coalesce(full_first_pass < 0.7, false) OR n_above_floor < 3 THEN 'WARN'
                       ELSE 'PASS' END AS status
        FROM (SELECT run_id, max(first_pass_accuracy) FILTER (WHERE tier = 'T0') AS control_first_pass,
                     max(first_pass_accuracy) FILTER (WHERE tier = 'T4') AS full_first_pass,
                     count(*) FILTER (WHERE above_quality_floor) AS n_above_floor FROM tco GROUP BY run_id)"""),
    "dedup_order_lines": sql(f"""
        SELECT order_line_key, product_key, campaign_key, CAST({NET} AS DOUBLE) AS {NET} FROM fact_order_line"""),
    "result_normalized": sql("SELECT answer_id, region_name, v AS recognized_revenue FROM copied_clean"),
    "result_diff": sql(diff(
        "SELECT * FROM golden", "SELECT * FROM copied_clean", ["region_name"], ["v"])),
    "result_diff_inferred": sql(diff(
        "SELECT * FROM golden", "SELECT * FROM copied_clean", ["region_name"], ["v"])),
    "result_diff_inferred_quarters": sql(
        diff(quarters("clean_sales"), quarters("raw_sales"), ["product_family"], ["q1", "q2"])),
    "result_diff_scalar": sql(diff(totals("clean_sales"), totals("raw_sales"), [], ["v"])),
    "result_diff_top_n": sql(diff(top_skus("clean_sales"), top_skus("raw_sales"), ["sku_code"], ["v"])),
    "result_diff_pivot": sql(diff(quarters("clean_sales"), quarters("raw_sales"), ["product_family"], ["q1", "q2"])),
    "zero_or_empty": sql(f"""
        SELECT sku_code AS answer_id, coalesce(max(abs({NET})), 0) <= 0.01 AS correct FROM dim_product
        LEFT JOIN (SELECT product_key, sum({NET}) AS {NET} FROM sales, anchor WHERE {LAST_FM} GROUP BY product_key)
        USING (product_key) GROUP BY sku_code"""),
    "mv_vs_golden": sql(f"""
        SELECT * FROM (
            SELECT 'last_month_revenue' AS answer_id, CAST(1 AS BIGINT) AS n_keys
            UNION ALL SELECT 'last_quarter_by_region', count(DISTINCT region_name)
                      FROM sales JOIN dim_geo USING (geo_key), anchor
                      WHERE fiscal_year = last_fq_year AND fiscal_quarter = last_fq
            UNION ALL SELECT 'active_members', 1
            UNION ALL SELECT 'campaign_churn', count(*) FROM ({CHURN})),
            (SELECT CAST(0 AS BIGINT) AS n_unmatched, true AS correct, CAST(1 AS DOUBLE) AS answer_score)"""),
    "bill_window": sql(f"""
        SELECT run_id, strftime(start_ts, {TS}) AS start_ts, strftime(end_ts, {TS}) AS end_ts,
               strftime(bill_start, {TS}) AS bill_start, strftime(bill_end, {TS}) AS bill_end FROM run_windows"""),
    "billing_by_sp": sql(f"""
        SELECT strftime(usage_date, '%Y-%m-%d') AS usage_date, run_as_sp, surface, sku_name,
               CAST(sum(units) AS DOUBLE) AS billable_units, CAST(sum(cost) AS DOUBLE) AS list_cost_usd
        FROM priced WHERE is_agent AND {OVERLAP} GROUP BY ALL"""),
    "billing_by_some_sp": sql(f"""
        SELECT strftime(usage_date, '%Y-%m-%d') AS usage_date, run_as_sp, surface, sku_name,
               CAST(sum(units) AS DOUBLE) AS billable_units, CAST(sum(cost) AS DOUBLE) AS list_cost_usd
        FROM priced WHERE is_agent AND {OVERLAP} AND run_as_sp IN ('sp_1', 'sp_3', 'sp_4') GROUP BY ALL"""),
    "bill_window_fallback": sql(f"""
        SELECT run_id,
               CASE WHEN untimed THEN '2024-01-18 10:20:00' ELSE strftime(start_ts, {TS}) END AS start_ts,
               CASE WHEN untimed THEN '2024-01-25 10:20:00' ELSE strftime(end_ts, {TS}) END AS end_ts,
               CASE WHEN untimed THEN '2024-01-18 10:00:00' ELSE strftime(bill_start, {TS}) END AS bill_start,
               CASE WHEN untimed THEN '2024-01-25 11:00:00' ELSE strftime(bill_end, {TS}) END AS bill_end
        FROM (SELECT *, run_id LIKE '%5' AS untimed FROM run_windows)"""),
    "rollup_latency_percentiles": sql("""
        SELECT tier, count(*) AS n_questions, true AS p50_within, true AS p95_within
        FROM (SELECT run_id, tier, question_id, max(latency_ms) AS latency FROM answers GROUP BY ALL)
        WHERE latency IS NOT NULL GROUP BY tier"""),
    "warehouse_billing": sql(f"""
        SELECT strftime(usage_date, '%Y-%m-%d') AS usage_date, warehouse_id,
               CAST(sum(units) AS DOUBLE) AS warehouse_units, CAST(sum(cost) AS DOUBLE) AS warehouse_cost_usd
        FROM priced WHERE warehouse_id IN {WHS} AND {OVERLAP} GROUP BY ALL"""),
    "hourly_rate": sql(f"""
        SELECT 'Medium' AS size, CAST(24 AS BIGINT) AS units_per_hour, round(usd, 8) AS usd_per_unit,
               round(usd * 24, 6) AS hourly_usd, true AS from_list_prices, sku_name
        FROM (SELECT CAST(sum(price) AS DOUBLE) / count(*) AS usd, min(sku_name) AS sku_name FROM priced WHERE warehouse_id IN {WHS}
              AND starts >= TIMESTAMP '2024-01-10' AND sku_name LIKE '%SERVERLESS_SQL%')"""),
    "hourly_rate_fallback": sql(f"""
        SELECT 'Large' AS size, CAST(40 AS BIGINT) AS units_per_hour, round(coalesce(usd, 0.7), 8) AS usd_per_unit,
               round(coalesce(usd, 0.7) * 40, 6) AS hourly_usd, usd IS NOT NULL AS from_list_prices, CAST(NULL AS VARCHAR) AS sku_name
        FROM (SELECT CAST(sum(price) AS DOUBLE) / count(*) AS usd FROM priced WHERE warehouse_id IN {WHS}
              AND starts >= TIMESTAMP '2030-01-01')"""),
    "query_history_profile": sql(f"""
        SELECT 'space_' || (k % 10) AS agent_space_id, 'wh_' || (k % 4) AS warehouse_id, count(*) AS query_count,
               CAST(sum(total) AS BIGINT) AS total_duration_ms, CAST(sum(execution) AS BIGINT) AS execution_duration_ms,
               CAST(sum(waiting) AS BIGINT) AS waiting_for_compute_ms,
               CAST(sum(capacity) AS BIGINT) AS waiting_at_capacity_ms,
               CAST(sum(total // 25) AS BIGINT) AS compilation_duration_ms,
               CAST(sum(total * 3) AS BIGINT) AS total_task_duration_ms,
               {SECONDS.format('total')} AS total_duration_sec, {SECONDS.format('execution')} AS execution_duration_sec,
               CAST((20 * sum(total) + count(*)) // (2 * count(*)) AS DOUBLE) / 10 AS avg_total_duration_ms,
               CAST(({P95} + 5) // 10 AS DOUBLE) / 10 AS p95_total_duration_ms,
               CAST(sum(total * 1024) AS BIGINT) AS bytes_scanned, CAST(sum(total * 7) AS BIGINT) AS read_rows,
               count(*) FILTER (WHERE event_type = 'error') AS failed_queries,
               count(*) FILTER (WHERE k % 5 = 0) AS cached_queries
        FROM ({HISTORY}) GROUP BY k % 10, k % 4"""),
    "audit_by_space": sql(f"""
        SELECT 'space_' || (k % 10) AS space_id,
               CASE event_type WHEN 'signup' THEN 'startConversation' WHEN 'click' THEN 'createMessage'
                    ELSE 'regenerateMessage' END AS action_name,
               count(*) AS events, count(DISTINCT user_id) AS users
        FROM event_rows WHERE k % 9 <> 0 AND event_type IN ('signup', 'click', 'error')
          AND ts >= {WINDOW_START} AND ts < {WINDOW_END} GROUP BY 1, 2"""),
    "token_usage": sql(f"""
        SELECT strftime(t, '%Y-%m-%d') AS usage_date, 'requester_' || (conv_id % 7) AS requester, role AS endpoint_name,
               CAST(sum(CASE WHEN role = 'user' THEN n ELSE 0 END) AS BIGINT) AS input_tokens,
               CAST(sum(CASE WHEN role = 'user' THEN 0 ELSE n END) AS BIGINT) AS output_tokens,
               CAST(sum(n) AS BIGINT) AS total_tokens, CAST(sum(n % 997) AS DOUBLE) / count(*) AS avg_latency_ms
        FROM (SELECT *, length(text) AS n, TIMESTAMP '2024-01-01' + to_hours(CAST((conv_id * 37) % 720 AS INTEGER)) AS t
              FROM conversations)
        WHERE t >= {WINDOW_START} AND t < {WINDOW_END} GROUP BY 1, 2, 3"""),
    "cost_single_run": sql("""
        SELECT run_id, tier, space_id, warehouse_id, run_as_sp,
               CAST(coalesce(sum(units), 0) AS DOUBLE) AS agent_units, CAST(coalesce(sum(cost), 0) AS DOUBLE) AS agent_cost_usd
        FROM (SELECT DISTINCT run_id, tier, space_id, warehouse_id, run_as_sp FROM answers)
        JOIN run_windows USING (run_id)
        LEFT JOIN (SELECT run_as_sp AS sp, starts, ends, sum(units) AS units, sum(cost) AS cost FROM priced
                   WHERE is_agent GROUP BY ALL) ON run_as_sp = sp AND starts < bill_end AND ends > bill_start
        GROUP BY run_id, tier, space_id, warehouse_id, run_as_sp"""),
    "cost_prorated": sql("SELECT * FROM shares"),
    "fact_tier_cost": sql(f"""
        SELECT run_id, tier, 'space_' || tier[2:] AS space_id, 'wh_' || (CAST(tier[2:] AS INTEGER) % 5) AS warehouse_id,
               run_as_sp, agent_units, agent_cost_usd, {COST_ZEROS}, 0.0::DOUBLE AS audit_events FROM shares"""),
    "metric_tco": sql(TCO),
    "tco_above_floor": sql(TCO + " WHERE above_quality_floor"),
    "run_summary": sql(f"""
        SELECT run_id, tier, axis, lever, tier_name, first_pass_accuracy, eventual_accuracy, n_correct, n_questions,
               bytes_scanned, sql_statements, bytes_per_correct, agent_units, warehouse_units, total_cost_usd,
               cost_per_correct_usd, above_quality_floor FROM ({TCO})"""),
    "metric_tco_by_axis": sql(f"""
        SELECT run_id, axis, count(*) AS n_tiers, {mean('first_pass_accuracy')} AS avg_first_pass_accuracy,
               {mean('eventual_accuracy')} AS avg_eventual_accuracy, {total('total_cost_usd')} AS total_cost_usd,
               {total('agent_cost_usd')} AS agent_cost_usd,
               {mean('cost_per_correct_usd')} AS avg_cost_per_correct_usd,
               {mean('cost_per_correct_usd')} AS avg_agent_cost_per_correct_usd,
               sum(bytes_scanned) AS bytes_scanned, sum(execution_duration_sec) AS execution_duration_sec,
               count(*) FILTER (WHERE above_quality_floor) AS n_above_floor FROM ({TCO}) GROUP BY run_id, axis"""),
    "leaderboard_per_correct": sql(f"""
        SELECT tier, tier_name, axis, lever, count(*) AS n_runs, {mean('eventual_accuracy')} AS mean_accuracy,
               round(coalesce(stddev_samp(eventual_accuracy), 0), 8) AS std_accuracy,
               {mean('agent_cost_usd')} AS mean_agent_cost_usd, {spread('cost_per_correct')}
        FROM tco GROUP BY ALL"""),
    "leaderboard_run_costs": sql("""
        SELECT run_id, tier, lever, n_questions, agent_units, agent_cost_usd,
               agent_cost_usd / n_questions AS cost_per_answer_usd FROM tco"""),
    "leaderboard_per_answer": sql(f"""
        SELECT tier, lever, count(*) AS n_runs, count(*) FILTER (WHERE agent_cost_usd = 0) AS zeros,
               {mean('agent_cost_usd')} AS mean_agent_cost_usd, {spread('cost_per_answer')}
        FROM (SELECT *, agent_cost_usd / n_questions AS cost_per_answer_usd FROM tco) GROUP BY tier, lever"""),
    "answer_preview": sql(f"""
        SELECT run_id, tier, question_id, attempt, message_id, status, correct, {FAILURE} AS failure_type,
               CAST(latency_ms AS DOUBLE) AS latency_ms, left(sql_text, 200) AS sql_preview FROM answers"""),
    "run_matrix": sql(f"""
        SELECT run_id, tier, question_id, correct AS first_pass, correct, {FAILURE} AS failure_type, status
        FROM latest"""),
    "latest_run": sql(f"""
        SELECT run_id, strftime(min(started_at), {TS}) AS started_at FROM answers GROUP BY run_id
        ORDER BY min(started_at) DESC, run_id LIMIT 1"""),
}

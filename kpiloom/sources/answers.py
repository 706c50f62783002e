"""Answer logs, billing and telemetry, derived from the event stream.

Every event is one answered question: its user is the run, the number in its
JSON picks the tier and the attempt. Nothing is sampled or capped, so the logs
grow with the events. The nested columns match the shape such system tables
have, and are read by dotted path.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kpiloom.sources.star import RetailStar, as_money, cents

# Statements and replies the answer log cycles through.
STATEMENTS = (
    "SELECT MEASURE(`Recognized Revenue`) FROM mv_sales_rich WHERE `Is Last Fiscal Month`",
    "SELECT SUM(duration_sec) AS revenue FROM fact_usage_event",
    "SELECT SUM(order_gross_amount) FROM fact_order",
    "SELECT SUM(amount) FROM distractor_orders_v1",
    "SELECT * FROM fn_business_health_kpi_pack()",
    "SELECT p.product_family, c.campaign_code FROM fact_order_line JOIN dim_campaign c WHERE d.fiscal_month = 6",
)
REPLIES = (
    "Could you clarify which KPI you mean?",
    "Revenue and MRR are up, churn is down.",
    "The June spike came from the launch.",
    "June spike by product family and campaign.",
    "Here is the result.",
)


def _cycle(values: tuple[str, ...], index: Column) -> Column:
    """One of ``values``, or NULL once per round."""
    choices = F.array(*map(F.lit, values), F.lit(None).cast("string"))
    return F.element_at(choices, (index % (len(values) + 1)).cast("int") + 1)


def _numbered(prefix: str, number: Column) -> Column:
    return F.concat(F.lit(prefix), number.cast("string"))


def answers(star: RetailStar) -> DataFrame:
    """The answer log, 24 columns, one row per attempt."""
    k, event = F.col("k"), F.col("event_id")
    status = (
        F.when(F.col("event_type") == "error", "FAILED")
        .when((F.col("event_type") == "click") & (k % 7 == 0), "TIMEOUT")
        .otherwise("COMPLETED")
    )
    attempt = (F.floor(k / 10) % 4).cast("int")
    sql, reply = _cycle(STATEMENTS, event + k), _cycle(REPLIES, F.floor(event / 7) + k)
    correct = (F.col("status") == "COMPLETED") & (F.floor("value") % 2 == 0)
    seconds = F.floor("value").cast("int")
    base = star.event_rows().withColumns({"status": status, "sql": sql, "reply": reply, "attempt": attempt})
    return base.withColumn("correct", correct).select(
        F.format_string("run_%05d", "user_id").alias("run_id"),
        _numbered("T", k % 10).alias("tier"),
        _numbered("Q", event % 10 + 1).alias("question_id"),
        "attempt",
        _numbered("space_", k % 10).alias("space_id"),
        _numbered("wh_", k % 5).alias("warehouse_id"),
        _numbered("sp_", k % 10).alias("run_as_sp"),
        _numbered("conv_", event).alias("conversation_id"),
        event.alias("message_id"),
        _numbered("question ", event % 10 + 1).alias("question_text"),
        F.concat(F.lit("b64:"), F.base64(F.encode("sql", "UTF-8"))).alias("generated_sql"),
        "status",
        (F.col("reply").isNotNull() & F.col("sql").isNull() & (F.col("status") == "COMPLETED")).alias(
            "clarification_asked"
        ),
        (event % 13).cast("int").alias("row_count"),
        as_money(cents("value")).alias("latency_ms"),
        F.col("reply").alias("text_response"),
        F.when(F.col("status") == "FAILED", F.lit("failed")).alias("error"),
        "correct",
        F.when(F.col("correct"), 1.0).otherwise(0.0).alias("answer_score"),
        F.lit(None).cast("string").alias("failure_type"),
        F.when(F.col("attempt") == 0, F.col("correct")).alias("is_first_pass_correct"),
        F.when(F.col("correct"), F.col("attempt")).alias("regenerations_until_correct"),
        F.col("ts").alias("started_at"),
        (F.col("ts") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), seconds)).alias("finished_at"),
    )


def messages(star: RetailStar) -> DataFrame:
    """Chat messages as the JSON text a conversation API returns.

    One in three carries its text as an attachment rather than as content.
    """
    log = answers(star)
    sql = decode_sql(F.col("generated_sql"))
    text = F.col("text_response")
    attached = F.col("message_id") % 3 == 0
    query = F.when(sql.isNotNull(), F.struct(F.struct(sql.alias("query")).alias("query")))
    reply = F.when(attached & text.isNotNull(), F.struct(F.struct(text.alias("content")).alias("text")))
    parts = F.array_compact(F.array(F.to_json(query), F.to_json(reply)))
    body = F.to_json(F.struct("status", F.when(~attached, text).alias("content")))
    joined = F.concat(
        F.expr("left(body, length(body) - 1)"), F.lit(',"attachments":['), F.concat_ws(",", "parts"), F.lit("]}")
    )
    return log.select("message_id", "run_id", "tier", body.alias("body"), parts.alias("parts")).select(
        "message_id", "run_id", "tier", joined.alias("message")
    )


def decode_sql(stored: Column) -> Column:
    """Statements are stored as base64 behind a ``b64:`` prefix."""
    coded = stored.startswith("b64:")
    return F.when(coded, F.decode(F.unbase64(stored.substr(F.lit(5), F.length(stored))), "UTF-8")).otherwise(stored)


# The ten context strategies an answer can come from.
TIERS = tuple(
    (f"T{i}", axis, lever)
    for i, (axis, lever) in enumerate(
        (
            ("control", "none"),
            ("baseline", "raw_tables"),
            ("data_surface", "basic_metric_view"),
            ("data_surface", "rich_metric_view"),
            ("full", "all_levers"),
            ("anti_pattern", "distractors"),
            ("metadata", "column_comments"),
            ("metadata", "synonyms"),
            ("joins", "join_specs"),
            ("examples", "ten_examples"),
        )
    )
)


def dim_tier(star: RetailStar) -> DataFrame:
    rows = ", ".join(
        f"('{tier}', '{tier.lower()}', '{lever} tier', '{axis}', '{lever}', 'isolate {lever}')"
        for tier, axis, lever in TIERS
    )
    return star.spark.sql(f"SELECT * FROM VALUES {rows} AS t(tier, tier_key, name, axis, lever, intent)")


# -- billing -------------------------------------------------------------------

AGENT_PRODUCT = "AGENT"

# List prices per unit and the spans they hold for.
PRICES = (
    ("AGENT_ANSWERS", "2023-12-01", "2024-01-15", "0.0700"),
    ("AGENT_ANSWERS", "2024-01-15", None, "0.0850"),
    ("SERVERLESS_SQL_STD", "2023-12-01", "2024-01-15", "0.7000"),
    ("SERVERLESS_SQL_STD", "2024-01-15", None, "0.7500"),
    ("SERVERLESS_SQL_PRO", "2023-12-01", "2024-01-15", "0.9000"),
    ("SERVERLESS_SQL_PRO", "2024-01-15", None, "0.9500"),
)


def billing_usage(star: RetailStar) -> DataFrame:
    """Hour-bucketed usage; an open bucket has no end time."""
    k = F.col("k")
    hour = F.date_trunc("HOUR", "ts").cast("timestamp_ntz")
    sku = F.when(k % 3 == 0, "AGENT_ANSWERS").when(k % 3 == 1, "SERVERLESS_SQL_STD").otherwise("SERVERLESS_SQL_PRO")
    return star.event_rows().where(F.col("event_type") == "purchase").select(
        F.lit("AWS").alias("cloud"),
        sku.alias("sku_name"),
        F.col("ts").cast("date").alias("usage_date"),
        hour.alias("usage_start_time"),
        F.when(F.col("event_id") % 2 == 0, hour + F.expr("INTERVAL 1 HOUR")).alias("usage_end_time"),
        as_money(cents("value"), 4).alias("usage_quantity"),
        F.when(k % 3 == 0, AGENT_PRODUCT).otherwise("SQL").alias("billing_origin_product"),
        F.struct(_numbered("sp_", k % 10).alias("run_as")).alias("identity_metadata"),
        F.struct(
            F.struct(F.when(k % 2 == 0, "chat").otherwise("api").alias("surface")).alias("agent"),
            _numbered("wh_", k % 4).alias("warehouse_id"),
        ).alias("usage_metadata"),
    )


def list_prices(star: RetailStar) -> DataFrame:
    rows = ", ".join(
        f"('AWS', '{sku}', TIMESTAMP_NTZ'{start} 00:00:00', "
        f"{'NULL' if end is None else f'''TIMESTAMP_NTZ'{end} 00:00:00' '''}, CAST('{price}' AS DECIMAL(10,4)))"
        for sku, start, end, price in PRICES
    )
    return star.spark.sql(
        "SELECT cloud, sku_name, price_start_time, CAST(price_end_time AS TIMESTAMP_NTZ) AS price_end_time, "
        "named_struct('effective_list', named_struct('default', price)) AS pricing "
        f"FROM VALUES {rows} AS t(cloud, sku_name, price_start_time, price_end_time, price)"
    )


# -- telemetry -------------------------------------------------------------------


def query_history(star: RetailStar) -> DataFrame:
    """Statement timings per agent space and warehouse."""
    k = F.col("k")
    total = cents("value")
    base = star.event_rows().withColumn("total", total)
    part = {
        "execution_duration_ms": "total div 2",
        "waiting_for_compute_duration_ms": "total div 10",
        "waiting_at_capacity_duration_ms": "CASE WHEN k % 11 > 0 THEN total div 20 END",
        "compilation_duration_ms": "total div 25",
        "total_task_duration_ms": "total * 3",
        "read_bytes": "total * 1024",
        "read_rows": "total * 7",
    }
    return base.select(
        F.col("ts").alias("start_time"),
        F.struct(_numbered("space_", k % 10).alias("agent_space_id")).alias("query_source"),
        F.struct(_numbered("wh_", k % 4).alias("warehouse_id")).alias("compute"),
        F.col("total").alias("total_duration_ms"),
        *(F.expr(text).alias(name) for name, text in part.items()),
        F.when(F.col("event_type") == "error", "FAILED").otherwise("FINISHED").alias("execution_status"),
        (k % 5 == 0).alias("from_result_cache"),
    )


# Audit actions that are a question to an agent.
QUESTION_ACTIONS = ("startConversation", "createMessage", "regenerateMessage")


def audit_log(star: RetailStar) -> DataFrame:
    kind = F.col("event_type")
    action = (
        F.when(kind == "signup", "startConversation")
        .when(kind == "click", "createMessage")
        .when(kind == "error", "regenerateMessage")
        .otherwise("getSpace")
    )
    return star.event_rows().select(
        F.when(F.col("k") % 9 == 0, "dashboards").otherwise("agent").alias("service_name"),
        action.alias("action_name"),
        F.col("ts").alias("event_time"),
        F.struct(_numbered("space_", F.col("k") % 10).alias("space_id")).alias("request_params"),
        F.struct(F.concat(F.lit("user"), F.col("user_id").cast("string"), F.lit("@example.com")).alias("email")).alias(
            "user_identity"
        ),
    )


def gateway_usage(star: RetailStar) -> DataFrame:
    """Token counts of every conversation turn; characters stand for tokens."""
    size = F.length("text").cast("bigint")
    asked = F.col("role") == "user"
    return star.raw("conversations").select(
        F.timestamp_add("HOUR", F.pmod(F.col("conv_id") * 37, F.lit(720)).cast("int"), F.lit("2024-01-01").cast("timestamp_ntz")).alias(
            "request_time"
        ),
        _numbered("requester_", F.col("conv_id") % 7).alias("requester"),
        F.col("role").alias("endpoint_name"),
        F.when(asked, size).otherwise(0).alias("input_tokens"),
        F.when(asked, 0).otherwise(size).alias("output_tokens"),
        size.alias("total_tokens"),
        (size % 997).alias("request_duration_ms"),
    )

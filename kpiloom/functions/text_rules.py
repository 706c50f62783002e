"""Rules that judge an answer by its statement and its text."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Words that count toward a business-health answer.
HEALTH_WORDS = ("revenue", "mrr", "churn", "clarif", "kpi_pack", "business_health", "fn_business_health")
HEALTH_ENOUGH = ("clarif", "fn_business_health_kpi_pack")
SPIKE_NAMES = ("launch",)
SPIKE_PRODUCT = ("product_family", "product family", "dim_product")
SPIKE_CAMPAIGN = ("campaign", "dim_campaign")
SPIKE_MONTH = (
    "june",
    "fiscal_month = 6",
    "fiscal_month=6",
    "fiscal_month =6",
    "fiscal_month==6",
    "fn_revenue_spike",
)
SPIKE_FUNCTION = "fn_revenue_spike"
BROKEN_STATUSES = ("FAILED", "TIMEOUT", "CANCELLED")


def failure_type(status: Column, sql: Column, clarification: Column, correct: Column) -> Column:
    """Why an answer is not correct; NULL when it is. The first rule wins."""
    text = F.lower(sql)

    def has(word: str) -> Column:
        return text.contains(word)

    no_status = status.isNull() | (status == "") | status.isin(*BROKEN_STATUSES)
    return (
        F.when(correct, F.lit(None).cast("string"))
        .when(clarification, "clarification")
        .when(no_status, "no_sql_or_error")
        .when(sql.isNull() | (sql == ""), "no_sql_generated")
        .when(has("fact_usage_event") & has("revenue"), "wrong_table_usage_for_revenue")
        .when(has("order_gross_amount") | has("order_ts"), "wrong_revenue_definition")
        .when(has("distractor_"), "distractor_table")
        .when(~correct, "wrong_result")
        .otherwise("unevaluated")
    )


def _any(blob: Column, words: tuple[str, ...]) -> Column:
    return reduce(Column.__or__, (blob.contains(w) for w in words))


def rubric_columns(health: str, spike: str, sql: Column) -> dict[str, Column]:
    """Keyword verdict and score for the two open questions, NULL for others.

    Health: two of the words, or a clarifying question. Spike: the month, and
    either the launch by name or product and campaign together.
    """
    text = F.lower(F.concat(F.coalesce("text_response", F.lit("")), F.lit("\n"), F.coalesce(sql, F.lit(""))))
    hits = reduce(Column.__add__, (text.contains(w).cast("int") for w in HEALTH_WORDS))
    health_ok = (hits >= 2) | _any(text, HEALTH_ENOUGH)
    structure = _any(text, SPIKE_PRODUCT) & _any(text, SPIKE_CAMPAIGN)
    spike_ok = _any(text, SPIKE_MONTH) & (
        _any(text, SPIKE_NAMES) | structure | text.contains(SPIKE_FUNCTION)
    )
    question = F.col("question_id")
    return {
        "correct": F.when(question == health, health_ok).when(question == spike, spike_ok),
        "answer_score": F.when(question == health, F.least(hits / 4, F.lit(1.0))).when(
            question == spike, spike_ok.cast("double")
        ),
    }


def rubric(answers: DataFrame, health: str, spike: str, sql: Column) -> DataFrame:
    """The two open questions' answers with their keyword scores."""
    judged = answers.where(F.col("question_id").isin(health, spike))
    return judged.withColumns(rubric_columns(health, spike, sql))


# The shape of a chat message as the conversation API returns it.
MESSAGE_SCHEMA = (
    "status string, content string, attachments array<struct<"
    "query: struct<query: string, description: string>, text: struct<content: string>>>"
)


def parsed_messages(messages: DataFrame) -> DataFrame:
    """Statement, text and clarification flag out of message JSON.

    The statement is the last query attachment's. The text is the content,
    else the first description or text attachment. Text without a statement
    on a completed message asks back.
    """
    parsed = messages.withColumn("m", F.from_json("message", MESSAGE_SCHEMA))
    attachments = F.coalesce("m.attachments", F.array())
    queries = F.filter(attachments, lambda a: a["query"].isNotNull())
    sql = F.try_element_at(queries, F.lit(-1))["query"]["query"]
    texts = F.flatten(
        F.transform(attachments, lambda a: F.array(a["query"]["description"], a["text"]["content"]))
    )
    spoken = F.filter(texts, lambda t: t.isNotNull() & (t != ""))
    content = F.when(F.col("m.content") != "", F.col("m.content"))
    text = F.coalesce(content, F.try_element_at(spoken, F.lit(1)))
    fields = parsed.withColumns({"sql_text": sql, "text_response": text, "status": F.col("m.status")})
    no_sql = F.col("sql_text").isNull() | (F.col("sql_text") == "")
    asks = F.col("text_response").isNotNull() & no_sql & (F.col("status") == "COMPLETED")
    return fields.withColumn("clarification_asked", F.coalesce(asks, F.lit(False))).drop("m", "message")

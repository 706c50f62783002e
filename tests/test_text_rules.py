import json

import pytest
from pyspark.sql import functions as F

from kpiloom.functions.text_rules import failure_type, parsed_messages, rubric
from kpiloom.sources.answers import decode_sql

CASES = [
    (("COMPLETED", "x", False, True), None),
    (("FAILED", None, True, False), "clarification"),
    (("TIMEOUT", "x", False, False), "no_sql_or_error"),
    ((None, "x", False, None), "no_sql_or_error"),
    (("COMPLETED", "", False, False), "no_sql_generated"),
    (("COMPLETED", "SELECT Revenue FROM fact_usage_event", False, False), "wrong_table_usage_for_revenue"),
    (("COMPLETED", "order_ts", False, False), "wrong_revenue_definition"),
    (("COMPLETED", "FROM distractor_orders_v1", False, False), "distractor_table"),
    (("COMPLETED", "SELECT 1", False, False), "wrong_result"),
    (("COMPLETED", "SELECT 1", False, None), "unevaluated"),
]


@pytest.mark.parametrize("row, label", CASES)
def test_failure_labels(spark, row, label):
    frame = spark.createDataFrame([row], "status string, sql string, clarification boolean, correct boolean")
    got = frame.select(failure_type(F.col("status"), F.col("sql"), F.col("clarification"), F.col("correct"))).first()[0]
    assert got == label


RUBRIC = [
    ("Q4", "Revenue and MRR", None, True, 0.5),
    ("Q4", "Could you clarify?", None, True, 0.25),
    ("Q4", "Revenue", None, False, 0.25),
    ("Q4", None, "SELECT * FROM fn_business_health_kpi_pack()", True, 0.75),
    ("Q7", "The June spike came from the launch", None, True, 1.0),
    ("Q7", "June", "SELECT product_family, campaign_code", True, 1.0),
    ("Q7", "June", "SELECT product_family", False, 0.0),
    ("Q7", "launch", None, False, 0.0),
]


@pytest.mark.parametrize("question, text, sql, correct, score", RUBRIC)
def test_rubric(spark, question, text, sql, correct, score):
    frame = spark.createDataFrame([(question, text, sql)], "question_id string, text_response string, sql string")
    row = rubric(frame, "Q4", "Q7", F.col("sql")).first()
    assert (row.correct, row.answer_score) == (correct, score)


MESSAGES = [
    ({"status": "COMPLETED", "content": "hi", "attachments": [{"query": {"query": "S1"}}]}, ("S1", "hi", False)),
    ({"status": "COMPLETED", "attachments": [{"query": {"query": "S1", "description": "d"}}, {"text": {"content": "t"}}]},
     ("S1", "d", False)),
    ({"status": "COMPLETED", "attachments": [{"text": {"content": "which?"}}]}, (None, "which?", True)),
    ({"status": "FAILED", "content": "sorry"}, (None, "sorry", False)),
    ({"status": "COMPLETED", "attachments": [{"query": {"query": "S1"}}, {"query": {"query": "S2"}}]}, ("S2", None, False)),
]


@pytest.mark.parametrize("message, want", MESSAGES)
def test_message_fields(spark, message, want):
    frame = spark.createDataFrame([(1, json.dumps(message))], "message_id long, message string")
    row = parsed_messages(frame).first()
    assert (row.sql_text, row.text_response, row.clarification_asked) == want


def test_statement_decoding(spark):
    frame = spark.createDataFrame([("b64:U0VMRUNUIDE=",), ("SELECT 2",), (None,)], "s string")
    assert [r[0] for r in frame.select(decode_sql(F.col("s"))).collect()] == ["SELECT 1", "SELECT 2", None]

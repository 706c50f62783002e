"""Rollups: cost against quality per run and tier, and leaderboards over runs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kpiloom.operators.aggregates import as_double, exact_mean, exact_sum, mean_of, safe_ratio, spread
from kpiloom.plans.scoring import ANSWER_KEY, latest_attempts

QUALITY_FLOOR = 0.50
PREVIEW = 200
# Cost columns carried into the rollup, 0 when a tier has none.
COST_COLUMNS = (
    "agent_units",
    "agent_cost_usd",
    "warehouse_units",
    "warehouse_cost_usd",
    "warehouse_query_cost_usd",
    "warehouse_bill_cost_usd",
    "warehouse_hourly_usd",
    "bytes_scanned",
    "sql_statements",
    "total_duration_ms",
    "execution_duration_ms",
    "waiting_for_compute_ms",
    "total_task_duration_ms",
    "execution_duration_sec",
)
PER_CORRECT = {
    "cost_per_correct_usd": "agent_cost_usd",
    "agent_cost_per_correct_usd": "agent_cost_usd",
    "warehouse_cost_per_correct_usd": "warehouse_cost_usd",
    "bytes_per_correct": "bytes_scanned",
    "execution_ms_per_correct": "execution_duration_ms",
}


def _share(flag: str) -> Column:
    return safe_ratio(F.count_if(F.col(flag)), F.count(F.lit(1)))


def tier_quality(answers: DataFrame) -> DataFrame:
    """Attempts to questions to tiers."""
    questions = answers.groupBy(*ANSWER_KEY).agg(
        F.max(F.when(F.col("attempt") == 0, F.col("correct"))).alias("first_pass_correct"),
        F.max("correct").alias("eventually_correct"),
        F.max("latency_ms").alias("latency_ms"),
        F.max("regenerations_until_correct").alias("regenerations"),
    )
    flags = {c: F.coalesce(F.col(c), F.lit(False)) for c in ("first_pass_correct", "eventually_correct")}
    latency = as_double(F.col("latency_ms"))
    return questions.withColumns(flags).groupBy("run_id", "tier").agg(
        F.count(F.lit(1)).alias("n_questions"),
        _share("first_pass_correct").alias("first_pass_accuracy"),
        _share("eventually_correct").alias("eventual_accuracy"),
        mean_of(F.col("latency_ms")).alias("avg_latency_ms"),
        F.approx_percentile(latency, F.lit(0.5), F.lit(10000)).alias("p50_latency_ms"),
        F.approx_percentile(latency, F.lit(0.95), F.lit(10000)).alias("p95_latency_ms"),
        mean_of(F.coalesce("regenerations", F.lit(0))).alias("avg_regenerations"),
        F.count_if("eventually_correct").alias("n_correct"),
    )


def metric_tco(answers: DataFrame, costs: DataFrame, tiers: DataFrame) -> DataFrame:
    """Quality, cost, and cost per correct answer of every run and tier.

    A tier without a correct answer has no cost per correct one. The waste
    index is the cost times the share of wrong answers.
    """
    spent = costs.select("run_id", "tier", *COST_COLUMNS)
    # warehouse_query_cost falls back to the warehouse cost, the rest to 0.
    filled = {c: F.coalesce(F.col(c), F.lit(0.0)) for c in COST_COLUMNS}
    filled["warehouse_query_cost_usd"] = F.coalesce("warehouse_query_cost_usd", "warehouse_cost_usd", F.lit(0.0))
    names = tiers.select("tier", "axis", "lever", F.col("name").alias("tier_name"), "intent")
    joined = tier_quality(answers).join(spent, ["run_id", "tier"], "left").withColumns(filled)
    per_correct = {name: safe_ratio(F.col(cost), F.col("n_correct")) for name, cost in PER_CORRECT.items()}
    return joined.join(names, "tier", "left").withColumns(
        {
            "total_cost_usd": F.col("agent_cost_usd"),
            **per_correct,
            "waste_index": F.col("agent_cost_usd") * (1.0 - F.col("eventual_accuracy")),
            "above_quality_floor": F.col("eventual_accuracy") >= QUALITY_FLOOR,
        }
    )


def tco_by_axis(tco: DataFrame) -> DataFrame:
    return tco.groupBy("run_id", "axis").agg(
        F.count(F.lit(1)).alias("n_tiers"),
        exact_mean("first_pass_accuracy").alias("avg_first_pass_accuracy"),
        exact_mean("eventual_accuracy").alias("avg_eventual_accuracy"),
        exact_sum("total_cost_usd").alias("total_cost_usd"),
        exact_sum("agent_cost_usd").alias("agent_cost_usd"),
        exact_mean("cost_per_correct_usd").alias("avg_cost_per_correct_usd"),
        exact_mean("agent_cost_per_correct_usd").alias("avg_agent_cost_per_correct_usd"),
        F.sum("bytes_scanned").alias("bytes_scanned"),
        F.sum("execution_duration_sec").alias("execution_duration_sec"),
        F.count_if("above_quality_floor").alias("n_above_floor"),
    ).orderBy(F.asc_nulls_last("avg_cost_per_correct_usd"), "run_id", "axis")


def leaderboard_per_correct(tco: DataFrame) -> DataFrame:
    """Tiers by mean cost per correct answer over the runs that have one."""
    cost = spread(F.col("cost_per_correct_usd"))
    accuracy = spread(F.col("eventual_accuracy"))
    return tco.groupBy("tier", "tier_name", "axis", "lever").agg(
        F.count(F.lit(1)).alias("n_runs"),
        accuracy["mean"].alias("mean_accuracy"),
        accuracy["std"].alias("std_accuracy"),
        exact_mean("agent_cost_usd").alias("mean_agent_cost_usd"),
        *(value.alias(f"{name}_cost_per_correct_usd") for name, value in cost.items()),
    ).orderBy(F.asc_nulls_last("mean_cost_per_correct_usd"), "tier")


def run_costs_per_answer(tco: DataFrame) -> DataFrame:
    """One row per run and tier: cost per answer.

    The per-run lists of a leaderboard, kept as rows: a list would gather all
    of a tier's runs into one value.
    """
    return tco.select(
        "run_id",
        "tier",
        "lever",
        "n_questions",
        "agent_units",
        "agent_cost_usd",
        safe_ratio(F.col("agent_cost_usd"), F.col("n_questions")).alias("cost_per_answer_usd"),
    )


def leaderboard_per_answer(per_run: DataFrame) -> DataFrame:
    """Tiers by mean cost per answer, counting the runs that cost nothing."""
    cost = spread(F.col("cost_per_answer_usd"))
    return per_run.groupBy("tier", "lever").agg(
        F.count(F.lit(1)).alias("n_runs"),
        F.count_if(F.col("agent_cost_usd") == 0).alias("zeros"),
        *(value.alias(f"{name}_cost_per_answer_usd") for name, value in cost.items()),
        exact_mean("agent_cost_usd").alias("mean_agent_cost_usd"),
    ).orderBy("mean_cost_per_answer_usd", "tier")


# -- dashboard datasets ---------------------------------------------------------------


def tco_ranked(tco: DataFrame) -> DataFrame:
    return tco.orderBy(F.asc_nulls_last("cost_per_correct_usd"), "run_id", "tier")


def tco_above_floor(tco: DataFrame) -> DataFrame:
    return tco_ranked(tco.where("above_quality_floor"))


def answer_preview(answers: DataFrame, sql: Column) -> DataFrame:
    return answers.select(
        "run_id", "tier", "question_id", "attempt", "message_id", "status", "correct", "failure_type",
        as_double(F.col("latency_ms")).alias("latency_ms"), F.left(sql, F.lit(PREVIEW)).alias("sql_preview"),
    )


def run_summary(tco: DataFrame) -> DataFrame:
    return tco.select(
        "run_id", "tier", "axis", "lever", "tier_name", "first_pass_accuracy", "eventual_accuracy",
        "n_correct", "n_questions", "bytes_scanned", "sql_statements", "bytes_per_correct", "agent_units",
        "warehouse_units", "total_cost_usd", "cost_per_correct_usd", "above_quality_floor",
    ).orderBy(F.desc("first_pass_accuracy"), "bytes_scanned", "run_id", "tier")


def question_matrix(answers: DataFrame) -> DataFrame:
    """The latest attempt of every question, as the per-question matrix shows it."""
    return latest_attempts(answers).select(
        *ANSWER_KEY,
        F.coalesce("is_first_pass_correct", "correct").alias("first_pass"),
        "correct",
        "failure_type",
        "status",
    ).orderBy(*ANSWER_KEY)


def latest_run(answers: DataFrame) -> DataFrame:
    """The run that started last."""
    started = answers.groupBy("run_id").agg(F.min("started_at").alias("started_at"))
    return started.orderBy(F.desc("started_at"), "run_id").limit(1)

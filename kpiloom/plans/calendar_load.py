"""The fiscal calendar against what the facts put on it."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kpiloom.functions.calendar import Period, fiscal_anchors
from kpiloom.operators.aggregates import money_sum
from kpiloom.plans.kpis import NET
from kpiloom.sources.star import Star

FLAGS = (
    "is_last_fiscal_month",
    "is_last_fiscal_quarter",
    "is_current_fiscal_year",
    "is_current_fytd",
    "is_current_fiscal_q1",
    "is_current_fiscal_q2",
    "is_spike_window",
)


def calendar_load(star: Star, events: DataFrame) -> DataFrame:
    """Every calendar day with the orders, lines and events that fall on it."""

    def per_day(frame: DataFrame, key: str, name: str) -> DataFrame:
        return frame.groupBy(F.col(key).alias("date_key")).agg(F.count(F.lit(1)).alias(name))

    days = star.dim_date().drop("calendar_date")
    counts = {
        "n_orders": per_day(star.fact_order(), "order_date_key", "n_orders"),
        "n_lines": per_day(star.lines("recognition_date_key"), "recognition_date_key", "n_lines"),
        "n_events": per_day(events, "event_date_key", "n_events"),
    }
    for frame in counts.values():
        days = days.join(frame, "date_key", "left")
    return days.fillna(0, list(counts))


def anchors_of_order_days(star: Star, order_days: DataFrame) -> DataFrame:
    """The fiscal anchor of each day that has orders."""
    anchors = fiscal_anchors(order_days, star.dim_date())
    return anchors.withColumn("as_of", F.date_format("as_of", "yyyy-MM-dd"))


def revenue_by_flags(star: Star, as_of: date, spike: Period) -> DataFrame:
    """Revenue under every combination of relative-period flags."""
    daily = star.fulfilled("recognition_date_key", NET).groupBy("recognition_date_key").agg(
        F.count(F.lit(1)).alias("n"), F.sum(NET).alias(NET)
    )
    dates = star.calendar.dim_date_flagged(star.spark, as_of, spike)
    flagged = daily.join(F.broadcast(dates), F.col("recognition_date_key") == F.col("date_key"))
    return flagged.groupBy(*FLAGS).agg(F.sum("n").alias("n_lines"), money_sum(NET).alias("revenue"))

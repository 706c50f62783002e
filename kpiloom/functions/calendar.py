"""The 4-4-5 fiscal calendar.

A fiscal year has 52 weeks, laid out as four quarters of 4 + 4 + 5 weeks, and
begins on the Monday on or before the first of February of the calendar's
first year. There is no leap week, so later years drift against the Gregorian
one. Fiscal fields follow from the day number alone, which gives two views of
the same calendar: a ``dim_date`` frame to join, and literal date bounds for a
period, which Spark can push into a parquet scan.
"""

from __future__ import annotations

import calendar as gregorian
from dataclasses import dataclass
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Weeks per fiscal month.
MONTH_WEEKS = (4, 4, 5, 4, 4, 5, 4, 4, 5, 4, 4, 5)
WEEKS_PER_YEAR = sum(MONTH_WEEKS)
WEEKS_PER_QUARTER = WEEKS_PER_YEAR // 4


def add_months(day: date, months: int) -> date:
    """Shift by calendar months, clipping to the month's last day."""
    index = day.year * 12 + day.month - 1 + months
    year, month = divmod(index, 12)
    last = gregorian.monthrange(year, month + 1)[1]
    return date(year, month + 1, min(day.day, last))


@dataclass(frozen=True)
class Period:
    """A fiscal year, quarter or month."""

    year: int
    quarter: int | None = None
    month: int | None = None


@dataclass(frozen=True)
class Anchor:
    """The periods that "current" and "last" mean on one day.

    The last month (quarter) is the one holding the day one (three) calendar
    months earlier. It is a lookup, not ``month - 1``: near period borders the
    two differ, and the lookup is the contract.
    """

    current: Period
    last_month: Period
    last_quarter: Period


@dataclass(frozen=True)
class FiscalCalendar:
    start: date
    end: date

    def __post_init__(self) -> None:
        if self.start.weekday() != 0:
            raise ValueError("a fiscal calendar starts on a Monday")

    @classmethod
    def from_year(cls, first_year: int, end: date) -> FiscalCalendar:
        first = date(first_year, 2, 1)
        return cls(first - timedelta(days=first.weekday()), end)

    @property
    def n_days(self) -> int:
        return (self.end - self.start).days + 1

    # -- literal side ------------------------------------------------------

    def key_of(self, day: date) -> int:
        return (day - self.start).days + 1

    def locate(self, day: date) -> Period | None:
        """The fiscal month holding ``day``; None outside the calendar."""
        if not self.start <= day <= self.end:
            return None
        year, week = divmod((day - self.start).days // 7, WEEKS_PER_YEAR)
        month = 1
        for weeks in MONTH_WEEKS:
            if week < weeks:
                break
            week -= weeks
            month += 1
        return Period(self.start.year + year, (month - 1) // 3 + 1, month)

    def bounds(self, period: Period) -> tuple[date, date] | None:
        """First and last day of a period, clipped to the calendar."""
        if period.month is not None:
            skip, weeks = sum(MONTH_WEEKS[: period.month - 1]), MONTH_WEEKS[period.month - 1]
        elif period.quarter is not None:
            skip, weeks = WEEKS_PER_QUARTER * (period.quarter - 1), WEEKS_PER_QUARTER
        else:
            skip, weeks = 0, WEEKS_PER_YEAR
        week = (period.year - self.start.year) * WEEKS_PER_YEAR + skip
        first = max(self.start + timedelta(weeks=week), self.start)
        last = min(self.start + timedelta(weeks=week + weeks, days=-1), self.end)
        return (first, last) if first <= last else None

    def anchor(self, as_of: date) -> Anchor | None:
        current = self.locate(as_of)
        month = self.locate(add_months(as_of, -1))
        quarter = self.locate(add_months(as_of, -3))
        if current is None or month is None or quarter is None:
            return None
        return Anchor(current, month, Period(quarter.year, quarter.quarter))

    # -- DataFrame side ----------------------------------------------------

    def anchor_row(self, spark: SparkSession, as_of: date) -> DataFrame:
        """The anchor of one day as a row; empty outside the calendar."""
        a = self.anchor(as_of)
        if a is None:
            return self.anchor_row(spark, self.end).where(F.lit(False))
        values = {
            "current_fy": a.current.year,
            "current_fm": a.current.month,
            "current_fq": a.current.quarter,
            "last_fm_year": a.last_month.year,
            "last_fm_month": a.last_month.month,
            "last_fm_quarter": a.last_month.quarter,
            "last_fq_year": a.last_quarter.year,
            "last_fq": a.last_quarter.quarter,
        }
        return spark.range(1).select(*(F.lit(v).alias(n) for n, v in values.items()))

    def date_key(self, day: Column) -> Column:
        return (F.datediff(day, F.lit(self.start)) + 1).cast("int")

    def dim_date(self, spark: SparkSession) -> DataFrame:
        """One row per day. Its size is fixed by the calendar's own span."""
        day = F.date_add(F.lit(self.start), F.col("id").cast("int"))
        weeks = spark.range(0, self.n_days, 1, 1).selectExpr("id", "id div 7 AS week")
        quarters = weeks.selectExpr(
            "id",
            f"{self.start.year} + week div {WEEKS_PER_YEAR} AS year",
            f"week % {WEEKS_PER_YEAR} div {WEEKS_PER_QUARTER} AS quarter",
            f"week % {WEEKS_PER_QUARTER} AS week",
        )
        month = "3 * quarter + CASE WHEN week < 4 THEN 1 WHEN week < 8 THEN 2 ELSE 3 END"
        return quarters.select(
            (F.col("id") + 1).cast("int").alias("date_key"),
            day.alias("calendar_date"),
            F.col("year").cast("int").alias("fiscal_year"),
            F.expr(month).cast("int").alias("fiscal_month"),
            (F.col("quarter") + 1).cast("int").alias("fiscal_quarter"),
            F.weekofyear(day).alias("iso_week"),
            F.date_format(day, "yyyy-MM-dd").alias("date_label"),
        )

    def dim_date_flagged(
        self,
        spark: SparkSession,
        as_of: date,
        spike: Period | None = None,
        retention: tuple[date, date] | None = None,
    ) -> DataFrame:
        """``dim_date`` with the relative-period flags of one day.

        Flags live on the dimension, so they are computed once per day rather
        than once per fact row. Outside the calendar the anchor is unknown and
        the flags are NULL, as with a left join to an empty anchor.
        """
        a = self.anchor(as_of)

        def known(flag: Column) -> Column:
            return flag if a else F.lit(None).cast("boolean")

        fy, fq, fm = F.col("fiscal_year"), F.col("fiscal_quarter"), F.col("fiscal_month")
        cur = a.current if a else Period(0, 0, 0)
        lm = a.last_month if a else cur
        lq = a.last_quarter if a else cur
        flags = {
            "is_last_fiscal_month": known((fy == lm.year) & (fm == lm.month)),
            "is_last_fiscal_quarter": known((fy == lq.year) & (fq == lq.quarter)),
            "is_current_fiscal_year": known(fy == cur.year),
            "is_current_fytd": known((fy == cur.year) & (fm <= cur.month)),
            "is_current_fiscal_q1": known((fy == cur.year) & (fq == 1)),
            "is_current_fiscal_q2": known((fy == cur.year) & (fq == 2)),
            "is_spike_window": (fy == spike.year) & (fm == spike.month) if spike else F.lit(False),
            "is_retention_window": F.col("calendar_date").between(*map(F.lit, retention))
            if retention
            else F.lit(False),
        }
        return self.dim_date(spark).withColumns(flags)


def fiscal_anchors(days: DataFrame, dim_date: DataFrame) -> DataFrame:
    """The anchor of every day in ``days.as_of``.

    Three lookups into the calendar, which is bounded by its span of days and
    therefore safe to broadcast. A day with any lookup missing has no anchor.
    """
    dates = F.broadcast(dim_date)
    fields = ("fiscal_year", "fiscal_month", "fiscal_quarter")

    def lookup(prefix: str) -> DataFrame:
        return dates.select(
            F.col("calendar_date").alias(f"{prefix}_date"),
            *(F.col(f).alias(f"{prefix}_{f}") for f in fields),
        )

    joined = (
        days.join(lookup("cur"), F.col("as_of") == F.col("cur_date"))
        .join(lookup("lm"), F.add_months("as_of", -1) == F.col("lm_date"))
        .join(lookup("lq"), F.add_months("as_of", -3) == F.col("lq_date"))
    )
    return joined.select(
        "as_of",
        F.col("cur_fiscal_year").alias("current_fy"),
        F.col("cur_fiscal_month").alias("current_fm"),
        F.col("cur_fiscal_quarter").alias("current_fq"),
        F.col("lm_fiscal_year").alias("last_fm_year"),
        F.col("lm_fiscal_month").alias("last_fm_month"),
        F.col("lm_fiscal_quarter").alias("last_fm_quarter"),
        F.col("lq_fiscal_year").alias("last_fq_year"),
        F.col("lq_fiscal_quarter").alias("last_fq"),
    )

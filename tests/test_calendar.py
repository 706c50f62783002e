from datetime import date, timedelta

import pytest

from kpiloom.functions.calendar import MONTH_WEEKS, FiscalCalendar, Period, add_months, fiscal_anchors


def walked(calendar):
    """The calendar by counting weeks one day at a time."""
    year, month, left = calendar.start.year, 1, MONTH_WEEKS[0] * 7
    day = calendar.start
    while day <= calendar.end:
        yield day, year, (month - 1) // 3 + 1, month
        day, left = day + timedelta(days=1), left - 1
        if left == 0:
            month += 1
            if month > 12:
                year, month = year + 1, 1
            left = MONTH_WEEKS[month - 1] * 7


@pytest.mark.parametrize("first_year", [1994, 2019, 2021, 2023, 2024])
def test_closed_form_equals_a_walk(spark, first_year):
    calendar = FiscalCalendar.from_year(first_year, date(first_year + 6, 3, 5))
    assert calendar.start.weekday() == 0 and calendar.start <= date(first_year, 2, 1)
    rows = calendar.dim_date(spark).orderBy("date_key").collect()
    expected = list(walked(calendar))
    assert [r.date_key for r in rows] == list(range(1, len(expected) + 1))
    got = [(r.calendar_date, r.fiscal_year, r.fiscal_quarter, r.fiscal_month) for r in rows]
    assert got == expected
    for day, year, quarter, month in expected[::17]:
        assert calendar.locate(day) == Period(year, quarter, month)
    assert all(r.iso_week == r.calendar_date.isocalendar()[1] for r in rows)
    assert all(r.date_label == r.calendar_date.isoformat() for r in rows)


def test_known_fiscal_month():
    calendar = FiscalCalendar.from_year(2023, date(2026, 7, 1))
    assert calendar.bounds(Period(2025, month=6)) == (date(2025, 6, 23), date(2025, 7, 27))


def test_bounds_hold_exactly_the_days_of_a_period():
    calendar = FiscalCalendar.from_year(1994, date(1997, 1, 15))
    days = list(walked(calendar))
    for period in {Period(y, month=m) for _, y, _, m in days} | {Period(y, q) for _, y, q, _ in days}:
        inside = [
            d for d, y, q, m in days
            if y == period.year and period.month in (None, m) and period.quarter in (None, q)
        ]
        assert calendar.bounds(period) == (inside[0], inside[-1])
    assert calendar.bounds(Period(1990)) is None


def test_month_shift_clips_to_the_last_day():
    assert add_months(date(2024, 3, 31), -1) == date(2024, 2, 29)
    assert add_months(date(2024, 1, 15), -1) == date(2023, 12, 15)


def test_last_month_is_a_lookup_not_a_subtraction():
    calendar = FiscalCalendar.from_year(2023, date(2026, 1, 1))
    shifts = set()
    for i in range(400, 900):
        day = calendar.start + timedelta(days=i)
        anchor = calendar.anchor(day)
        now, last = anchor.current, anchor.last_month
        shifts.add((now.year * 12 + now.month) - (last.year * 12 + last.month))
    assert shifts == {0, 1, 2}


def test_anchor_frame_equals_the_literal_anchor(spark):
    calendar = FiscalCalendar.from_year(2023, date(2025, 1, 1))
    days = [(calendar.start + timedelta(days=i),) for i in range(0, 700, 13)]
    frame = fiscal_anchors(spark.createDataFrame(days, "as_of date"), calendar.dim_date(spark))
    rows = {r.as_of: r for r in frame.collect()}
    for (day,) in days:
        anchor = calendar.anchor(day)
        if anchor is None:
            assert day not in rows
            continue
        r = rows[day]
        assert (r.current_fy, r.current_fm, r.current_fq) == (
            anchor.current.year, anchor.current.month, anchor.current.quarter)
        assert (r.last_fm_year, r.last_fm_month) == (anchor.last_month.year, anchor.last_month.month)
        assert (r.last_fq_year, r.last_fq) == (anchor.last_quarter.year, anchor.last_quarter.quarter)


def test_flags_are_unknown_outside_the_calendar(spark):
    calendar = FiscalCalendar.from_year(2023, date(2023, 12, 31))
    flagged = calendar.dim_date_flagged(spark, date(2030, 1, 1))
    assert flagged.where("is_last_fiscal_month IS NOT NULL").isEmpty()

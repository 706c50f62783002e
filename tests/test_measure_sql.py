"""Statements over metric views against the same questions in Python."""

import pytest

from kpiloom.catalog import SETTINGS
from kpiloom.plans import measure_sql, metric_views


@pytest.fixture()
def ask(spark, star):
    views = {name: lambda view=view: view(star, SETTINGS) for name, view in metric_views.VIEWS.items()}
    return lambda text: measure_sql.ask(spark, views, text)


@pytest.fixture()
def rich(star):
    return metric_views.sales_rich(star, SETTINGS)


def rows(frame):
    return [tuple(r) for r in frame.collect()]


def test_statement_is_the_question(ask, rich, plan):
    text = """SELECT `Region`, MEASURE(`Recognized Revenue`) AS r FROM a.b.sales_rich
              WHERE `Is Last Fiscal Quarter` GROUP BY `Region` ORDER BY r DESC"""
    want = rich.query(["Region"], ["revenue"], ["Is Last Fiscal Quarter"], ["-Recognized Revenue"])
    assert ask(text).columns == ["Region", "r"] and rows(ask(text)) == rows(want) != []
    assert "GreaterThanOrEqual(l_shipdate" in plan(ask(text))


def test_names_go_by_synonyms_and_any_case(ask, rich):
    want = rich.query(["Region Code"], ["Recognized Revenue"], ["Is Current FYTD"])
    got = ask("SELECT `geo code`, measure(SALES) FROM sales_rich WHERE ytd GROUP BY ALL")
    assert got.columns == ["Region Code", "measure(Recognized Revenue)"] and sorted(rows(got)) == sorted(rows(want))


def test_predicates_keep_their_literals(ask, rich):
    """A dimension's name inside a text literal is not the dimension."""
    want = rich.query(["Region"], ["revenue"], ["`Region` <> 'Region' AND `Region Code` IN ('EUROPE', 'ASIA')"])
    got = ask("SELECT Region, MEASURE(revenue) FROM sales_rich WHERE Region <> 'Region' AND `Region Code` IN ('EUROPE', 'ASIA') GROUP BY Region")
    assert sorted(rows(got)) == sorted(rows(want)) != []
    assert not rows(ask("SELECT Region, MEASURE(revenue) FROM sales_rich WHERE Region = 'it''s Region' GROUP BY 1"))


def test_ungrouped_unselected_and_ordered(ask, rich):
    by_region = {r.region: (r.recognized_revenue, r.order_line_count) for r in rich.query(["Region"], ["revenue", "Order Line Count"]).collect()}
    got = rows(ask("SELECT MEASURE(revenue) FROM sales_rich GROUP BY Region ORDER BY MEASURE(`Order Line Count`) DESC, Region LIMIT 2"))
    assert got == [(by_region[r][0],) for r in sorted(by_region, key=lambda r: (-by_region[r][1], r))[:2]]
    assert sorted(rows(ask("SELECT Region FROM sales_rich GROUP BY Region"))) == sorted((r,) for r in by_region)


def test_having_reads_measures_aliases_and_dimensions(ask):
    base = "SELECT `Fiscal Year` AS y, MEASURE(revenue) AS r FROM sales_rich GROUP BY 1"
    every = rows(ask(base))
    middle = sorted(r for _, r in every)[len(every) // 2]
    want = sorted(x for x in every if x[1] > middle and x[0] < 2001)
    assert sorted(rows(ask(f"{base} HAVING r > {middle} AND `Fiscal Year` < 2001"))) == want != []
    assert sorted(rows(ask(f"{base} HAVING MEASURE(`Recognized Revenue`) > {middle} AND y < 2001"))) == want


def test_order_places_nulls(ask):
    text = "SELECT `Fiscal Year` % 3 AS k, MEASURE(`Hardware Revenue`) / NULLIF(MEASURE(`Order Line Count`) - 7, 0) AS v FROM sales_rich GROUP BY 1 ORDER BY {}"
    assert rows(ask(text.format("k DESC"))) == rows(ask(text.format("1 ASC")))[::-1]


@pytest.mark.parametrize(
    "text, message",
    [
        ("SELECT Region, MEASURE(revenue) FROM sales_rich", "GROUP BY"),
        ("SELECT Region, MEASURE(revenue) FROM sales_rich GROUP BY `Fiscal Year`", "not grouped by"),
        ("SELECT MEASURE(revenue + 1) FROM sales_rich", "one measure"),
        ("SELECT MEASURE(profit) FROM sales_rich", "profit"),
        ("SELECT MEASURE(revenue) FROM nothing", "nothing"),
        ("SELECT MEASURE(a.revenue) FROM sales_rich a JOIN sales_basic b", "Join"),
        ("SELECT MEASURE(revenue) FROM sales_rich GROUP BY MEASURE(revenue)", "dimensions"),
    ],
)
def test_what_cannot_be_asked_says_so(ask, text, message):
    with pytest.raises((KeyError, ValueError), match=message):
        ask(text)

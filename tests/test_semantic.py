import pytest

from kpiloom import catalog
from kpiloom.catalog import SETTINGS
from kpiloom.plans import metric_views
from kpiloom.plans.semantic import Measure, MetricView, relationship_report


@pytest.fixture()
def rich(star):
    return metric_views.sales_rich(star, SETTINGS)


def test_names_resolve_by_synonym_and_case(rich):
    assert rich.dimension("GEO").name == "Region"
    assert rich.measure("net revenue").name == "Recognized Revenue"
    with pytest.raises(KeyError):
        rich.measure("profit")


def test_view_sizes(star):
    views = {
        metric_views.sales_basic: (9, 3),
        metric_views.sales_rich: (22, 7),
        metric_views.membership: (17, 10),
        metric_views.conformed: (25, 9),
        metric_views.conformed_wide: (13, 11),
        metric_views.sales_windowed: (22, 9),
    }
    for build, (dimensions, measures) in views.items():
        view = build(star, SETTINGS)
        assert (len(view.dimensions), len(view.measures)) == (dimensions, measures), view.name


def test_only_needed_tables_are_scanned(rich, plan):
    text = plan(rich.query(["Region"], ["Recognized Revenue"], ["Is Last Fiscal Quarter"]))
    assert "supplier.parquet" in text and "nation.parquet" in text
    for unused in ("part.parquet", "customer.parquet", "orders.parquet"):
        assert unused not in text


def test_flag_filter_becomes_a_pushed_date_range(rich, plan):
    text = plan(rich.query([], ["Recognized Revenue"], ["Is Last Fiscal Month"]))
    assert "GreaterThanOrEqual(l_shipdate" in text and "LessThan(l_shipdate" in text
    assert "Join" not in text


def test_flag_by_expression_equals_flag_by_span(rich):
    by_span = rich.query([], ["Recognized Revenue", "Order Line Count"], ["fytd"]).collect()
    by_expr = rich.query([], ["Recognized Revenue", "Order Line Count"], ["`Is Current FYTD` = true"]).collect()
    assert by_span == by_expr


def test_distinct_counts_do_not_expand_rows(star, plan):
    view = metric_views.membership(star, SETTINGS)
    text = plan(view.query(["Campaign Code"], ["Churn Rate", "Retention Window Churn Rate", "New Activations"]))
    assert "Expand" not in text


def test_large_dimension_joins_after_the_fold(rich, plan):
    lines = plan(rich.query(["Member Tier"], ["Recognized Revenue"])).splitlines()
    depth = {name: min(i for i, line in enumerate(lines) if name in line) for name in ("customer.parquet", "Aggregate")}
    joins = [i for i, line in enumerate(lines) if "Join" in line]
    folds = [i for i, line in enumerate(lines) if "HashAggregate" in line]
    assert any(fold > joins[0] for fold in folds), depth


def test_format_is_column_metadata(rich):
    schema = rich.query([], ["Recognized Revenue"]).schema
    assert schema["recognized_revenue"].metadata["format"] == "currency:USD"


def test_columns_carry_display_names_and_comments(rich):
    schema = rich.query(["Fiscal Year"], ["Recognized Revenue"]).schema
    assert schema["fiscal_year"].metadata == {"display_name": "Fiscal Year", "comment": "4-4-5 fiscal year, not the calendar's"}
    assert schema["recognized_revenue"].metadata["display_name"] == "Recognized Revenue"
    said = {(r["kind"], r["name"]): r for r in rich.described()}
    assert len(said) == len(rich.dimensions) + len(rich.measures)
    assert "revenue" in said["measure", "Recognized Revenue"]["synonyms"]
    assert said["dimension", "Country Code"]["display_name"] == "Country Code"


def test_two_counted_columns_do_not_expand_rows(rich, star, plan):
    text = plan(rich.query(["Region"], ["Distinct Members", "Distinct Orders", "Recognized Revenue"]))
    assert "Expand" not in text


def test_cyclic_measures_are_rejected(rich):
    view = MetricView("v", rich.source, (), (
        Measure("a", "composed", "MEASURE(`b`) + 1"), Measure("b", "composed", "MEASURE(`a`) + 1")))
    with pytest.raises(ValueError, match="composed of itself"):
        view.query(measures=["a"])


def test_attached_measure(rich):
    extended = rich.extended(measures=[Measure("Units", "sum", "source.qty", "source.qty > 10")])
    row = extended.query([], ["Units", "Order Line Count"]).first()
    assert 0 < row.units


def test_distinct_count_beside_windows_is_the_plain_count(star):
    view = metric_views.sales_windowed(star, SETTINGS)
    where = ["`Fiscal Month Start` < DATE '2000-03-01'", "Is Current Fiscal Year"]
    both = view.query(["Region"], ["Current Month Revenue", "Distinct Members"], where).collect()
    alone = view.query(["Region"], ["Distinct Members"], where).collect()
    assert {(r.region, r.distinct_members) for r in both} == {tuple(r) for r in alone} != set()


def test_members_so_far_end_at_all_members(star):
    """Counted where first seen, without keeping anyone's days."""
    view = catalog._windowed_members(star, SETTINGS)
    far = view.query(["Product Class"], ["Members So Far", "Distinct Members"]).collect()
    assert far and all(r.members_so_far == r.distinct_members for r in far)
    months = view.query(["Fiscal Month Start"], ["Members So Far"]).orderBy("fiscal_month_start").collect()
    assert [r.members_so_far for r in months] == sorted(r.members_so_far for r in months)


def test_windowed_month_keeps_its_prior_when_filtered(star):
    view = metric_views.sales_windowed(star, SETTINGS)
    months = view.query(["Fiscal Month Start"], ["Current Month Revenue"]).collect()
    values = {r.fiscal_month_start.isoformat(): r.current_month_revenue for r in months}
    row = view.query(["Fiscal Month Start"], ["Prior Month Revenue"],
                     ["`Fiscal Month Start` = DATE '2000-03-01'"]).first()
    assert row.prior_month_revenue == values["2000-02-01"]


def test_relationship_report_finds_duplicates(spark):
    frame = spark.createDataFrame([(1,), (2,), (2,), (2,)], "k long")
    row = relationship_report({"t": (frame, "k")}).first()
    assert (row.n_rows, row.n_keys, row.most_matches, row.violations) == (4, 2, 3, 1)


def test_many_sums_are_not_folded_for_every_member(star, plan):
    wide = metric_views.conformed_wide(star, SETTINGS)
    text = plan(wide.query(["Product Family"], [m.name for m in wide.measures]))
    folds = [line for line in text.splitlines() if "HashAggregate" in line and "member" in line.split("functions=")[0]]
    assert folds and not any("sum(" in line for line in folds)

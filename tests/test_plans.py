"""What every plan must keep at scale, read off the physical plans."""

import pytest

from kpiloom import catalog
from kpiloom.plans import kpis
from kpiloom.sources.projections import PROJECTIONS, write_projections
from kpiloom.sources.sinks import write_gold
from kpiloom.sources.star import GoldStar

LAZY = {k: q for k, q in catalog.queries().items() if k not in catalog.ingest_queries()}


@pytest.mark.parametrize("name", sorted(LAZY))
def test_no_pair_joins_and_no_python(name, spark, sf_dir, plan):
    text = plan(LAZY[name](spark, sf_dir))
    for banned in ("CartesianProduct", "PythonUDF", "MapInPandas", "FlatMapGroupsInPandas"):
        assert banned not in text
    # The SKU function left-joins its one argument row to at most one product.
    assert "BroadcastNestedLoopJoin" not in text or name == "fn_revenue_for_sku"


def test_month_revenue_reads_three_columns_of_one_month_from_gold(spark, star, tmp_path, plan):
    """Gold holds one line per key, so the span of days reaches its scan."""
    write_gold(star.fact_order_line(), "fact_order_line", str(tmp_path / "fact_order_line"))
    gold = GoldStar(spark, str(tmp_path), star.calendar)
    text = plan(kpis.revenue_last_fiscal_month(gold, catalog.SETTINGS.as_of))
    first, last = (star.calendar.key_of(d) for d in kpis.last_fiscal_month(gold, catalog.SETTINGS.as_of))
    assert f"GreaterThanOrEqual(recognition_date_key,{first})" in text
    assert f"LessThanOrEqual(recognition_date_key,{last})" in text
    schema = text[text.index("ReadSchema") :]
    assert "product_key" not in schema and "order_key" not in schema and "Window" not in text


def test_copies_of_a_line_meet_once_per_task(star, plan):
    text = plan(star.settled_lines())
    assert "WindowGroupLimit" in text and "l_tax" not in text


@pytest.mark.parametrize("name", ["q01_revenue_last_fiscal_month", "q07_spike_attribution", "mv_window_fytd"])
def test_questions_rank_no_lines(name, spark, sf_dir, plan):
    text = plan(LAZY[name](spark, sf_dir))
    assert "WindowGroupLimit" not in text and "l_tax" not in text


def test_a_month_prunes_lines_of_other_days(star, plan):
    text = plan(kpis.revenue_last_fiscal_month(star, catalog.SETTINGS.as_of))
    assert "GreaterThanOrEqual(l_shipdate" in text and "LessThan(l_shipdate" in text


def test_lines_are_settled_anew_when_the_source_changes(spark, star, sf_dir, tmp_path):
    """Whatever is delivered later counts, and a reread reuses what was settled."""
    from kpiloom.sources.star import LINE_COLUMNS, LINE_ORDER, RetailStar
    from kpiloom.operators.joins import first_per_key

    raw = star.raw("lineitem")
    for table in ("orders", "supplier"):
        star.raw(table).write.parquet(str(tmp_path / f"{table}.parquet"))
    target = str(tmp_path / "lineitem.parquet")
    raw.where("l_orderkey % 2 = 0").write.parquet(target)
    own = RetailStar(spark, str(tmp_path))
    seen = []
    for _ in range(2):
        bronze = own.bronze_lines(*LINE_COLUMNS)
        want = first_per_key(bronze, ["order_line_key"], *LINE_ORDER)
        got = own.lines(*LINE_COLUMNS)
        assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)
        files, again = ({f for f in frame.inputFiles() if "/settled/" in f} for frame in (got, own.lines("order_key")))
        assert files and files == again
        seen.append(files)
        raw.where("l_orderkey % 2 = 1").write.mode("append").parquet(target)
    assert not seen[0] & seen[1]


def test_ranking_is_a_top_k(spark, sf_dir, plan):
    assert "TakeOrderedAndProject" in plan(LAZY["q03_top_members_hardware"](spark, sf_dir))


def test_family_filter_prunes_the_other_fact(star, plan):
    from kpiloom.plans import metric_views

    view = metric_views.conformed(star, catalog.SETTINGS)
    text = plan(view.query(["Campaign Code"], ["Churn Rate"], ["`Fact Family` = 'subscription'"]))
    assert "events.parquet" in text and "lineitem.parquet" not in text


def test_all_copies_are_written(spark, star, tmp_path):
    write_projections(star, str(tmp_path))
    assert len(PROJECTIONS) == 15
    for name in PROJECTIONS:
        assert spark.read.parquet(str(tmp_path / f"distractor_{name}")).count() > 0


def test_shared_folder_follows_the_session(spark):
    from kpiloom.session import SHARED_DIR_KEY, shared_dir

    assert shared_dir(spark, "x").startswith(spark.conf.get(SHARED_DIR_KEY))

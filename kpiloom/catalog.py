"""Every registered query by name."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from datetime import date, datetime
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kpiloom.functions import snippets, table_functions
from kpiloom.functions.calendar import FiscalCalendar, Period
from kpiloom.functions.snippets import Question
from kpiloom.functions.table_functions import KpiSettings
from kpiloom.functions.text_rules import parsed_messages
from kpiloom.operators.aggregates import money_sum
from kpiloom.plans import calendar_load, costs, kpis, measure_sql, metric_views, rollups, scoring, stored_rollups, wide
from kpiloom.plans.costs import Span
from kpiloom.plans.stored_rollups import Rollup
from kpiloom.plans.semantic import Measure, MetricView, WindowOver, relationship_report
from kpiloom.session import TASK_BYTES, shared_dir, small_tasks
from kpiloom.sources import answers as logs
from kpiloom.sources import files, projections, sinks
from kpiloom.sources.generator import Generator, Signals, sample_returns
from kpiloom.sources.sinks import write_gold
from kpiloom.sources.star import GoldStar, RetailStar
from kpiloom.streaming.medallion import Medallion, quality_report

Query = Callable[[SparkSession, str], DataFrame]

SETTINGS = KpiSettings(
    as_of=date(2000, 11, 15),
    subscriptions_as_of=date(2024, 1, 30),
    active_days=7,
    home_region="EUROPE",
    spike=Period(2000, 2, 6),
    retention=(date(2024, 1, 8), date(2024, 1, 21)),
)


def on_star(plan: Callable[..., DataFrame], *args, **kwargs) -> Query:
    return lambda spark, root: plan(RetailStar(spark, root), *args, **kwargs)


def _order_days(star: RetailStar) -> DataFrame:
    return star.raw("orders").groupBy(F.col("o_orderdate").cast("date").alias("as_of")).agg(
        F.count(F.lit(1)).alias("n_orders")
    )


def _anchors(star: RetailStar) -> DataFrame:
    days = _order_days(star)
    anchors = calendar_load.anchors_of_order_days(star, days.select("as_of"))
    return anchors.join(days.withColumn("as_of", F.date_format("as_of", "yyyy-MM-dd")), "as_of")


def _fn(name: str, *args: str) -> Query:
    def run(spark: SparkSession, root: str) -> DataFrame:
        table_functions.register(RetailStar(spark, root), SETTINGS, name)
        marks = ", ".join("?" for _ in args)
        return spark.sql(f"SELECT * FROM {name}({marks})", args=list(args))

    return run


def statement(text: str, as_of: date | None = None) -> Query:
    """An SQL statement over the metric views as a registered query; ``as_of``
    moves the day that relative periods are seen from."""
    settings = replace(SETTINGS, as_of=as_of) if as_of else SETTINGS

    def run(spark: SparkSession, root: str) -> DataFrame:
        star = RetailStar(spark, root)
        views = {name: partial(view, star, settings) for name, view in metric_views.VIEWS.items()}
        return presented(measure_sql.ask(spark, views, text))

    return run


def calendar_queries() -> dict[str, Query]:
    s = SETTINGS
    return {
        "fiscal_calendar": on_star(lambda star: calendar_load.calendar_load(star, star.bronze_subscription_event())),
        "fiscal_anchor": on_star(_anchors),
        "fiscal_flags": on_star(calendar_load.revenue_by_flags, s.as_of, s.spike),
    }


def kpi_queries() -> dict[str, Query]:
    s = SETTINGS
    spike = (s.spike.year, s.spike.month)
    return {
        "q01_revenue_last_fiscal_month": on_star(kpis.revenue_last_fiscal_month, s.as_of),
        "q02_revenue_by_region_last_quarter": on_star(kpis.revenue_by_region_last_quarter, s.as_of),
        "q03_top_members_hardware": on_star(kpis.top_members_by_hardware_revenue, s.as_of),
        "q04_business_health": on_star(kpis.business_health, s.as_of, s.subscriptions_as_of),
        "q05_active_members_in_region": on_star(kpis.active_members, s.active_rule, s.home_region),
        "q06_quarter_revenue_by_family": on_star(kpis.quarter_revenue_by_family, s.as_of),
        "q07_spike_attribution": on_star(kpis.spike_attribution, *spike),
        "q08_campaign_churn": on_star(kpis.campaign_churn, s.retention),
        "q09_revenue_unknown_sku": on_star(kpis.revenue_for_sku, "ZX-NOEXIST-999"),
        "spike_attribution_all": on_star(kpis.spike_attribution, *spike, limit=None),
        "campaign_churn_all": on_star(kpis.campaign_churn, s.retention, limit=None),
        "param_revenue_by_region": on_star(kpis.revenue_for_region, s.home_region),
        "param_revenue_by_period": on_star(kpis.revenue_for_period, *spike),
        "param_members_by_region": on_star(kpis.members_in_region, s.home_region),
        "fn_revenue_last_fiscal_month": _fn("fn_recognized_revenue_last_fiscal_month"),
        "fn_revenue_by_region_last_quarter": _fn("fn_recognized_revenue_by_region_last_fq"),
        "fn_top_members_hardware": _fn("fn_top_members_hardware_fytd"),
        "fn_business_health": _fn("fn_business_health_kpi_pack"),
        "fn_active_members_in_region": _fn("fn_active_members_in_region_fy"),
        "fn_quarter_revenue_by_family": _fn("fn_q1_vs_q2_revenue_by_family"),
        "fn_spike_attribution": _fn("fn_revenue_spike_attribution"),
        "fn_campaign_churn": _fn("fn_campaigns_churn_reduction"),
        "fn_revenue_for_sku": _fn("fn_recognized_revenue_for_sku", "SKU-000007"),
    }


def presented(frame: DataFrame) -> DataFrame:
    """Decimals as doubles and dates as text, for comparing across engines."""
    columns = []
    for field in frame.schema.fields:
        kind, column = field.dataType.simpleString(), F.col(field.name)
        if kind.startswith("decimal"):
            column = column.cast("double")
        elif kind == "date":
            column = F.date_format(column, "yyyy-MM-dd")
        elif kind.startswith("timestamp"):
            column = F.date_format(column, "yyyy-MM-dd HH:mm:ss")
        columns.append(column.alias(field.name))
    return frame.select(*columns)


def ask(view: Callable[..., MetricView], *args, **question) -> Query:
    """A question to a metric view as a registered query."""

    def run(spark: SparkSession, root: str) -> DataFrame:
        built = view(RetailStar(spark, root), SETTINGS, *args)
        return presented(built.query(**question))

    return run


def _relationships(star: RetailStar) -> DataFrame:
    keys = {
        "dim_geo": "geo_key",
        "dim_product": "product_key",
        "dim_campaign": "campaign_key",
        "dim_member": "member_key",
        "fact_order": "order_key",
    }
    checks = {name: (star.table(name).select(key), key) for name, key in keys.items()}
    checks["fact_order_line"] = (star.lines("order_line_key"), "order_line_key")
    return relationship_report(checks)


def _windowed_members(star: RetailStar, settings: KpiSettings) -> MetricView:
    """The windowed view with distinct counts along its windows."""
    month, day, year = "Fiscal Month Start", "Calendar Date", "Fiscal Year"
    member, hardware = "source.member_key", "dim_product.product_class IN ('DEVICE', 'ACCESSORY')"
    so_far, this_year = (WindowOver(month, cumulative=True),), (WindowOver(day, cumulative=True), WindowOver(year))
    return metric_views.sales_windowed(star, settings).extended(measures=[
        Measure("Members", "distinct", member, window=(WindowOver(month),)),
        Measure("Prior Members", "distinct", member, window=(WindowOver(month, offset_months=-1),)),
        Measure("Members So Far", "distinct", member, window=so_far),
        Measure("Hardware Members So Far", "distinct", member, hardware, window=so_far),
        Measure("Members This Year So Far", "distinct", member, window=this_year),
        Measure("Orders This Year So Far", "distinct", "source.order_key", window=this_year),
    ])


def statement_queries() -> dict[str, Query]:
    """Questions put to the metric views as SQL text."""
    subscriptions = SETTINGS.subscriptions_as_of
    return {
        "sql_last_month": statement("SELECT MEASURE(`Recognized Revenue`) FROM sales_rich WHERE `Is Last Fiscal Month`"),
        "sql_quarter_by_region": statement("""
            SELECT `Region`, MEASURE(`Recognized Revenue`) AS recognized_revenue
            FROM sales_rich WHERE `Is Last Fiscal Quarter`
            GROUP BY `Region` ORDER BY recognized_revenue DESC"""),
        "sql_active_members": statement("""
            SELECT MEASURE(`Active Members`) FROM metrics.conformed
            WHERE `Region Code` = 'EUROPE' AND `Is Current Fiscal Year`""", subscriptions),
        "sql_window_churn": statement("""
            SELECT `Campaign Code`, MEASURE(`Churn Rate`) AS churn_rate FROM conformed
            WHERE `Is Retention Push Window` AND `Fact Family` = 'subscription'
            GROUP BY `Campaign Code` ORDER BY churn_rate ASC LIMIT 10""", subscriptions),
        "sql_top_members": statement("""
            SELECT `Member ID`, MEASURE(`Hardware Revenue`) AS hw FROM sales_rich WHERE `Is Current FYTD`
            GROUP BY `Member ID` ORDER BY hw DESC LIMIT 10"""),
        "sql_wide_last_month": statement("SELECT MEASURE(`Last Fiscal Month Revenue`) FROM conformed_wide"),
        "sql_windowed_flag": statement("SELECT MEASURE(`Last Fiscal Month Revenue Flag`) FROM sales_windowed"),
        "sql_membership_churn": statement("""
            SELECT MEASURE(`Churn Rate`) FROM membership WHERE `Is Retention Push Window`"""),
        "sql_expressions": statement("""
            SELECT lower(region) AS market, `Fiscal Year` % 2 AS parity, fy,
                   MEASURE(revenue) / MEASURE(`Order Line Count`) AS per_line, MEASURE(buyers)
            FROM sales_basic WHERE `Product Class` IN ('DEVICE', 'ACCESSORY') AND NOT `Member Tier` = 'BUILDING'
            GROUP BY lower(region), 2, fy
            HAVING MEASURE(`Order Line Count`) > 3 AND fy > 1994
            ORDER BY per_line DESC NULLS LAST, market"""),
        "sql_windowed_months": statement("""
            SELECT `Fiscal Month Start` AS month, MEASURE(`Prior Month Revenue`) AS prior,
                   MEASURE(`Distinct Members`) AS members
            FROM sales_windowed WHERE `Fiscal Month Start` >= DATE '2000-03-01' GROUP BY ALL"""),
    }


def view_queries() -> dict[str, Query]:
    s = SETTINGS
    every = {
        "basic": ["Recognized Revenue", "Order Line Count", "Distinct Members"],
        "membership": [
            "New Activations", "Cancellations", "Touched Members", "Churn Rate", "Ending MRR",
            "Retention Window Cancellations", "Retention Window Touched", "Retention Window Churn Rate",
            "Active Members Approx", "Subscription Event Count",
        ],
        "conformed": [
            "Recognized Revenue", "Hardware Revenue", "Ending MRR", "Cancellations", "Touched Members",
            "Churn Rate", "Active Members", "Distinct Members", "Order Line Count",
        ],
        "wide": [
            "Recognized Revenue", "Hardware Revenue", "Hardware FYTD Revenue", "Last Fiscal Month Revenue",
            "Last Fiscal Quarter Revenue", "FYTD Recognized Revenue", "Q1 Recognized Revenue",
            "Q2 Recognized Revenue", "Spike Revenue", "Order Line Count", "Distinct Members",
        ],
    }
    rich = [
        "Recognized Revenue", "Gross Line Amount", "Hardware Revenue", "Order Line Count",
        "Distinct Members", "Distinct Orders", "Avg Recognized Revenue per Member",
    ]
    monthly = ["Current Month Revenue", "Prior Month Revenue", "MoM Revenue Growth"]
    region = "`Region Code` = 'EUROPE'"
    views = metric_views
    return {
        "wide_members": on_star(lambda star: presented(wide.wide_members(star, s))),
        "wide_orders": on_star(lambda star: presented(wide.wide_orders(star, s))),
        "wide_subs": on_star(lambda star: presented(wide.wide_subscriptions(star, s))),
        "active_members_exact": on_star(lambda star: wide.active_flags(star, s)),
        "relationship_contract": on_star(_relationships),
        "mv_basic_by_family": ask(views.sales_basic, dimensions=["Product Family"], measures=every["basic"]),
        "mv_basic_by_tier_and_year": ask(
            views.sales_basic, dimensions=["Member Tier", "Fiscal Year"], measures=every["basic"]
        ),
        "mv_rich_by_region": ask(
            views.sales_rich, dimensions=["Region"], measures=rich, where=["Is Last Fiscal Quarter"],
            order_by=["-Recognized Revenue"],
        ),
        "mv_rich_avg_per_member": ask(
            views.sales_rich, dimensions=["Member Tier"],
            measures=["Avg Recognized Revenue per Member", "Distinct Members"], where=["fytd"],
        ),
        "mv_rich_top_members": ask(
            views.sales_rich, dimensions=["Member ID"], measures=["Hardware Revenue"], where=["Is Current FYTD"],
            order_by=["-Hardware Revenue"], limit=10,
        ),
        "mv_rich_by_flag": ask(
            views.sales_rich, dimensions=["Is Current Fiscal Q1", "Is Current Fiscal Q2", "Product Class"],
            measures=["revenue", "Order Line Count"], where=["Is Current Fiscal Year", region],
        ),
        "mv_membership_churn": ask(views.membership, dimensions=["Campaign Code"], measures=every["membership"]),
        "mv_membership_by_region": ask(
            views.membership, dimensions=["Region", "Member Tier"], measures=every["membership"],
            where=["Is Current FYTD"],
        ),
        "mv_membership_window_churn": ask(
            views.membership, dimensions=["Campaign Code"], measures=["Churn Rate"],
            where=["Is Retention Push Window"], order_by=["Churn Rate"],
        ),
        "mv_conformed_union": ask(
            views.conformed, dimensions=["Fact Family", "Campaign Code"], measures=every["conformed"]
        ),
        "mv_conformed_by_region": ask(
            views.conformed, s.subscriptions_as_of, dimensions=["Region", "Is Current Fiscal Year"],
            measures=every["conformed"],
        ),
        "mv_conformed_active": ask(
            views.conformed, s.subscriptions_as_of, measures=["Active Members"],
            where=[region, "Is Current Fiscal Year"],
        ),
        "mv_wide_periods": ask(views.conformed_wide, dimensions=["Product Family"], measures=every["wide"]),
        "mv_window_current_and_prior": ask(
            views.sales_windowed, dimensions=["Product Class", "Fiscal Month Start"], measures=monthly
        ),
        "mv_window_mom_last": ask(views.sales_windowed, dimensions=["Region"], measures=monthly),
        "mv_window_prior_of_one_month": ask(
            views.sales_windowed, dimensions=["Fiscal Month Start"], measures=monthly,
            where=["`Fiscal Month Start` = DATE '2000-03-01'"],
        ),
        "mv_window_fytd": ask(
            views.sales_windowed, dimensions=["Region", "Fiscal Year"],
            measures=["FYTD Window Revenue", "Recognized Revenue"],
        ),
        "mv_window_fytd_daily": ask(
            views.sales_windowed, dimensions=["Calendar Date", "Fiscal Year"], measures=["FYTD Window Revenue"],
            where=["`Fiscal Year` = 2000"],
        ),
        "mv_window_distinct_beside": ask(
            views.sales_windowed, dimensions=["Region"],
            measures=["Distinct Members", "Current Month Revenue", "FYTD Window Revenue", "Order Line Count"],
        ),
        "mv_window_distinct_along": ask(
            _windowed_members, dimensions=["Product Class", "Fiscal Month Start"],
            measures=["Members", "Prior Members", "Members So Far", "Hardware Members So Far", "Current Month Revenue"],
        ),
        "mv_window_distinct_fytd": ask(
            _windowed_members, dimensions=["Region", "Fiscal Year"],
            measures=["Members This Year So Far", "Orders This Year So Far", "Distinct Members", "FYTD Window Revenue"],
        ),
        "mv_window_distinct_daily": ask(
            _windowed_members, dimensions=["Calendar Date", "Fiscal Year"],
            measures=["Members This Year So Far", "Recognized Revenue"],
            where=["`Fiscal Year` = 2000", "`Calendar Date` >= DATE '2000-03-01'"],
        ),
        "mv_window_last_month_flag": ask(
            views.sales_windowed, dimensions=["Region"],
            measures=["Last Fiscal Month Revenue Flag", "Hardware Revenue", "Order Line Count"],
        ),
    }


def _tier_costs(star: RetailStar) -> DataFrame:
    answered = logs.answers(star)
    shares = costs.attribute_by_share(answered, logs.billing_usage(star), logs.list_prices(star))
    return costs.tier_costs(answered, shares)


def _tco(star: RetailStar) -> DataFrame:
    return rollups.metric_tco(logs.answers(star), _tier_costs(star), logs.dim_tier(star))


def _on_logs(plan: Callable[[DataFrame], DataFrame]) -> Query:
    return on_star(lambda star: presented(plan(logs.answers(star))))


def _on_tco(plan: Callable[[DataFrame], DataFrame]) -> Query:
    return on_star(lambda star: presented(plan(_tco(star))))


def _updated_in_place(answered: DataFrame) -> DataFrame:
    """The answer table written, scored where it lies, and read back."""
    spark = answered.sparkSession
    path = shared_dir(spark, "scored-answers")
    sinks.append_runs(answered, path)
    scoring.update_scores(spark, path)
    return _presented_scores(sinks.read_runs(spark, path))


def _updated(answered: DataFrame) -> DataFrame:
    return _presented_scores(scoring.with_scores(answered, scoring.evaluated(answered)))


def _presented_scores(updated: DataFrame) -> DataFrame:
    return updated.select(
        "message_id", "run_id", "tier", "question_id", "attempt", "answer_score",
        F.coalesce("correct", F.lit(False)).alias("correct"),
        F.coalesce("failure_type", F.lit("")).alias("failure_type"),
        F.coalesce(F.col("is_first_pass_correct").cast("int"), F.lit(-1)).alias("first_pass"),
    )


def scoring_queries() -> dict[str, Query]:
    s = SETTINGS
    return {
        "message_parse": on_star(
            lambda star: parsed_messages(logs.messages(star)).select(
                "message_id", "status", "sql_text", "text_response", "clarification_asked"
            )
        ),
        "latest_attempt": _on_logs(
            lambda a: scoring.latest_attempts(a).select(*scoring.ANSWER_KEY, "attempt", "message_id", "status")
        ),
        "failure_classes": _on_logs(lambda a: scoring.classified(a).select("message_id", "failure_type").fillna("correct")),
        "rubric_scores": _on_logs(
            lambda a: scoring.rubric_scores(a).select("message_id", "question_id", "correct", "answer_score")
        ),
        "update_scores": _on_logs(_updated),
        "update_scores_in_place": _on_logs(_updated_in_place),
        "tier_accuracy": _on_logs(lambda a: scoring.tier_accuracy(scoring.evaluated(a))),
        "contamination_gate": _on_tco(scoring.contamination_gate),
        "dedup_order_lines": on_star(
            lambda star: presented(
                star.ranked_lines("order_line_key", "product_key", "campaign_key", "net_recognized_amount")
            )
        ),
        "result_normalized": on_star(scoring.normalized_answers),
        "result_diff": on_star(scoring.region_diff),
        "result_diff_scalar": on_star(scoring.scalar_diff),
        "result_diff_top_n": on_star(scoring.ranking_diff),
        "result_diff_pivot": on_star(scoring.quarter_pivot_diff),
        "result_diff_inferred": on_star(scoring.inferred_region_diff),
        "result_diff_inferred_quarters": on_star(scoring.inferred_quarter_diff),
        "zero_or_empty": on_star(scoring.idle_skus, s),
        "mv_vs_golden": on_star(scoring.views_against_golden, s),
    }


WINDOW = Span(datetime(2024, 1, 8, 0, 30), datetime(2024, 1, 21, 12, 15))
SPACES = [f"space_{i}" for i in range(10)]
WAREHOUSES = ["wh_0", "wh_1", "wh_3"]


def _on_billing(plan: Callable[..., DataFrame], *args) -> Query:
    return on_star(lambda star: presented(plan(logs.billing_usage(star), logs.list_prices(star), *args)))


def _attributed(plan: Callable[..., DataFrame]) -> Query:
    return on_star(lambda star: plan(logs.answers(star), logs.billing_usage(star), logs.list_prices(star)))


def cost_queries() -> dict[str, Query]:
    return {
        "bill_window": _on_logs(costs.bill_windows),
        "billing_by_sp": _on_billing(costs.billing_by_principal, WINDOW),
        "billing_by_some_sp": _on_billing(costs.billing_by_principal, WINDOW, ["sp_1", "sp_3", "sp_4"]),
        "bill_window_fallback": _on_logs(_windows_with_fallback),
        "warehouse_billing": _on_billing(costs.warehouse_billing, WINDOW, WAREHOUSES),
        "hourly_rate": _on_billing(costs.hourly_rate, "Medium", datetime(2024, 1, 10), WAREHOUSES),
        "hourly_rate_fallback": _on_billing(costs.hourly_rate, "Large", datetime(2030, 1, 1), WAREHOUSES),
        "query_history_profile": on_star(
            lambda star: costs.query_history_profile(logs.query_history(star), WINDOW, SPACES)
        ),
        "audit_by_space": on_star(lambda star: costs.audit_by_space(logs.audit_log(star), WINDOW, SPACES)),
        "token_usage": on_star(lambda star: presented(costs.token_usage(logs.gateway_usage(star), WINDOW))),
        "cost_single_run": _attributed(costs.attribute_by_window),
        "cost_prorated": _attributed(costs.attribute_by_share),
        "fact_tier_cost": on_star(_tier_costs),
    }


def rollup_queries() -> dict[str, Query]:
    return {
        "metric_tco": _on_tco(rollups.tco_ranked),
        "metric_tco_by_axis": _on_tco(rollups.tco_by_axis),
        "tco_above_floor": _on_tco(rollups.tco_above_floor),
        "run_summary": _on_tco(rollups.run_summary),
        "leaderboard_per_correct": _on_tco(rollups.leaderboard_per_correct),
        "leaderboard_per_answer": _on_tco(lambda t: rollups.leaderboard_per_answer(rollups.run_costs_per_answer(t))),
        "leaderboard_run_costs": _on_tco(rollups.run_costs_per_answer),
        "answer_preview": _on_logs(
            lambda a: rollups.answer_preview(scoring.classified(a), logs.decode_sql(F.col("generated_sql")))
        ),
        "run_matrix": _on_logs(lambda a: rollups.question_matrix(scoring.classified(a))),
        "latest_run": _on_logs(rollups.latest_run),
    }


# -- ingest, sinks, generator ------------------------------------------------------


def _bytes(star: RetailStar, table: str) -> int:
    return files.size(star.spark, f"{star.root}/{table}.parquet")


def _delivered_twice(star: RetailStar, lake: Medallion, name: str, frame: DataFrame, dedup: str) -> DataFrame:
    """A table through the medallion after its files landed twice."""
    with small_tasks(star.spark, _bytes(star, "lineitem")):
        lake.land(frame, name)
        lake.land(frame, name)
    return lake.build(name, dedup)


def _land_in_four(star: RetailStar, lake: Medallion, name: str, rows: DataFrame, source: str) -> None:
    """At least four files; rows that are few are shuffled for it."""
    size = _bytes(star, source)
    with small_tasks(star.spark, size):
        lake.land(rows.coalesce(4) if size > 4 * TASK_BYTES else rows.repartition(4), name)


def _silver(name: str, table: Callable[[RetailStar], DataFrame], dedup: str) -> Query:
    def run(spark: SparkSession, root: str) -> DataFrame:
        star, lake = RetailStar(spark, root), Medallion(spark, shared_dir(spark, "medallion"))
        return presented(_delivered_twice(star, lake, name, table(star), dedup))

    return run


def _revenue_from_gold(spark: SparkSession, root: str) -> DataFrame:
    star, lake = RetailStar(spark, root), Medallion(spark, shared_dir(spark, "medallion"))
    for name in ("dim_geo", "fact_order_line"):
        with small_tasks(spark, _bytes(star, "lineitem")):
            lake.land(star.table("bronze_order_line" if name == "fact_order_line" else name), name)
        lake.build(name)
    gold = GoldStar(spark, f"{lake.root}/gold", star.calendar)
    return kpis.revenue_by_region_last_quarter(gold, SETTINGS.as_of)


def _expectations(star: RetailStar) -> DataFrame:
    report = quality_report(star.bronze_subscription_event(), "fact_subscription_event")
    report = report.unionByName(quality_report(star.bronze_order_line(), "fact_order_line"))
    for name in ("dim_product", "fact_order"):
        report = report.unionByName(quality_report(star.table(name), name))
    return report


def _clustered_roundtrip(spark: SparkSession, root: str) -> DataFrame:
    """Order lines through the clustered layout, read back for one month."""
    star, path = RetailStar(spark, root), shared_dir(spark, "clustered")
    write_gold(star.fact_order_line(), "fact_order_line", f"{path}/fact_order_line", size=_bytes(star, "lineitem"))
    gold = GoldStar(spark, path, star.calendar)
    return kpis.revenue_last_fiscal_month(gold, SETTINGS.as_of)


def _curve_roundtrip(spark: SparkSession, root: str) -> DataFrame:
    """Order lines along a curve through day, product and member, read back for
    some products of all days."""
    star, path = RetailStar(spark, root), shared_dir(spark, "curve-gold")
    size = _bytes(star, "lineitem")
    write_gold(star.fact_order_line(), "fact_order_line", f"{path}/fact_order_line", layout="curve", size=size)
    lines = GoldStar(spark, path, star.calendar).lines("product_key", "line_status", kpis.NET)
    some = lines.where(F.col("product_key").between(100, 150) & (F.col("line_status") == "FULFILLED"))
    return presented(some.groupBy("product_key").agg(F.count(F.lit(1)).alias("n_lines"), money_sum(kpis.NET).alias("revenue")))


def _replaced_runs(spark: SparkSession, root: str) -> DataFrame:
    """Costs by window, then the runs with a failed answer costed by share."""
    star, path = RetailStar(spark, root), shared_dir(spark, "tier-cost")
    answered, usage, prices = logs.answers(star), logs.billing_usage(star), logs.list_prices(star)
    columns = ["run_id", "tier", "run_as_sp", "agent_units", "agent_cost_usd"]
    sinks.replace_runs(costs.attribute_by_window(answered, usage, prices).select(*columns), path)
    failed = answered.where(F.col("status") == "TIMEOUT").select("run_id").distinct()
    shares = costs.attribute_by_share(answered, usage, prices).join(failed, "run_id", "left_semi")
    sinks.replace_runs(shares.select(*columns), path)
    return sinks.read_runs(spark, path)


def _appended_runs(spark: SparkSession, root: str) -> DataFrame:
    """The answer log appended in two parts and read back."""
    star, path = RetailStar(spark, root), shared_dir(spark, "answers")
    answered = logs.answers(star).select("run_id", "tier", "question_id", "attempt", "message_id", "status")
    early = F.col("attempt") == 0
    sinks.append_runs(answered.where(early), path)
    sinks.append_runs(answered.where(~early), path)
    return sinks.read_runs(spark, path)


def _dates_as_text(spark: SparkSession, root: str) -> DataFrame:
    """The calendar delivered as text in two parts, the second with a further column
    and with rows whose key is no number: silver has the declared types."""
    star, lake = RetailStar(spark, root), Medallion(spark, shared_dir(spark, "medallion"))
    dates = star.dim_date()
    text = dates.select(*(F.col(c).cast("string").alias(c) for c in dates.columns))
    lake.land(text.where("date_key % 2 = 0"), "dim_date")
    lake.build("dim_date")
    text = text.where("date_key % 2 = 1")
    bad = text.withColumn("date_key", F.concat(F.lit("day "), "date_key"))
    days = _order_days(star).select(F.date_format("as_of", "yyyy-MM-dd").alias("label"), F.col("n_orders").cast("string"))
    wider = text.unionByName(bad).join(days, F.col("date_label") == F.col("label"), "left").drop("label")
    lake.land(wider, "dim_date")
    return presented(lake.build("dim_date"))


def _counted_in_stream(spark: SparkSession, root: str) -> DataFrame:
    """Rows that broke an expectation, counted while they streamed by in more
    batches than a query's progress history holds."""
    star, lake = RetailStar(spark, root), Medallion(spark, shared_dir(spark, "medallion"))
    history, most = "spark.sql.streaming.numRecentProgressUpdates", Medallion.MAX_BYTES
    before = spark.conf.get(history)
    spark.conf.set(history, "2")
    try:
        counts = {}
        # An order without a price has no measure.
        priced = F.when(F.col("order_key") % 50 != 0, F.col("net_recognized_amount"))
        for name, source, rows in (
            ("fact_subscription_event", "events", star.bronze_subscription_event()),
            ("fact_order_line", "lineitem", star.bronze_order_line().withColumn("net_recognized_amount", priced)),
        ):
            _land_in_four(star, lake, name, rows, source)
            lake.MAX_BYTES = 1
            lake.ingest(name)
            lake.refine(name)
            counts[name] = lake.broken(name)
    finally:
        lake.MAX_BYTES = most
        spark.conf.set(history, before)
    rows = [(table, of["n_rows"], rule, n) for table, of in counts.items() for rule, n in of.items() if rule != "n_rows"]
    return spark.createDataFrame(rows, "table_name string, n_rows long, expectation string, n_dropped long")


def _windows_with_fallback(answered: DataFrame) -> DataFrame:
    """Bill windows where runs whose number ends in 5 kept no times."""
    timed = ~F.col("run_id").endswith("5")
    kept = answered.withColumns({c: F.when(timed, F.col(c)) for c in ("started_at", "finished_at")})
    return costs.bill_windows(kept, datetime(2024, 1, 25, 10, 20))


def _stored_sales(*keys: str) -> Query:
    """Sales stored by region, class and fiscal month, answered by some of these."""
    stored_by = ("region_name", "product_class", "fiscal_year", "fiscal_month")

    def run(spark: SparkSession, root: str) -> DataFrame:
        star = RetailStar(spark, root)
        lines = star.fulfilled("geo_key", "product_key", "recognition_date_key", "member_key", "order_key", kpis.NET)
        days = F.broadcast(star.dim_date().select("date_key", "fiscal_year", "fiscal_month"))
        facts = lines.join(days, F.col("recognition_date_key") == F.col("date_key"), "left")
        facts = facts.join(star.dim_geo().select("geo_key", "region_name"), "geo_key", "left")
        facts = facts.join(star.dim_product().select("product_key", "product_class"), "product_key", "left")
        rollup = Rollup(shared_dir(spark, "sales-rollup"), stored_by, (kpis.NET,), ("member_key", "order_key"))
        rollup.write(facts, _bytes(star, "lineitem"))
        return presented(rollup.read(spark, keys))

    return run


def _stored_latencies(spark: SparkSession, root: str) -> DataFrame:
    """Median and 95th percentile per tier from sketches stored per run and tier,
    and whether their exact ranks are within the sketches' error."""
    answered, path = logs.answers(RetailStar(spark, root)), shared_dir(spark, "latency-sketches")
    fractions = {"p50": 0.5, "p95": 0.95}
    stored_rollups.write_latencies(answered, path)
    estimates = stored_rollups.latency_percentiles(spark.read.parquet(path), ["tier"], fractions).drop("n_questions")
    questions = answered.groupBy(*scoring.ANSWER_KEY).agg(F.max("latency_ms").alias("latency_ms"))
    questions = questions.where(F.col("latency_ms").isNotNull())
    return stored_rollups.within_rank(estimates, questions, ["tier"], fractions)


def ingest_queries() -> dict[str, Query]:
    return {
        "rollup_sales_by_region": _stored_sales("region_name"),
        "rollup_sales_by_class_and_year": _stored_sales("product_class", "fiscal_year"),
        "rollup_sales_total": _stored_sales(),
        "rollup_latency_percentiles": _stored_latencies,
        "stream_silver_products": _silver("dim_product", lambda star: star.dim_product(), "batch"),
        "stream_silver_campaigns": _silver("dim_campaign", lambda star: star.dim_campaign(), "stateful"),
        "stream_silver_members": _silver("dim_member", lambda star: star.dim_member(), "batch"),
        "stream_silver_geos": _silver("dim_geo", lambda star: star.dim_geo(), "watermark"),
        "stream_silver_dates": _dates_as_text,
        "stream_expectation_counts": _counted_in_stream,
        "stream_silver_orders": _silver("fact_order", lambda star: star.fact_order(), "batch"),
        "stream_silver_subscriptions": _silver(
            "fact_subscription_event", lambda star: star.bronze_subscription_event(), "stateful"
        ),
        "stream_silver_usage": _silver("fact_usage_event", lambda star: star.fact_usage_event(), "batch"),
        "stream_silver_order_lines": _silver("fact_order_line", lambda star: star.bronze_order_line(), "batch"),
        "medallion_revenue_by_region": _revenue_from_gold,
        "expectations_report": on_star(_expectations),
        "clustered_write_roundtrip": _clustered_roundtrip,
        "clustered_curve_roundtrip": _curve_roundtrip,
        "replace_by_run": _replaced_runs,
        "append_answers": _appended_runs,
    }


def _gregorian_revenue(star: RetailStar) -> DataFrame:
    """Revenue as the Gregorian look-alike of the calendar would report it."""
    daily = star.fulfilled("recognition_date_key", kpis.NET).groupBy("recognition_date_key").agg(
        F.sum(kpis.NET).alias(kpis.NET)
    )
    dates = F.broadcast(projections.fiscal_alt(star))
    joined = daily.join(dates, F.col("recognition_date_key") == F.col("date_key"))
    return joined.groupBy("fiscal_year", "fiscal_quarter", "fiscal_month").agg(
        money_sum(kpis.NET).alias("revenue")
    )


def _converted_revenue(star: RetailStar) -> DataFrame:
    """Revenue at each day's rate."""
    daily = star.fulfilled("recognition_date_key", kpis.NET).groupBy("recognition_date_key").agg(
        F.sum(kpis.NET).alias(kpis.NET)
    )
    rates = F.broadcast(projections.fx_rates(star))
    joined = daily.join(rates, F.col("recognition_date_key") == F.col("date_key"))
    return joined.groupBy("ccy").agg(
        money_sum(kpis.NET).alias("revenue"), F.count(F.lit(1)).alias("n_days"), F.max("rate").alias("rate")
    )


def copy_queries() -> dict[str, Query]:
    by_calendar = ("fx_rates", "fiscal_alt")
    copies = {
        f"copy_{name}": on_star(lambda star, plan=plan: presented(plan(star)))
        for name, plan in projections.PROJECTIONS.items()
        if name not in by_calendar
    }
    return {
        **copies,
        "copy_fiscal_alt_revenue": on_star(_gregorian_revenue),
        "copy_fx_rates_revenue": on_star(_converted_revenue),
    }


GENERATOR = Generator(
    calendar=FiscalCalendar.from_year(2023, date(2026, 2, 28)),
    signals=Signals(launch=Period(2025, 2, 6)),
    n_members=5000,
    n_geos=25,
    n_products=500,
    n_campaigns=50,
)


def _generated(build: Callable[[Generator, DataFrame], DataFrame], table: str, **keys: str) -> Query:
    """A generated table with one row per row of ``table``."""

    def run(spark: SparkSession, root: str) -> DataFrame:
        rows = RetailStar(spark, root).raw(table)
        return presented(build(GENERATOR, rows.select(*(F.expr(e).alias(n) for n, e in keys.items()))))

    return run


def generator_queries() -> dict[str, Query]:
    line = {"order_line_key": "l_orderkey * 10 + l_linenumber", "order_key": "l_orderkey"}
    return {
        "gen_geos": _generated(Generator.geo, "nation", geo_key="n_nationkey + 1"),
        "gen_products": _generated(Generator.product, "part", product_key="p_partkey + 1"),
        "gen_campaigns": _generated(Generator.campaign, "supplier", campaign_key="s_suppkey + 1"),
        "gen_members": _generated(Generator.member, "customer", member_key="c_custkey"),
        "gen_orders": _generated(Generator.order, "orders", order_key="o_orderkey"),
        "gen_lines": _generated(Generator.order_line, "lineitem", **line),
        "gen_subscriptions": _generated(
            Generator.subscription_event, "events", subscription_event_key="event_id"
        ),
        "gen_usage": _generated(Generator.usage_event, "events", usage_event_key="event_id"),
        "gen_returns": _generated(lambda g, rows: sample_returns(g.order_line(rows)), "lineitem", **line),
    }


def snippet_queries() -> dict[str, Query]:
    questions = {
        "snippet_last_month_by_family": Question(
            ("recognized_revenue", "hardware_revenue"), ("fulfilled", "last_fiscal_month"), ("product_family",)
        ),
        "snippet_region_last_quarter": Question(
            ("recognized_revenue",), ("fulfilled", "last_fiscal_quarter", "home_region"), ("fiscal_month",)
        ),
        "snippet_spike": Question(("recognized_revenue",), ("fulfilled", "spike_window"), ("product_family",)),
        "snippet_churn": Question(("churn_rate", "ending_mrr"), ("current_fytd", "retention_window"), ("fiscal_year",)),
        "snippet_active_members": Question(("active_members",)),
    }
    return {name: on_star(snippets.ask, SETTINGS, question) for name, question in questions.items()}


def queries() -> dict[str, Query]:
    return {
        **calendar_queries(),
        **kpi_queries(),
        **view_queries(),
        **statement_queries(),
        **snippet_queries(),
        **scoring_queries(),
        **cost_queries(),
        **rollup_queries(),
        **ingest_queries(),
        **copy_queries(),
        **generator_queries(),
    }

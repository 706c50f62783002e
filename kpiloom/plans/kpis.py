"""The KPI queries.

Each takes the star and an ``as_of`` day: nothing reads the clock. A fiscal
period is a span of days, so it becomes literal bounds on the fact's own date
column instead of a join, and the scan skips what lies outside. Facts are
aggregated on their foreign key before the dimension is joined whenever the
dimension may be large, so a hot key is combined map-side and never travels.
Every top-k has a key as tiebreak.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kpiloom.functions.calendar import Period
from kpiloom.operators.aggregates import distinct_by_flag, money, money_sum, safe_ratio, when_sum
from kpiloom.sources.star import ACTIVE_EVENTS, HARDWARE_CLASSES, Bounds, Star

NET = "net_recognized_amount"
#: An empty span: no row satisfies it, so sums come out NULL and groups empty.
NOWHERE: Bounds = (date(1, 1, 2), date(1, 1, 1))


def _span(star: Star, period: Period | None) -> Bounds:
    return (period and star.calendar.bounds(period)) or NOWHERE


def last_fiscal_month(star: Star, as_of: date) -> Bounds:
    anchor = star.calendar.anchor(as_of)
    return _span(star, anchor and anchor.last_month)


def last_fiscal_quarter(star: Star, as_of: date) -> Bounds:
    anchor = star.calendar.anchor(as_of)
    return _span(star, anchor and anchor.last_quarter)


def current_fiscal_year(star: Star, as_of: date) -> Bounds:
    now = star.calendar.locate(as_of)
    return _span(star, now and Period(now.year))


# -- revenue ----------------------------------------------------------------


def revenue_last_fiscal_month(star: Star, as_of: date) -> DataFrame:
    lines = star.fulfilled(NET, recognized=last_fiscal_month(star, as_of))
    return lines.agg(money_sum(NET).alias("total_recognized_revenue"))


def revenue_by_region_last_quarter(star: Star, as_of: date) -> DataFrame:
    lines = star.fulfilled("geo_key", NET, recognized=last_fiscal_quarter(star, as_of))
    by_geo = lines.groupBy("geo_key").agg(F.sum(NET).alias(NET))
    return (
        by_geo.join(star.dim_geo().select("geo_key", "region_name"), "geo_key")
        .groupBy("region_name")
        .agg(money_sum(NET).alias("recognized_revenue"))
        .orderBy(F.desc("recognized_revenue"), "region_name")
    )


def top_members_by_hardware_revenue(star: Star, as_of: date, limit: int = 10) -> DataFrame:
    lines = star.fulfilled("product_key", "member_key", NET, recognized=current_fiscal_year(star, as_of))
    hardware = star.dim_product().where(F.col("product_class").isin(*HARDWARE_CLASSES)).select("product_key")
    by_member = lines.join(hardware, "product_key").groupBy("member_key").agg(F.sum(NET).alias(NET))
    members = star.dim_member().select("member_key", "member_id", "display_handle")
    # member_id is as unique as member_key, so there is nothing left to group.
    return (
        by_member.join(members, "member_key")
        .select("member_id", "display_handle", money(F.col(NET)).alias("hardware_revenue_fytd"))
        .orderBy(F.desc("hardware_revenue_fytd"), "member_id")
        .limit(limit)
    )


def quarter_revenue_by_family(star: Star, as_of: date) -> DataFrame:
    """First against second fiscal quarter of the current year."""
    now = star.calendar.locate(as_of)
    first = _span(star, now and Period(now.year, 1))
    second = _span(star, now and Period(now.year, 2))
    both = (first[0], max(first[1], second[1]))
    lines = star.fulfilled("product_key", "recognition_date_key", NET, recognized=both)
    in_first = F.col("recognition_date_key") <= star.calendar.key_of(first[1])
    by_product = lines.groupBy("product_key").agg(
        when_sum(in_first, F.col(NET)).alias("q1"), when_sum(~in_first, F.col(NET)).alias("q2")
    )
    return (
        by_product.join(star.dim_product().select("product_key", "product_family"), "product_key")
        .groupBy("product_family")
        .agg(money_sum("q1").alias("q1_revenue"), money_sum("q2").alias("q2_revenue"))
        .orderBy("product_family")
    )


def spike_attribution(star: Star, fiscal_year: int, fiscal_month: int, limit: int | None = 20) -> DataFrame:
    """Which products and campaigns made one fiscal month's revenue.

    Orders are counted once per (product, campaign): folding to one row per
    order first keeps the distinct count a plain count.
    """
    period = Period(fiscal_year, month=fiscal_month)
    lines = star.fulfilled("product_key", "campaign_key", "order_key", NET, recognized=_span(star, period))
    per_order = lines.groupBy("product_key", "campaign_key", "order_key").agg(F.sum(NET).alias(NET))
    per_pair = per_order.groupBy("product_key", "campaign_key").agg(
        F.sum(NET).alias(NET), F.count("order_key").alias("order_count")
    )
    named = per_pair.join(
        star.dim_product().select("product_key", "product_family", "sku_code"), "product_key"
    ).join(star.dim_campaign().select("campaign_key", "campaign_code", "campaign_name"), "campaign_key")
    ranked = named.select(
        "product_family",
        "sku_code",
        "campaign_code",
        "campaign_name",
        F.lit(fiscal_year).alias("fiscal_year"),
        F.lit(fiscal_month).alias("fiscal_month"),
        money(F.col(NET)).alias("recognized_revenue"),
        "order_count",
    ).orderBy(F.desc("recognized_revenue"), "sku_code", "campaign_code")
    return ranked.limit(limit) if limit else ranked


def revenue_for_sku(star: Star, sku: str) -> DataFrame:
    """One row for any SKU; 0 for one nobody sells."""
    product = star.dim_product().where(F.col("sku_code") == sku).select("product_key")
    total = star.fulfilled("product_key", NET).join(product, "product_key").agg(F.sum(NET).alias(NET))
    return total.select(F.lit(sku).alias("sku_code"), _or_zero(F.col(NET)).alias("recognized_revenue"))


def revenue_for_region(star: Star, region_code: str) -> DataFrame:
    return star.spark.sql(
        """
        SELECT CAST(ROUND(SUM(l.net_recognized_amount), 2) AS DOUBLE) AS recognized_revenue
        FROM {lines} l JOIN {geo} g ON l.geo_key = g.geo_key
        WHERE g.region_code = :region_code
        """,
        args={"region_code": region_code},
        lines=star.fulfilled("geo_key", NET),
        geo=star.dim_geo(),
    )


def revenue_for_period(star: Star, fiscal_year: int, fiscal_month: int) -> DataFrame:
    span = _span(star, Period(fiscal_year, month=fiscal_month))
    return star.spark.sql(
        """
        SELECT CAST(ROUND(SUM(l.net_recognized_amount), 2) AS DOUBLE) AS recognized_revenue
        FROM {lines} l JOIN {dates} d ON l.recognition_date_key = d.date_key
        WHERE d.fiscal_year = :fiscal_year AND d.fiscal_month = :fiscal_month
        """,
        args={"fiscal_year": fiscal_year, "fiscal_month": fiscal_month},
        lines=star.fulfilled("recognition_date_key", NET, recognized=span),
        dates=star.dim_date(),
    )


def _or_zero(total: Column) -> Column:
    return F.coalesce(money(total), F.lit(0.0))


# -- subscriptions ------------------------------------------------------------


@dataclass(frozen=True)
class ActiveRule:
    """Who is an active member on a day.

    Exact: activated or renewed within ``days`` and not cancelled on or after
    the last such event, over the current fiscal year's events only.
    """

    as_of: date
    days: int = 90

    @property
    def since(self) -> date:
        return self.as_of - timedelta(days=self.days)


def last_subscription_days(star: Star, rule: ActiveRule) -> DataFrame:
    """Per member: the last active and the last cancel day of the fiscal year."""
    events = star.subscriptions(happened=current_fiscal_year(star, rule.as_of))
    kind, day = F.col("event_type"), F.col("event_date_key")
    return events.groupBy("member_key").agg(
        F.max(F.when(kind.isin(*ACTIVE_EVENTS), day)).alias("last_active_key"),
        F.max(F.when(kind == "CANCEL", day)).alias("last_cancel_key"),
    )


def is_active(star: Star, rule: ActiveRule) -> Column:
    active, cancel = F.col("last_active_key"), F.col("last_cancel_key")
    recent = active >= star.calendar.key_of(rule.since)
    return recent & (cancel.isNull() | (cancel < active))


def active_members(star: Star, rule: ActiveRule, region_code: str) -> DataFrame:
    active = last_subscription_days(star, rule).where(is_active(star, rule))
    geo = star.dim_geo().where(F.col("region_code") == region_code).select("geo_key")
    home = star.dim_member().join(geo, F.col("home_geo_key") == F.col("geo_key")).select("member_key")
    return active.join(home, "member_key").agg(F.count(F.lit(1)).alias("active_members"))


def members_in_region(star: Star, region_code: str) -> DataFrame:
    """All members whose home is in the region, active or not."""
    return star.spark.sql(
        """
        SELECT COUNT(*) AS active_members
        FROM {members} m JOIN {geo} g ON m.home_geo_key = g.geo_key
        WHERE g.region_code = :region_code
        """,
        args={"region_code": region_code},
        members=star.dim_member(),
        geo=star.dim_geo(),
    )


def business_health(star: Star, as_of: date, subscriptions_as_of: date | None = None) -> DataFrame:
    """Revenue, MRR movement and churn of the current fiscal year, in one row."""
    lines = star.fulfilled(NET, recognized=current_fiscal_year(star, as_of))
    events = star.subscriptions(happened=current_fiscal_year(star, subscriptions_as_of or as_of))
    per_member = events.groupBy("member_key").agg(
        F.sum("mrr_delta").alias("mrr"), F.max(F.col("event_type") == "CANCEL").alias("cancelled")
    )
    health = per_member.agg(
        money_sum("mrr").alias("ending_mrr"),
        F.round(
            safe_ratio(F.count(F.when(F.col("cancelled"), F.col("member_key"))), F.count("member_key")), 4
        ).alias("churn_rate_fytd"),
    )
    revenue = lines.agg(money_sum(NET).alias("recognized_revenue_fytd"))
    # Two rows with a side each; max puts them on one line.
    sides = revenue.unionByName(health, allowMissingColumns=True)
    return sides.agg(*(F.max(c).alias(c) for c in sides.columns))


def campaign_churn(star: Star, window: Bounds, limit: int | None = 10) -> DataFrame:
    """Campaigns by churn of the members they touched, lowest first."""
    counted = distinct_by_flag(
        star.subscriptions(happened=window),
        ["attribution_campaign_key"],
        "member_key",
        {"cancels": F.col("event_type") == "CANCEL", "touched_members": F.lit(True)},
    )
    campaigns = star.dim_campaign().select("campaign_key", "campaign_code", "campaign_name")
    ranked = (
        counted.join(campaigns, F.col("attribution_campaign_key") == F.col("campaign_key"))
        .select(
            "campaign_code",
            "campaign_name",
            "cancels",
            "touched_members",
            safe_ratio(F.col("cancels"), F.col("touched_members")).alias("churn_rate"),
        )
        .orderBy("churn_rate", "campaign_code")
    )
    return ranked.limit(limit) if limit else ranked

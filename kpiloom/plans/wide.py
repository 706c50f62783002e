"""Wide helper views: facts with their period buckets worked out per row.

Each builder takes the columns a reader wants and joins only what those need.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kpiloom.functions.table_functions import KpiSettings
from kpiloom.plans.kpis import NET, is_active, last_subscription_days
from kpiloom.sources.star import HARDWARE_CLASSES, Bounds, Star


def _flagged_dates(star: Star, settings: KpiSettings, subscriptions: bool = False) -> DataFrame:
    as_of = settings.subscriptions_as_of if subscriptions else settings.as_of
    return star.calendar.dim_date_flagged(star.spark, as_of, settings.spike, settings.retention)


def active_flags(star: Star, settings: KpiSettings) -> DataFrame:
    """One row per member with events this fiscal year: are they active?"""
    rule = settings.active_rule
    active = F.coalesce(is_active(star, rule), F.lit(False))
    return last_subscription_days(star, rule).select("member_key", active.alias("is_active_member"))


def wide_members(star: Star, settings: KpiSettings) -> DataFrame:
    """The member spine with home region and the exact active flag."""
    geo = star.dim_geo().select(F.col("geo_key").alias("home_geo_key"), "region_name", "region_code")
    spine = star.dim_member().join(geo, "home_geo_key", "left")
    joined = spine.join(active_flags(star, settings), "member_key", "left")
    active = F.coalesce(F.col("is_active_member"), F.lit(False))
    return joined.withColumns({"is_active_member": active, "active_member_flag": active.cast("int")})


PRODUCT_COLUMNS = ("product_family", "product_class", "sku_code")
CAMPAIGN_COLUMNS = ("campaign_code", "campaign_name")
MEMBER_COLUMNS = ("member_id", "display_handle")
BUCKETS = {
    "last_fm_amount": "is_last_fiscal_month",
    "last_fq_amount": "is_last_fiscal_quarter",
    "fytd_amount": "is_current_fytd",
    "q1_amount": "is_current_fiscal_q1",
    "q2_amount": "is_current_fiscal_q2",
    "spike_amount": "is_spike_window",
}
PERIOD_COLUMNS = ("fiscal_year", "fiscal_month", "fiscal_quarter")
REGION_COLUMNS = {"order_region_name": "region_name", "order_region_code": "region_code"}
LINE_OWN = ("member_key", "order_line_key", "order_key", NET)

WIDE_ORDER_COLUMNS = (
    *LINE_OWN,
    *MEMBER_COLUMNS,
    "hardware_amount",
    "hardware_fytd_amount",
    *BUCKETS,
    *PERIOD_COLUMNS,
    *REGION_COLUMNS,
    *PRODUCT_COLUMNS,
    *CAMPAIGN_COLUMNS,
)


def wide_orders(
    star: Star, settings: KpiSettings, columns: list[str] | None = None, span: Bounds | None = None
) -> DataFrame:
    """Fulfilled lines with one amount column per period bucket."""
    wanted = list(columns or WIDE_ORDER_COLUMNS)
    asks = set(wanted)
    hardware = asks & {"hardware_amount", "hardware_fytd_amount"}
    dated = asks & {*BUCKETS, *PERIOD_COLUMNS, "hardware_fytd_amount"}
    parts = {
        "product_key": (star.dim_product, PRODUCT_COLUMNS, asks & {*PRODUCT_COLUMNS} or hardware),
        "campaign_key": (star.dim_campaign, CAMPAIGN_COLUMNS, asks & {*CAMPAIGN_COLUMNS}),
        "member_key": (star.dim_member, MEMBER_COLUMNS, asks & {*MEMBER_COLUMNS}),
    }
    keys = [k for k, (_, _, used) in parts.items() if used]
    keys += ["recognition_date_key"] if dated else []
    keys += ["geo_key"] if asks & {*REGION_COLUMNS} else []
    own = [c for c in LINE_OWN if c in asks]
    frame = star.fulfilled(*dict.fromkeys([*keys, *own, NET]), recognized=span)
    if dated:
        dates = _flagged_dates(star, settings).withColumnRenamed("date_key", "recognition_date_key")
        frame = frame.join(F.broadcast(dates), "recognition_date_key")
    if "geo_key" in keys:
        geo = star.dim_geo().select("geo_key", *(F.col(c).alias(n) for n, c in REGION_COLUMNS.items()))
        frame = frame.join(geo, "geo_key", "left")
    for key, (table, names, used) in parts.items():
        if used:
            frame = frame.join(table().select(key, *names), key, "left")

    amount, nothing = F.col(NET), F.lit(0).cast("decimal(18,4)")
    is_hardware = F.col("product_class").isin(*HARDWARE_CLASSES)
    buckets = {name: F.when(F.col(flag), amount).otherwise(nothing) for name, flag in BUCKETS.items()}
    buckets["hardware_amount"] = F.when(is_hardware, amount).otherwise(nothing)
    buckets["hardware_fytd_amount"] = F.when(is_hardware & F.col("is_current_fytd"), amount).otherwise(nothing)
    return frame.select(*(buckets[c].alias(c) if c in buckets else F.col(c) for c in wanted))


def wide_subscriptions(star: Star, settings: KpiSettings) -> DataFrame:
    """Subscription events with fiscal-year and retention-window buckets."""
    dates = _flagged_dates(star, settings, subscriptions=True).select(
        F.col("date_key").alias("event_date_key"),
        "fiscal_year",
        "fiscal_month",
        "is_current_fytd",
        "is_retention_window",
    )
    campaigns = star.dim_campaign().select(
        F.col("campaign_key").alias("attribution_campaign_key"), "campaign_code", "campaign_name"
    )
    events = star.subscriptions().join(F.broadcast(dates), "event_date_key")
    events = events.join(campaigns, "attribution_campaign_key")
    cancel, window = F.col("event_type") == "CANCEL", F.col("is_retention_window")
    return events.select(
        "member_key",
        "subscription_event_key",
        "event_type",
        "mrr_delta",
        F.when(F.col("is_current_fytd"), F.col("mrr_delta")).otherwise(0).alias("fytd_mrr_delta"),
        cancel.cast("int").alias("is_cancel"),
        window.cast("int").alias("in_retention_window"),
        (cancel & window).cast("int").alias("retention_cancel"),
        "fiscal_year",
        "fiscal_month",
        "campaign_code",
        "campaign_name",
    )

"""Copies of the star under other names, grains and calendars.

The look-alike tables that make a catalog hard to read: renamed, flattened,
stubbed or re-dated projections of the real ones.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kpiloom.sources.star import Star

# Columns of each projection, by its name.
RENAMED: dict[str, tuple[str, dict[str, str]]] = {
    "orders_v1": (
        "fact_order",
        {"order_key": "id", "order_gross_amount": "amount", "order_date_key": "dt", "member_key": "cust"},
    ),
    "customers_legacy": (
        "dim_member",
        {"member_key": "customer_key", "display_handle": "name", "member_tier": "member_tier"},
    ),
    "returns_old": ("fact_return", {"return_key": "rma_id", "return_amount": "amt", "product_key": "product_key"}),
    "geo_iso": ("dim_geo", {c: c for c in ("geo_key", "country_code", "region_code")}),
    "product_catalog_ext": (
        "dim_product",
        {c: c for c in ("product_key", "sku_code", "list_price", "product_family")},
    ),
    "member_pii_shadow": ("dim_member", {c: c for c in ("member_key", "display_handle", "signup_date")}),
    "orders_v2": (
        "fact_order",
        {"order_id": "order_id", "order_gross_amount": "revenue", "order_status": "order_status",
         "ship_date_key": "ship_date_key"},
    ),
}


def _renamed(name: str) -> Callable[[Star], DataFrame]:
    table, columns = RENAMED[name]
    return lambda star: star.table(table).select(*(F.col(c).alias(n) for c, n in columns.items()))


def sales_flat(star: Star) -> DataFrame:
    return star.lines("order_line_key", "gross_amount", "order_date_key", "product_key", "member_key")


def mrr_daily(star: Star) -> DataFrame:
    return star.subscriptions().groupBy("event_date_key").agg(F.sum("mrr_delta").alias("mrr"))


def campaign_spend(star: Star) -> DataFrame:
    return star.dim_campaign().select("campaign_key", F.lit(1000.0).alias("spend_usd"), "campaign_code")


def fx_rates(star: Star) -> DataFrame:
    """One rate for each day of the calendar."""
    return star.dim_date().select("date_key", F.lit("USD").alias("ccy"), F.lit(1.0).alias("rate"))


def fiscal_alt(star: Star) -> DataFrame:
    """The Gregorian calendar posing as the fiscal one."""
    day = F.col("calendar_date")
    return star.dim_date().select(
        "date_key",
        "calendar_date",
        F.month(day).alias("fiscal_month"),
        F.quarter(day).alias("fiscal_quarter"),
        F.year(day).alias("fiscal_year"),
    )


def nps_scores(star: Star) -> DataFrame:
    return star.dim_member().select("member_key", (F.col("member_key") % 10).alias("nps"))


def support_tickets(star: Star) -> DataFrame:
    return star.dim_member().select(
        F.col("member_key").alias("ticket_member"), (F.col("member_key") % 100).alias("ticket_count")
    )


PROJECTIONS: dict[str, Callable[[Star], DataFrame]] = {
    **{name: _renamed(name) for name in RENAMED},
    "sales_flat": sales_flat,
    "mrr_daily": mrr_daily,
    "workouts_raw": lambda star: star.fact_usage_event().select("*"),
    "campaign_spend": campaign_spend,
    "fx_rates": fx_rates,
    "fiscal_alt": fiscal_alt,
    "nps_scores": nps_scores,
    "support_tickets": support_tickets,
}


def write_projections(star: Star, root: str, prefix: str = "distractor_") -> None:
    """All fifteen copies as tables."""
    for name, plan in PROJECTIONS.items():
        plan(star).write.mode("overwrite").parquet(f"{root.rstrip('/')}/{prefix}{name}")

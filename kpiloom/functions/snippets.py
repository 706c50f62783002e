"""Reusable SQL fragments: measures, filters and fields over named tables.

A question picks fragments by name; the tables they mention, and only those,
are joined. Aliases: ``ol`` order lines, ``se`` subscription events, ``le``
members with their last event days, ``d`` dates, ``g`` the line's geography,
``p`` products, ``c`` campaigns.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import DataFrame

from kpiloom.functions.table_functions import KpiSettings
from kpiloom.plans.kpis import last_subscription_days
from kpiloom.sources.star import Star

# The fragments, by the name they are asked for.
MEASURES = {
    "recognized_revenue": "CAST(SUM(ol.net_recognized_amount) AS DOUBLE)",
    "hardware_revenue": "CAST(SUM(CASE WHEN p.product_class IN ('DEVICE', 'ACCESSORY') "
    "THEN ol.net_recognized_amount ELSE 0 END) AS DOUBLE)",
    "ending_mrr": "CAST(SUM(se.mrr_delta) AS DOUBLE)",
    "churn_rate": "COUNT(DISTINCT CASE WHEN se.event_type = 'CANCEL' THEN se.member_key END) "
    "/ NULLIF(COUNT(DISTINCT se.member_key), 0)",
    "active_members": "COUNT(DISTINCT CASE WHEN le.last_active_key >= :active_since "
    "AND (le.last_cancel_key IS NULL OR le.last_cancel_key < le.last_active_key) THEN le.member_key END)",
}
FILTERS = {
    "fulfilled": "ol.line_status = 'FULFILLED'",
    "last_fiscal_month": "d.fiscal_year = (SELECT last_fm_year FROM {anchor}) "
    "AND d.fiscal_month = (SELECT last_fm_month FROM {anchor})",
    "last_fiscal_quarter": "d.fiscal_year = (SELECT last_fq_year FROM {anchor}) "
    "AND d.fiscal_quarter = (SELECT last_fq FROM {anchor})",
    "current_fytd": "d.fiscal_year = (SELECT current_fy FROM {anchor}) "
    "AND d.fiscal_month <= (SELECT current_fm FROM {anchor})",
    "retention_window": "d.calendar_date BETWEEN :retention_first AND :retention_last",
    "spike_window": "d.fiscal_year = :spike_year AND d.fiscal_month = :spike_month",
    "home_region": "g.region_code = :home_region",
}
FIELDS = {
    "fiscal_year": "d.fiscal_year",
    "fiscal_month": "d.fiscal_month",
    "product_family": "p.product_family",
}
JOINS = {
    "d": "JOIN {dates} d ON {fact}.{day} = d.date_key",
    "g": "JOIN {geo} g ON ol.geo_key = g.geo_key",
    "p": "JOIN {products} p ON ol.product_key = p.product_key",
    "c": "JOIN {campaigns} c ON {fact}.{campaign} = c.campaign_key",
}
FACTS = {
    "ol": ("{lines} ol", "recognition_date_key", "campaign_key"),
    "se": ("{events} se", "event_date_key", "attribution_campaign_key"),
    "le": ("{last_days} le", "", ""),
}


@dataclass(frozen=True)
class Question:
    measures: tuple[str, ...]
    filters: tuple[str, ...] = ()
    fields: tuple[str, ...] = ()


def ask(star: Star, settings: KpiSettings, question: Question) -> DataFrame:
    """The fragments of a question as one SQL statement."""
    fields = [f"{FIELDS[f]} AS {f}" for f in question.fields]
    measures = [f"{MEASURES[m]} AS {m}" for m in question.measures]
    filters = [FILTERS[f] for f in question.filters]
    text = " ".join(fields + measures + filters)
    used = set(re.findall(r"\b(ol|se|le|d|g|p|c)\.", text))
    (fact,) = used & set(FACTS)
    table, day, campaign = FACTS[fact]
    joins = [j.replace("{fact}", fact).replace("{day}", day).replace("{campaign}", campaign)
             for alias, j in JOINS.items() if alias in used]
    where = f"WHERE {' AND '.join(filters)}" if filters else ""
    group = f"GROUP BY {', '.join(FIELDS[f] for f in question.fields)}" if fields else ""
    statement = f"SELECT {', '.join(fields + measures)} FROM {table} {' '.join(joins)} {where} {group}"

    as_of = settings.as_of if fact == "ol" else settings.subscriptions_as_of
    line_columns = re.findall(r"\bol\.(\w+)", statement)
    tables = {
        "lines": lambda: star.lines(*dict.fromkeys(line_columns)),
        "events": star.subscriptions,
        "last_days": lambda: last_subscription_days(star, settings.active_rule),
        "dates": star.dim_date,
        "geo": star.dim_geo,
        "products": star.dim_product,
        "campaigns": star.dim_campaign,
        "anchor": lambda: star.calendar.anchor_row(star.spark, as_of),
    }
    args = {
        "active_since": star.calendar.key_of(settings.active_rule.since),
        "retention_first": settings.retention[0],
        "retention_last": settings.retention[1],
        "spike_year": settings.spike.year,
        "spike_month": settings.spike.month,
        "home_region": settings.home_region,
    }
    given = {name: value for name, value in args.items() if f":{name}" in statement}
    frames = {name: build() for name, build in tables.items() if f"{{{name}}}" in statement}
    return star.spark.sql(statement, args=given, **frames)


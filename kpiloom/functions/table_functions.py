"""SQL table functions over the KPI plans.

``register`` makes ``SELECT * FROM fn_...()`` work in a session. Each function
reads a temporary view of its plan, so Catalyst optimises through it: the SKU
argument, for one, becomes a filter on the product scan.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kpiloom.functions.calendar import Period
from kpiloom.plans import kpis
from kpiloom.sources.star import Bounds, Star


@dataclass(frozen=True)
class KpiSettings:
    """What the KPI library needs to know besides the tables."""

    as_of: date
    subscriptions_as_of: date
    active_days: int
    home_region: str
    spike: Period
    retention: Bounds

    @property
    def active_rule(self) -> kpis.ActiveRule:
        return kpis.ActiveRule(self.subscriptions_as_of, self.active_days)


def _revenue_by_sku(star: Star):
    by_product = star.fulfilled("product_key", kpis.NET).groupBy("product_key").agg(F.sum(kpis.NET).alias("revenue"))
    return by_product.join(star.dim_product().select("product_key", "sku_code"), "product_key")


def _plans(star: Star, s: KpiSettings) -> dict[str, Callable[[], DataFrame]]:
    return {
        "fn_recognized_revenue_last_fiscal_month": lambda: kpis.revenue_last_fiscal_month(star, s.as_of).select(
            F.coalesce("total_recognized_revenue", F.lit(0.0)).alias("recognized_revenue")
        ),
        "fn_recognized_revenue_by_region_last_fq": lambda: kpis.revenue_by_region_last_quarter(star, s.as_of),
        "fn_top_members_hardware_fytd": lambda: kpis.top_members_by_hardware_revenue(star, s.as_of),
        "fn_business_health_kpi_pack": lambda: kpis.business_health(star, s.as_of, s.subscriptions_as_of),
        "fn_active_members_in_region_fy": lambda: kpis.active_members(star, s.active_rule, s.home_region),
        "fn_q1_vs_q2_revenue_by_family": lambda: kpis.quarter_revenue_by_family(star, s.as_of),
        "fn_revenue_spike_attribution": lambda: kpis.spike_attribution(star, s.spike.year, s.spike.month),
        "fn_campaigns_churn_reduction": lambda: kpis.campaign_churn(star, s.retention),
        SKU_FUNCTION: lambda: _revenue_by_sku(star),
    }


SKU_FUNCTION = "fn_recognized_revenue_for_sku"


def register(star: Star, settings: KpiSettings, *names: str) -> list[str]:
    """Create the table functions (all nine by default); returns their names."""
    plans = _plans(star, settings)
    spark = star.spark
    for name in names or plans:
        plan = plans[name]()
        plan.createOrReplaceTempView(f"{name}_plan")
        if name == SKU_FUNCTION:
            # One row for any SKU: the argument is the one row on the left.
            spark.sql(
                f"CREATE OR REPLACE TEMPORARY FUNCTION {name}(sku STRING) "
                "RETURNS TABLE (sku_code STRING, recognized_revenue DOUBLE) "
                "RETURN SELECT q.asked, CAST(ROUND(COALESCE(p.revenue, 0), 2) AS DOUBLE) "
                f"FROM (SELECT sku AS asked) q LEFT JOIN {name}_plan p ON p.sku_code = q.asked"
            )
            continue
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in plan.schema)
        spark.sql(
            f"CREATE OR REPLACE TEMPORARY FUNCTION {name}() RETURNS TABLE ({columns}) "
            f"RETURN SELECT * FROM {name}_plan"
        )
    return list(names or plans)

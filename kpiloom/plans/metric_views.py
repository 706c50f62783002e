"""The six metric views of the star."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kpiloom.functions.calendar import Period
from kpiloom.functions.table_functions import KpiSettings
from kpiloom.plans.kpis import NET, NOWHERE
from kpiloom.plans.semantic import Dimension, Join, Measure, MetricView, WindowOver
from kpiloom.plans.wide import active_flags, wide_orders
from kpiloom.sources.star import Bounds, Star

USD, PERCENT = "currency:USD", "percentage"
HARDWARE = "IN ('DEVICE', 'ACCESSORY')"

# The names users may ask by.
SYNONYMS = {
    "Fiscal Year": ("fy", "fiscal_yr"),
    "Fiscal Month": ("fm", "month"),
    "Fiscal Quarter": ("fq", "quarter"),
    "Is Last Fiscal Month": ("last month", "previous fiscal month", "last fiscal month"),
    "Is Last Fiscal Quarter": ("last quarter", "previous fiscal quarter", "last fiscal quarter"),
    "Is Current Fiscal Year": ("this fiscal year", "current fy", "current fiscal year"),
    "Is Current FYTD": ("fytd", "fiscal year to date", "year to date", "ytd"),
    "Is Current Fiscal Q1": ("q1", "fiscal q1"),
    "Is Current Fiscal Q2": ("q2", "fiscal q2"),
    "Is Spike Window": ("june spike", "june revenue", "device launch window"),
    "Is Retention Push Window": ("retention window", "churn campaign window", "retain plus window"),
    "Event Type": ("subscription event", "lifecycle event"),
    "Region": ("geo", "geography", "market"),
    "Region Code": ("region_code", "geo code"),
    "Product Family": ("family", "device family", "product line"),
    "Product Class": ("class", "product type"),
    "SKU Code": ("sku", "product_code", "product code"),
    "Campaign Code": ("campaign", "campaign_id"),
    "Member ID": ("customer_id", "user_id", "member"),
    "Member Handle": ("handle", "display name"),
    "Fact Family": ("grain", "fact type"),
    "Is Active Member": ("active", "active subscriber", "currently active"),
    "Recognized Revenue": ("revenue", "sales", "recognized sales", "net revenue", "recognized_sales"),
    "Hardware Revenue": ("hardware sales", "device revenue", "accessory revenue"),
    "Distinct Members": ("unique members", "customers", "buyers"),
    "New Activations": ("activations", "new members", "signups"),
    "Cancellations": ("cancels", "churned members"),
    "Touched Members": ("members touched", "cohort size"),
    "Churn Rate": ("churn", "cancel rate", "subscription churn"),
    "Retention Window Churn Rate": ("churn reduction", "retention churn", "campaign churn rate", "drove churn"),
    "Ending MRR": ("mrr", "monthly recurring revenue", "subscription revenue"),
    "Active Members": ("active members", "active subscribers", "active membership"),
    "Active Members Approx": ("active members", "active subscribers", "active membership"),
    "MoM Revenue Growth": ("mom growth", "month over month"),
    "Last Fiscal Month Revenue": ("last month revenue", "previous fiscal month sales"),
    "Last Fiscal Month Revenue Flag": ("last month revenue", "previous fiscal month sales"),
}


#: What a reader should know before using a name.
COMMENTS = {
    "Fiscal Year": "4-4-5 fiscal year, not the calendar's",
    "Fiscal Month": "4-4-5 fiscal month from 1 to 12, not the calendar's",
    "Fiscal Quarter": "4-4-5 fiscal quarter from 1 to 4, not the calendar's",
    "Fiscal Month Start": "First day of the calendar month, which window measures move by",
    "Calendar Date": "The day revenue was recognized, or the event happened",
    "Is Last Fiscal Month": "The fiscal month before the one of the day asked for",
    "Is Last Fiscal Quarter": "The fiscal quarter before the one of the day asked for",
    "Is Current FYTD": "From the fiscal year's first day to the end of the current fiscal month",
    "Recognized Revenue": "Net of discounts, of fulfilled lines only",
    "Distinct Members": "Members counted once per group; not to be added up over groups",
    "Churn Rate": "Members who cancelled among those with any event",
    "Current Month Revenue": "Of the group's last calendar month",
    "Prior Month Revenue": "Of the calendar month before the group's last",
    "FYTD Window Revenue": "Summed up within each fiscal year to the group's last day",
}


def _dim(name: str, expr: str, span: Bounds | None = None) -> Dimension:
    return Dimension(name, expr, SYNONYMS.get(name, ()), span, name, COMMENTS.get(name))


def _measure(name: str, kind: str, expr: str = "", where: str | None = None, format: str | None = None, window=()):
    return Measure(name, kind, expr, where, SYNONYMS.get(name, ()), format, window, name, COMMENTS.get(name))


def _spans(star: Star, as_of: date, settings: KpiSettings) -> dict[str, Bounds | None]:
    """The days each relative-period flag holds, seen from ``as_of``."""
    calendar, anchor = star.calendar, star.calendar.anchor(as_of)

    def of(period: Period) -> Bounds:
        return calendar.bounds(period) or NOWHERE

    fixed = {"Is Spike Window": of(settings.spike), "Is Retention Push Window": settings.retention}
    names = (
        "Is Last Fiscal Month", "Is Last Fiscal Quarter", "Is Current Fiscal Year",
        "Is Current FYTD", "Is Current Fiscal Q1", "Is Current Fiscal Q2",
    )
    if anchor is None:
        return {**fixed, **dict.fromkeys(names, NOWHERE)}
    now = anchor.current
    year = of(Period(now.year))
    spans = (
        of(anchor.last_month), of(anchor.last_quarter), year,
        (year[0], of(now)[1]), of(Period(now.year, 1)), of(Period(now.year, 2)),
    )
    return {**fixed, **dict(zip(names, spans))}


FLAG_COLUMNS = {
    "Is Last Fiscal Month": "is_last_fiscal_month",
    "Is Last Fiscal Quarter": "is_last_fiscal_quarter",
    "Is Current Fiscal Year": "is_current_fiscal_year",
    "Is Current FYTD": "is_current_fytd",
    "Is Current Fiscal Q1": "is_current_fiscal_q1",
    "Is Current Fiscal Q2": "is_current_fiscal_q2",
    "Is Spike Window": "is_spike_window",
    "Is Retention Push Window": "is_retention_window",
}
SALES_FLAGS = tuple(FLAG_COLUMNS)[:7]
MEMBERSHIP_FLAGS = (*tuple(FLAG_COLUMNS)[:4], "Is Retention Push Window")

FISCAL = {"Fiscal Year": "fiscal_year", "Fiscal Month": "fiscal_month", "Fiscal Quarter": "fiscal_quarter"}
MEMBER = {"Member ID": "member_id", "Member Handle": "display_handle", "Member Tier": "member_tier"}
CAMPAIGN = {"Campaign Code": "campaign_code", "Campaign Name": "campaign_name"}
PRODUCT = {"Product Family": "product_family", "Product Class": "product_class", "SKU Code": "sku_code"}
REGION = {"Region": "region_name", "Region Code": "region_code"}


def _columns(alias: str, named: dict[str, str]) -> list[Dimension]:
    return [_dim(name, f"{alias}.{column}") for name, column in named.items()]


def _flags(spans: dict[str, Bounds | None], names: tuple[str, ...], alias: str = "dim_date") -> list[Dimension]:
    return [_dim(n, f"{alias}.{FLAG_COLUMNS[n]}", spans[n]) for n in names]


def _date_join(star: Star, as_of: date, settings: KpiSettings, foreign: str) -> Join:
    def table() -> DataFrame:
        flagged = star.calendar.dim_date_flagged(star.spark, as_of, settings.spike, settings.retention)
        # Bounded by the calendar's days, whatever the facts hold.
        return F.broadcast(flagged)

    return Join("dim_date", table, f"source.{foreign}", "date_key")


def _sales_joins(star: Star, settings: KpiSettings) -> tuple[Join, ...]:
    return (
        _date_join(star, settings.as_of, settings, "recognition_date_key"),
        Join("dim_geo", star.dim_geo, "source.geo_key", "geo_key"),
        Join("dim_product", star.dim_product, "source.product_key", "product_key", large=True),
        Join("dim_member", star.dim_member, "source.member_key", "member_key", large=True),
        Join("dim_campaign", star.dim_campaign, "source.campaign_key", "campaign_key", large=True),
    )


def _lines(star: Star):
    return lambda columns, span: star.lines(*columns, recognized=span)


FULFILLED = "source.line_status = 'FULFILLED'"
REVENUE = _measure("Recognized Revenue", "sum", f"source.{NET}", format=USD)
LINE_COUNT = _measure("Order Line Count", "count")
BUYERS = _measure("Distinct Members", "distinct", "source.member_key")
HARDWARE_REVENUE = _measure(
    "Hardware Revenue", "sum", f"source.{NET}", f"dim_product.product_class {HARDWARE}", USD
)


def sales_basic(star: Star, settings: KpiSettings) -> MetricView:
    dimensions = [
        *_columns("dim_date", FISCAL),
        *_columns("dim_geo", REGION),
        _dim("Product Family", "dim_product.product_family"),
        _dim("Product Class", "dim_product.product_class"),
        _dim("Campaign Code", "dim_campaign.campaign_code"),
        _dim("Member Tier", "dim_member.member_tier"),
    ]
    return MetricView(
        "sales_basic", _lines(star), tuple(dimensions), (REVENUE, LINE_COUNT, BUYERS),
        _sales_joins(star, settings), FULFILLED,
    )


def _rich_dimensions(star: Star, settings: KpiSettings) -> list[Dimension]:
    return [
        *_columns("dim_date", FISCAL),
        _dim("Calendar Date", "dim_date.calendar_date"),
        *_flags(_spans(star, settings.as_of, settings), SALES_FLAGS),
        *_columns("dim_geo", REGION),
        _dim("Country Code", "dim_geo.country_code"),
        *_columns("dim_product", PRODUCT),
        *_columns("dim_campaign", CAMPAIGN),
        *_columns("dim_member", MEMBER),
    ]


def sales_rich(star: Star, settings: KpiSettings) -> MetricView:
    measures = (
        REVENUE,
        _measure("Gross Line Amount", "sum", "source.gross_amount", format=USD),
        HARDWARE_REVENUE,
        LINE_COUNT,
        BUYERS,
        _measure("Distinct Orders", "distinct", "source.order_key"),
        _measure(
            "Avg Recognized Revenue per Member", "composed",
            "MEASURE(`Recognized Revenue`) / NULLIF(MEASURE(`Distinct Members`), 0)", format=USD,
        ),
    )
    return MetricView(
        "sales_rich", _lines(star), tuple(_rich_dimensions(star, settings)), measures,
        _sales_joins(star, settings), FULFILLED,
    )


def sales_windowed(star: Star, settings: KpiSettings) -> MetricView:
    month, day, year = "Fiscal Month Start", "Calendar Date", "Fiscal Year"
    dimensions = [
        d for d in _rich_dimensions(star, settings) if d.name != "Country Code"
    ]
    # A calendar month, as in the definition this follows: growth is calendar-based.
    dimensions.insert(4, _dim(month, "TRUNC(dim_date.calendar_date, 'MONTH')"))
    net = f"source.{NET}"
    measures = (
        REVENUE,
        HARDWARE_REVENUE,
        LINE_COUNT,
        BUYERS,
        _measure("Current Month Revenue", "sum", net, format=USD, window=(WindowOver(month),)),
        _measure("Prior Month Revenue", "sum", net, format=USD, window=(WindowOver(month, offset_months=-1),)),
        _measure(
            "MoM Revenue Growth", "composed",
            "(MEASURE(`Current Month Revenue`) - MEASURE(`Prior Month Revenue`)) "
            "/ NULLIF(MEASURE(`Prior Month Revenue`), 0)",
            format=PERCENT,
        ),
        _measure(
            "FYTD Window Revenue", "sum", net, format=USD,
            window=(WindowOver(day, cumulative=True), WindowOver(year)),
        ),
        _measure("Last Fiscal Month Revenue Flag", "sum", net, "dim_date.is_last_fiscal_month", USD),
    )
    return MetricView(
        "sales_windowed", _lines(star), tuple(dimensions), measures, _sales_joins(star, settings), FULFILLED
    )


def membership(star: Star, settings: KpiSettings) -> MetricView:
    as_of = settings.subscriptions_as_of
    active, cancel = "source.event_type = 'ACTIVATE'", "source.event_type = 'CANCEL'"
    window = "dim_date.is_retention_window"
    since = settings.active_rule.since.isoformat()
    member = "source.member_key"

    def source(columns: list[str], span: Bounds | None) -> DataFrame:
        return star.subscriptions(happened=span).select(*columns)

    dimensions = [
        *_columns("dim_date", FISCAL),
        _dim("Calendar Date", "dim_date.calendar_date"),
        *_flags(_spans(star, as_of, settings), MEMBERSHIP_FLAGS),
        _dim("Event Type", "source.event_type"),
        *_columns("dim_geo", REGION),
        *_columns("dim_campaign", CAMPAIGN),
        *_columns("dim_member", MEMBER),
    ]
    measures = (
        _measure("New Activations", "distinct", member, active),
        _measure("Cancellations", "distinct", member, cancel),
        _measure("Touched Members", "distinct", member),
        _measure(
            "Churn Rate", "composed",
            "MEASURE(`Cancellations`) / NULLIF(MEASURE(`Touched Members`), 0)", format=PERCENT,
        ),
        _measure("Retention Window Cancellations", "distinct", member, f"{cancel} AND {window}"),
        _measure("Retention Window Touched", "distinct", member, window),
        _measure(
            "Retention Window Churn Rate", "composed",
            "MEASURE(`Retention Window Cancellations`) / NULLIF(MEASURE(`Retention Window Touched`), 0)",
            format=PERCENT,
        ),
        _measure("Ending MRR", "sum", "source.mrr_delta", format=USD),
        _measure(
            "Active Members Approx", "distinct", member,
            f"source.event_type IN ('ACTIVATE', 'RENEW') AND dim_date.calendar_date >= DATE '{since}'",
        ),
        _measure("Subscription Event Count", "count"),
    )
    joins = (
        _date_join(star, as_of, settings, "event_date_key"),
        Join("dim_member", star.dim_member, "source.member_key", "member_key", large=True),
        Join("dim_geo", star.dim_geo, "dim_member.home_geo_key", "geo_key"),
        Join("dim_campaign", star.dim_campaign, "source.attribution_campaign_key", "campaign_key", large=True),
    )
    return MetricView("membership", source, tuple(dimensions), measures, joins)


def conformed_wide(star: Star, settings: KpiSettings) -> MetricView:
    dimensions = [
        *_columns("source", FISCAL),
        _dim("Region", "source.order_region_name"),
        _dim("Region Code", "source.order_region_code"),
        *_columns("source", PRODUCT),
        *_columns("source", CAMPAIGN),
        _dim("Member Key", "source.member_key"),
        _dim("Member ID", "source.member_id"),
        _dim("Member Handle", "source.display_handle"),
    ]
    buckets = {
        "Recognized Revenue": NET,
        "Hardware Revenue": "hardware_amount",
        "Hardware FYTD Revenue": "hardware_fytd_amount",
        "Last Fiscal Month Revenue": "last_fm_amount",
        "Last Fiscal Quarter Revenue": "last_fq_amount",
        "FYTD Recognized Revenue": "fytd_amount",
        "Q1 Recognized Revenue": "q1_amount",
        "Q2 Recognized Revenue": "q2_amount",
        "Spike Revenue": "spike_amount",
    }
    measures = [_measure(name, "sum", f"source.{column}", format=USD) for name, column in buckets.items()]
    return MetricView(
        "conformed_wide",
        lambda columns, span: wide_orders(star, settings, columns, span),
        tuple(dimensions),
        (*measures, LINE_COUNT, BUYERS),
    )


# -- orders and subscriptions under one roof -------------------------------------


def _conformed_source(star: Star, settings: KpiSettings, as_of: date):
    """Both grains stacked, told apart by ``fact_family``.

    The family is a literal on each side, so a filter on it folds one side
    away, and each side joins only what the wanted columns need.
    """
    order_only = ("order_line_key", "order_key", NET, "gross_amount")
    from_dates = (*FISCAL.values(), "calendar_date", *FLAG_COLUMNS.values())
    types = {"order_line_key": "bigint", "order_key": "bigint", NET: "decimal(18,4)",
             "gross_amount": "decimal(16,2)", "mrr_delta": "decimal(16,2)"}

    def side(frame: DataFrame, family: str, date_key: str, wanted: list[str], tables: list) -> DataFrame:
        asks = set(wanted)
        if asks & set(from_dates):
            dates = star.calendar.dim_date_flagged(star.spark, as_of, settings.spike, settings.retention)
            frame = frame.join(F.broadcast(dates), F.col(date_key) == F.col("date_key"), "left")
        for table, foreign, key, columns in tables:
            used = [c for c in columns if c in asks and c not in frame.columns]
            if used:
                right = table().select(F.col(key).alias("_key"), *used)
                frame = frame.join(right, F.col(foreign) == F.col("_key"), "left").drop("_key")
        frame = frame.withColumn("fact_family", F.lit(family))
        if "is_active_member" in asks:
            frame = frame.withColumn("is_active_member", F.coalesce("is_active_member", F.lit(False)))
        if family == "order" and "is_retention_window" in asks:
            frame = frame.withColumn("is_retention_window", F.lit(False))
        missing = {c: F.lit(None).cast(types.get(c, "string")) for c in wanted if c not in frame.columns}
        return frame.withColumns(missing).select(*wanted) if missing else frame.select(*wanted)

    members = (star.dim_member, "member_key", "member_key", (*MEMBER.values(), "home_geo_key"))
    campaign = tuple(CAMPAIGN.values())
    active = (lambda: active_flags(star, settings), "member_key", "member_key", ("is_active_member",))

    def source(columns: list[str], span: Bounds | None) -> DataFrame:
        asks = set(columns)
        region = asks & set(REGION.values())
        needs = ["recognition_date_key", "campaign_key", "product_key", *(c for c in order_only if c in asks)]
        needs += ["member_key"] if asks & {"member_key", "is_active_member", *MEMBER.values()} else []
        needs += ["geo_key"] if region else []
        orders = side(
            star.fulfilled(*dict.fromkeys(needs), recognized=span), "order", "recognition_date_key", columns,
            [
                (star.dim_geo, "geo_key", "geo_key", REGION.values()),
                (star.dim_product, "product_key", "product_key", PRODUCT.values()),
                (star.dim_campaign, "campaign_key", "campaign_key", campaign),
                members,
                active,
            ],
        )
        home = [*columns, "home_geo_key"] if region else columns
        subscriptions = side(
            star.subscriptions(happened=span), "subscription", "event_date_key", home,
            [
                members,
                (star.dim_geo, "home_geo_key", "geo_key", REGION.values()),
                (star.dim_campaign, "attribution_campaign_key", "campaign_key", campaign),
                active,
            ],
        ).select(*columns)
        return orders.unionByName(subscriptions)

    return source


def conformed(star: Star, settings: KpiSettings, as_of: date | None = None) -> MetricView:
    """Sales and membership measures over one set of dimensions."""
    as_of = as_of or settings.as_of
    spans = _spans(star, as_of, settings)
    # Orders are never in the retention window, so its flag is not a mere span.
    spans["Is Retention Push Window"] = None
    member = "source.member_key"
    dimensions = [
        _dim("Fact Family", "source.fact_family"),
        *_columns("source", FISCAL),
        _dim("Calendar Date", "source.calendar_date"),
        *_flags(spans, tuple(FLAG_COLUMNS), "source"),
        _dim("Event Type", "source.event_type"),
        *_columns("source", REGION),
        *_columns("source", PRODUCT),
        *_columns("source", CAMPAIGN),
        *_columns("source", MEMBER),
        _dim("Is Active Member", "source.is_active_member"),
    ]
    measures = (
        REVENUE,
        _measure("Hardware Revenue", "sum", f"source.{NET}", f"source.product_class {HARDWARE}", USD),
        _measure("Ending MRR", "sum", "source.mrr_delta", format=USD),
        _measure("Cancellations", "distinct", member, "source.event_type = 'CANCEL'"),
        _measure("Touched Members", "distinct", member, "source.fact_family = 'subscription'"),
        _measure(
            "Churn Rate", "composed",
            "MEASURE(`Cancellations`) / NULLIF(MEASURE(`Touched Members`), 0)", format=PERCENT,
        ),
        _measure("Active Members", "distinct", member, "source.is_active_member"),
        _measure("Distinct Members", "distinct", member, "source.fact_family = 'order'"),
        _measure("Order Line Count", "count", where="source.fact_family = 'order'"),
    )
    return MetricView("conformed", _conformed_source(star, settings, as_of), tuple(dimensions), measures)


#: The views by the names that statements ask them by.
VIEWS = {f.__name__: f for f in (sales_basic, sales_rich, membership, conformed, conformed_wide, sales_windowed)}

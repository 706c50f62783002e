"""Attribution of hour-bucketed billing to runs and tiers."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kpiloom.operators.aggregates import as_double, exact_percentile, mean_of
from kpiloom.operators.joins import with_valid_price
from kpiloom.sources.answers import AGENT_PRODUCT, QUESTION_ACTIONS
from kpiloom.sources.sinks import replace_runs


#: The window of a run without times ends at the day it is asked for.
FALLBACK_WINDOW = timedelta(days=7)


@dataclass(frozen=True)
class Span:
    """A half-open span of time."""

    start: datetime
    end: datetime


def _literal(moment: datetime) -> Column:
    return F.lit(moment.strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp_ntz")


def hour_floor(moment: Column) -> Column:
    return F.date_trunc("HOUR", moment).cast("timestamp_ntz")


def hour_ceil(moment: Column) -> Column:
    floored = hour_floor(moment)
    return F.when(floored < moment, floored + F.expr("INTERVAL 1 HOUR")).otherwise(floored)


def bucket_end() -> Column:
    """An open bucket ends an hour after it began."""
    return F.coalesce("usage_end_time", F.col("usage_start_time") + F.expr("INTERVAL 1 HOUR"))


def overlaps(span: Span) -> Column:
    """The bucket shares time with the span, wherever it begins."""
    return (F.col("usage_start_time") < _literal(span.end)) & (bucket_end() > _literal(span.start))


def inside(column: str, span: Span) -> Column:
    return (F.col(column) >= _literal(span.start)) & (F.col(column) < _literal(span.end))


def bill_windows(answers: DataFrame, as_of: datetime | None = None) -> DataFrame:
    """Per run: the asking span padded by 5 minutes, and its whole hours.

    A run without times has no window, or with ``as_of`` the week before it."""
    pad = F.expr("INTERVAL 5 MINUTES")
    asked = answers.groupBy("run_id").agg(
        (F.min("started_at") - pad).alias("start_ts"), (F.max("finished_at") + pad).alias("end_ts")
    )
    if as_of is not None:
        # Both or neither: half a window says nothing about the other half.
        timed = F.col("start_ts").isNotNull() & F.col("end_ts").isNotNull()
        week = {"start_ts": _literal(as_of - FALLBACK_WINDOW), "end_ts": _literal(as_of)}
        asked = asked.select("run_id", *(F.when(timed, F.col(c)).otherwise(v).alias(c) for c, v in week.items()))
    return asked.withColumns(
        {"bill_start": hour_floor(F.col("start_ts")), "bill_end": hour_ceil(F.col("end_ts"))}
    )


# -- priced usage --------------------------------------------------------------------


def _priced(usage: DataFrame, prices: DataFrame, keys: dict[str, Column]) -> DataFrame:
    """Units and cost per key; folded per hour and SKU before the price join."""
    hourly = usage.groupBy(
        "cloud", "sku_name", "usage_start_time", *(c.alias(n) for n, c in keys.items() if n != "sku_name")
    ).agg(F.sum("usage_quantity").alias("units"))
    cost = (F.col("units") * F.col("unit_price")).cast("decimal(38,8)")
    return with_valid_price(hourly, prices).groupBy(*keys).agg(
        F.sum("units").alias("units"), F.sum(cost).alias("cost")
    )


def billing_by_principal(
    usage: DataFrame, prices: DataFrame, span: Span, principals: list[str] | None = None
) -> DataFrame:
    """Agent spend per day, principal, surface and SKU, of all or of some principals."""
    used = usage.where((F.col("billing_origin_product") == AGENT_PRODUCT) & overlaps(span))
    if principals is not None:
        used = used.where(F.col("identity_metadata.run_as").isin(*principals))
    keys = {
        "usage_date": F.col("usage_date"),
        "run_as_sp": F.col("identity_metadata.run_as"),
        "surface": F.col("usage_metadata.agent.surface"),
        "sku_name": F.col("sku_name"),
    }
    spend = _priced(used, prices, keys)
    return spend.select(
        *keys, as_double(F.col("units")).alias("billable_units"), as_double(F.col("cost")).alias("list_cost_usd")
    ).orderBy(F.desc("billable_units"), *keys)


def warehouse_billing(usage: DataFrame, prices: DataFrame, span: Span, warehouses: list[str]) -> DataFrame:
    warehouse = F.col("usage_metadata.warehouse_id")
    used = usage.where(warehouse.isin(*warehouses) & overlaps(span))
    keys = {"usage_date": F.col("usage_date"), "warehouse_id": warehouse}
    spend = _priced(used, prices, keys)
    return spend.select(
        *keys, as_double(F.col("units")).alias("warehouse_units"), as_double(F.col("cost")).alias("warehouse_cost_usd")
    ).orderBy(F.desc("warehouse_cost_usd"), *keys)


# Billing units per hour by warehouse size, and the fallback price.
UNITS_PER_HOUR = {
    "2X-Small": 4,
    "X-Small": 6,
    "Small": 12,
    "Medium": 24,
    "Large": 40,
    "X-Large": 80,
    "2X-Large": 144,
    "3X-Large": 272,
    "4X-Large": 528,
}
FALLBACK_UNIT_PRICE = 0.70


def hourly_rate(
    usage: DataFrame, prices: DataFrame, size: str, since: datetime, warehouses: list[str]
) -> DataFrame:
    """Dollars per hour of a warehouse size at the mean price it was billed.

    One row, with the fallback price when nothing was billed. The mean runs
    over usage rows, so hours are weighted by how many rows they have.
    """
    used = usage.where(
        F.col("usage_metadata.warehouse_id").isin(*warehouses)
        & (F.col("usage_start_time") >= _literal(since))
        & F.col("sku_name").contains("SERVERLESS_SQL")
    )
    folded = used.groupBy("cloud", "sku_name", "usage_start_time").agg(F.count(F.lit(1)).alias("n"))
    price = with_valid_price(folded, prices).agg(
        (as_double(F.sum(F.col("unit_price") * F.col("n"))) / as_double(F.sum("n"))).alias("unit_price"),
        # Any of them will do, and the least is the same on every run.
        F.min("sku_name").alias("sku_name"),
    )
    units = UNITS_PER_HOUR.get(size, UNITS_PER_HOUR["Medium"])
    usd = F.coalesce("unit_price", F.lit(FALLBACK_UNIT_PRICE))
    return price.select(
        F.lit(size).alias("size"),
        F.lit(units).cast("bigint").alias("units_per_hour"),
        F.round(usd, 8).alias("usd_per_unit"),
        F.round(usd * units, 6).alias("hourly_usd"),
        F.col("sku_name").isNotNull().alias("from_list_prices"),
        "sku_name",
    )


# -- telemetry ------------------------------------------------------------------------

# Summed durations and counters of the query history.
HISTORY_SUMS = {
    "total_duration_ms": "total_duration_ms",
    "execution_duration_ms": "execution_duration_ms",
    "waiting_for_compute_ms": "waiting_for_compute_duration_ms",
    "waiting_at_capacity_ms": "waiting_at_capacity_duration_ms",
    "compilation_duration_ms": "compilation_duration_ms",
    "total_task_duration_ms": "total_task_duration_ms",
    "bytes_scanned": "read_bytes",
    "read_rows": "read_rows",
}


def query_history_profile(history: DataFrame, span: Span, spaces: list[str]) -> DataFrame:
    """Statement counts, durations and volumes per agent space and warehouse."""
    keys = ["agent_space_id", "warehouse_id"]
    asked = history.where(
        inside("start_time", span) & F.col("query_source.agent_space_id").isin(*spaces)
    ).withColumns(
        {"agent_space_id": F.col("query_source.agent_space_id"), "warehouse_id": F.col("compute.warehouse_id")}
    )
    sums = [F.sum(F.coalesce(source, F.lit(0))).alias(name) for name, source in HISTORY_SUMS.items()]
    profile = asked.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("query_count"),
        *sums,
        F.round(mean_of(F.col("total_duration_ms")), 1).alias("avg_total_duration_ms"),
        F.count_if(F.col("execution_status") == "FAILED").alias("failed_queries"),
        F.count_if("from_result_cache").alias("cached_queries"),
    )
    p95 = exact_percentile(asked.select(*keys, "total_duration_ms"), keys, "total_duration_ms", 0.95, "p95")
    # Whole milliseconds interpolate to hundredths; drop float noise below those.
    tenths = F.round(F.round("p95", 6), 1)
    seconds = {
        f"{name}_sec": F.round(F.col(f"{name}_ms") / 1000, 2) for name in ("total_duration", "execution_duration")
    }
    return (
        profile.withColumns(seconds)
        .join(p95.select(*keys, tenths.alias("p95_total_duration_ms")), keys, "left")
        .orderBy(F.desc("execution_duration_ms"), *keys)
    )


def audit_by_space(log: DataFrame, span: Span, spaces: list[str], service: str = "agent") -> DataFrame:
    """Questions and distinct askers per space and action."""
    space = F.col("request_params.space_id")
    asked = log.where(
        (F.col("service_name") == service)
        & F.col("action_name").isin(*QUESTION_ACTIONS)
        & inside("event_time", span)
        & space.isin(*spaces)
    )
    per_user = asked.groupBy(space.alias("space_id"), "action_name", F.col("user_identity.email").alias("email")).agg(
        F.count(F.lit(1)).alias("n")
    )
    return (
        per_user.groupBy("space_id", "action_name")
        .agg(F.sum("n").alias("events"), F.count("email").alias("users"))
        .orderBy(F.desc("events"), "space_id", "action_name")
    )


def token_usage(gateway: DataFrame, span: Span) -> DataFrame:
    keys = ["usage_date", "requester", "endpoint_name"]
    tokens = ("input_tokens", "output_tokens", "total_tokens")
    return (
        gateway.where(inside("request_time", span))
        .withColumn("usage_date", F.to_date("request_time"))
        .groupBy(*keys)
        .agg(*(F.sum(t).alias(t) for t in tokens), mean_of(F.col("request_duration_ms")).alias("avg_latency_ms"))
        .orderBy(F.desc("total_tokens"), *keys)
    )


# -- attribution ------------------------------------------------------------------------


def agent_spend(usage: DataFrame, prices: DataFrame) -> DataFrame:
    """Agent units and cost per principal and bucket."""
    used = usage.where(F.col("billing_origin_product") == AGENT_PRODUCT)
    keys = {
        "run_as_sp": F.col("identity_metadata.run_as"),
        "starts": F.col("usage_start_time"),
        "ends": bucket_end(),
    }
    return _priced(used, prices, keys)


def is_settled(spend: DataFrame) -> bool:
    """Billing arrives late; without any of it, costs must not be written."""
    return not spend.isEmpty()


def _until(spend: DataFrame, moment: str, edges: DataFrame) -> DataFrame:
    """Running spend per principal before each whole hour.

    Dense over the hours of ``edges``, so a window's spend is a difference of
    two equi-joined rows instead of a range join against every bucket. The
    window holds one principal's hours, a number the calendar bounds.
    """
    hourly = spend.groupBy("run_as_sp", hour_ceil(F.col(moment)).alias("hour")).agg(
        F.sum("units").alias("units"), F.sum("cost").alias("cost")
    )
    dense = edges.select("run_as_sp", F.explode(F.sequence("first", "last", F.expr("INTERVAL 1 HOUR"))).alias("hour"))
    before = Window.partitionBy("run_as_sp").orderBy("hour").rowsBetween(Window.unboundedPreceding, 0)
    joined = dense.join(hourly, ["run_as_sp", "hour"], "left")
    return joined.select(
        "run_as_sp",
        "hour",
        F.coalesce(F.sum("units").over(before), F.lit(0)).alias("units"),
        F.coalesce(F.sum("cost").over(before), F.lit(0)).alias("cost"),
    )


def attribute_by_window(answers: DataFrame, usage: DataFrame, prices: DataFrame) -> DataFrame:
    """Each run and tier gets its principal's spend over the run's bill window.

    A bucket counts when it overlaps the window: it began before the window's
    end and did not end by its start. So a window's spend is all spend begun
    before its end, less all spend ended by its start.
    """
    identity = answers.select("run_id", "tier", "space_id", "warehouse_id", "run_as_sp").distinct()
    windows = bill_windows(answers).select("run_id", "bill_start", "bill_end")
    asked = identity.join(windows, "run_id")
    spend = agent_spend(usage, prices)
    # A bucket that begins at an hour counts from the next hour's edge on.
    begun = spend.withColumn("counted", F.col("starts") + F.expr("INTERVAL 1 SECOND"))
    edges = _edges(spend, asked)
    before_end = _until(begun, "counted", edges)
    by_start = _until(spend, "ends", edges)
    ended = by_start.select("run_as_sp", F.col("hour").alias("bill_start"), F.col("units").alias("u0"), F.col("cost").alias("c0"))
    started = before_end.select("run_as_sp", F.col("hour").alias("bill_end"), F.col("units").alias("u1"), F.col("cost").alias("c1"))
    joined = asked.join(started, ["run_as_sp", "bill_end"], "left").join(ended, ["run_as_sp", "bill_start"], "left")

    def difference(high: str, low: str) -> Column:
        return as_double(F.coalesce(F.col(high), F.lit(0)) - F.coalesce(F.col(low), F.lit(0)))

    return joined.select(
        "run_id",
        "tier",
        "space_id",
        "warehouse_id",
        "run_as_sp",
        difference("u1", "u0").alias("agent_units"),
        difference("c1", "c0").alias("agent_cost_usd"),
    )


def _edges(spend: DataFrame, asked: DataFrame) -> DataFrame:
    """First and last hour each principal's spend or windows touch."""
    billed = spend.select("run_as_sp", hour_floor(F.col("starts")).alias("first"), hour_ceil(F.col("ends")).alias("last"))
    windows = asked.select("run_as_sp", F.col("bill_start").alias("first"), F.col("bill_end").alias("last"))
    return billed.unionByName(windows).groupBy("run_as_sp").agg(
        F.min("first").alias("first"), F.max("last").alias("last")
    )


def attribute_by_share(answers: DataFrame, usage: DataFrame, prices: DataFrame) -> DataFrame:
    """Each hour's spend split over the runs that asked in it, by question count.

    Questions are counted per run, tier and hour before anything is joined.
    Hours with spend but no questions go to nobody.
    """
    hour = ["run_as_sp", "usage_hour"]
    asks = answers.groupBy("run_id", "tier", "run_as_sp", hour_floor(F.col("started_at")).alias("usage_hour")).agg(
        F.count(F.lit(1)).alias("n_asks")
    )
    everyone = asks.groupBy(*hour).agg(F.sum("n_asks").alias("n_hour"))
    spend = agent_spend(usage, prices).groupBy("run_as_sp", hour_floor(F.col("starts")).alias("usage_hour")).agg(
        F.sum("units").alias("units"), F.sum("cost").alias("cost")
    )
    shared = everyone.join(spend, hour, "left")
    alloc = asks.join(shared, hour, "left")

    def part(value: str) -> Column:
        whole = F.coalesce(as_double(F.col(value)), F.lit(0.0))
        return (whole * F.col("n_asks") / F.greatest("n_hour", F.lit(1))).cast("decimal(28,10)")

    totals = alloc.groupBy("run_id", "tier", "run_as_sp").agg(
        F.sum(part("units")).alias("units"), F.sum(part("cost")).alias("cost")
    )
    return totals.select(
        "run_id",
        "tier",
        "run_as_sp",
        as_double(F.col("units")).alias("agent_units"),
        as_double(F.col("cost")).alias("agent_cost_usd"),
    )


# Measures kept in the cost table's shape, always 0 here because
# only agent spend is attributed.
UNATTRIBUTED = (
    "warehouse_units",
    "warehouse_bill_cost_usd",
    "warehouse_hourly_usd",
    "warehouse_query_cost_usd",
    "warehouse_cost_usd",
    "bytes_scanned",
    "sql_statements",
    "total_duration_ms",
    "execution_duration_ms",
    "waiting_for_compute_ms",
    "total_task_duration_ms",
    "execution_duration_sec",
    "audit_events",
)


def tier_costs(answers: DataFrame, shares: DataFrame) -> DataFrame:
    """The cost table: shares with the ids of each run and tier."""
    ids = answers.groupBy("run_id", "tier").agg(
        F.min("space_id").alias("space_id"), F.min("warehouse_id").alias("warehouse_id")
    )
    zeros = {name: F.lit(0.0) for name in UNATTRIBUTED}
    return shares.join(ids, ["run_id", "tier"], "left").withColumns(zeros)


def write_tier_costs(answers: DataFrame, usage: DataFrame, prices: DataFrame, path: str) -> bool:
    """Replace the costs of the answers' runs; False when nothing is billed yet."""
    if not is_settled(agent_spend(usage, prices)):
        return False
    shares = attribute_by_share(answers, usage, prices)
    replace_runs(tier_costs(answers, shares).withColumn("computed_at", F.current_timestamp()), path)
    return True

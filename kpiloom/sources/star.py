"""The star schema the metrics read.

``Star`` names the tables: five dimensions and five facts. ``GoldStar`` reads
them from the pipeline's gold folder. ``RetailStar`` derives them from the
TPC-H-like tables, so every metric can run on those directly.

Two things keep wide facts cheap. ``lines`` takes the columns a query uses and
adds only the joins those need, because Catalyst keeps a left join whose right
side it cannot prove unique. And date bounds arrive as literals on the stored
date column, so they reach the parquet scan as pushed filters.

Money is a DECIMAL from the source on: sums then do not depend on the order in
which partitions arrive. It becomes DOUBLE in a query's last projection.
"""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from kpiloom.functions.calendar import FiscalCalendar
from kpiloom.operators.joins import first_per_key
from kpiloom.sources.settled import settled

Bounds = tuple[date, date]

#: Of an order line's copies the first in this order counts, here, in silver and
#: in scoring. It is total: the other columns follow from these and the key.
LINE_ORDER = (
    "product_key", "campaign_key", "qty", "gross_amount", "recognition_date_key", "return_amount", "line_status",
)



def cents(column: str) -> Column:
    """A stored double amount as whole cents."""
    return F.rint(F.col(column) * 100).cast("bigint")


def as_money(units: Column, places: int = 2) -> Column:
    """Whole units of ``10 ** -places`` as a decimal.

    Amounts stored as doubles go through integers: turning a double into a
    decimal directly formats it as text, row by row.
    """
    unit = F.lit(f"{10 ** -places:.{places}f}").cast(f"decimal({places},{places})")
    return (units.cast("decimal(13,0)") * unit).cast(f"decimal({14 + places},{places})")


# Event types that count as an active subscription.
ACTIVE_EVENTS = ("ACTIVATE", "RENEW")
SUBSCRIPTION_EVENTS = ("ACTIVATE", "RENEW", "CANCEL")
HARDWARE_CLASSES = ("DEVICE", "ACCESSORY")
PRODUCT_CLASSES = ("DEVICE", "ACCESSORY", "SUBSCRIPTION")

#: Stored line columns that nothing here reads.
UNREAD = ("l_tax",)

LINE_COLUMNS = (
    "order_line_key",
    "order_key",
    "product_key",
    "qty",
    "unit_price",
    "return_amount",
    "gross_amount",
    "net_recognized_amount",
    "line_status",
    "member_key",
    "geo_key",
    "campaign_key",
    "order_date_key",
    "ship_date_key",
    "recognition_date_key",
)

#: Clustering of each gold table: the columns its readers filter on first.
CLUSTER_KEYS = {
    "fact_order": ("order_date_key", "member_key"),
    "fact_order_line": ("recognition_date_key", "product_key", "member_key"),
    "fact_subscription_event": ("event_date_key", "member_key"),
    "fact_usage_event": ("event_date_key", "member_key"),
    "fact_return": ("return_date_key",),
}

#: Business key of every table.
TABLE_KEYS = {
    "dim_date": "date_key",
    "dim_geo": "geo_key",
    "dim_product": "product_key",
    "dim_campaign": "campaign_key",
    "dim_member": "member_key",
    "fact_order": "order_key",
    "fact_order_line": "order_line_key",
    "fact_subscription_event": "subscription_event_key",
    "fact_usage_event": "usage_event_key",
    "fact_return": "return_key",
}


#: Declared, so opening a table starts no job to infer its schema.
RETAIL_SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
}


class Star:
    """The tables of one star schema; all members are lazy DataFrames."""

    def __init__(self, spark: SparkSession, root: str, calendar: FiscalCalendar):
        self.spark, self.root, self.calendar = spark, root.rstrip("/"), calendar

    def dim_date(self) -> DataFrame:
        return self.calendar.dim_date(self.spark)

    def table(self, name: str) -> DataFrame:
        """One of the ten tables by its name."""
        return getattr(self, name)()

    def lines(self, *columns: str, recognized: Bounds | None = None) -> DataFrame:
        """Order lines, limited to ``columns`` and a span of recognition days."""
        raise NotImplementedError

    def bronze_lines(self, *columns: str) -> DataFrame:
        """Order lines as delivered, with the copies a source may hold."""
        return self.lines(*columns)

    def bronze_order_line(self) -> DataFrame:
        return self.bronze_lines(*LINE_COLUMNS)

    def subscriptions(self, happened: Bounds | None = None) -> DataFrame:
        raise NotImplementedError

    def fulfilled(self, *columns: str, recognized: Bounds | None = None) -> DataFrame:
        """Recognized revenue counts fulfilled lines only."""
        wanted = dict.fromkeys((*columns, "line_status"))
        lines = self.lines(*wanted, recognized=recognized)
        return lines.where(F.col("line_status") == "FULFILLED").select(*columns)

    def fact_order_line(self) -> DataFrame:
        return self.lines(*LINE_COLUMNS)

    def fact_subscription_event(self) -> DataFrame:
        return self.subscriptions()


class GoldStar(Star):
    """Reads the gold tables the pipeline wrote under ``root``."""

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.root}/{name}")

    def __getattr__(self, name: str):
        if name in TABLE_KEYS:
            return lambda: self.table(name)
        raise AttributeError(name)

    def _within(self, frame: DataFrame, key: str, bounds: Bounds | None) -> DataFrame:
        if bounds is None:
            return frame
        first, last = map(self.calendar.key_of, bounds)
        return frame.where(F.col(key).between(first, last))

    def lines(self, *columns: str, recognized: Bounds | None = None) -> DataFrame:
        stored = self.table("fact_order_line")
        return self._within(stored, "recognition_date_key", recognized).select(*columns)

    def subscriptions(self, happened: Bounds | None = None) -> DataFrame:
        return self._within(self.table("fact_subscription_event"), "event_date_key", happened)


def _on_days(column: str, bounds: Bounds | None) -> Column:
    """A half-open range on a stored timestamp, in literals parquet can test."""
    if bounds is None:
        return F.lit(True)
    first, after = bounds[0], bounds[1] + timedelta(days=1)
    return (F.col(column) >= F.lit(first).cast("timestamp_ntz")) & (
        F.col(column) < F.lit(after).cast("timestamp_ntz")
    )


class RetailStar(Star):
    """The star schema derived from the TPC-H-like tables in ``root``."""

    #: The calendar spans every order, shipment and event of the tables.
    CALENDAR = FiscalCalendar.from_year(1994, date(2024, 12, 31))

    def __init__(self, spark: SparkSession, root: str, calendar: FiscalCalendar | None = None):
        super().__init__(spark, root, calendar or self.CALENDAR)

    def raw(self, name: str) -> DataFrame:
        return self.spark.read.schema(RETAIL_SCHEMAS[name]).parquet(f"{self.root}/{name}.parquet")

    # -- dimensions --------------------------------------------------------

    def dim_geo(self) -> DataFrame:
        region = self.raw("region")
        joined = self.raw("nation").join(region, F.col("n_regionkey") == F.col("r_regionkey"))
        return joined.select(
            F.col("n_nationkey").alias("geo_key"),
            F.format_string("GEO-%04d", "n_nationkey").alias("geo_code"),
            F.col("n_name").alias("city_name"),
            F.format_string("C%02d", "n_nationkey").alias("country_code"),
            F.replace("r_name", F.lit(" "), F.lit("_")).alias("region_code"),
            F.col("r_name").alias("region_name"),
        )

    def dim_product(self) -> DataFrame:
        kind = F.col("p_type")
        return self.raw("part").select(
            F.col("p_partkey").alias("product_key"),
            F.format_string("SKU-%06d", "p_partkey").alias("sku_code"),
            F.col("p_name").alias("product_name"),
            F.col("p_brand").alias("product_family"),
            F.when(kind.isin("LARGE", "PROMO"), "DEVICE")
            .when(kind.isin("SMALL", "MEDIUM"), "ACCESSORY")
            .otherwise("SUBSCRIPTION")
            .alias("product_class"),
            F.col("p_retailprice").alias("list_price"),
        )

    def dim_campaign(self) -> DataFrame:
        key = F.col("s_suppkey")
        objective = F.when(key % 3 == 0, "AWARENESS").when(key % 3 == 1, "CONVERSION").otherwise("RETENTION")
        return self.raw("supplier").select(
            key.alias("campaign_key"),
            F.col("s_name").alias("campaign_code"),
            F.concat(F.lit("Campaign "), key.cast("string")).alias("campaign_name"),
            objective.alias("campaign_objective"),
        )

    def dim_member(self) -> DataFrame:
        return self.raw("customer").select(
            F.col("c_custkey").alias("member_key"),
            F.col("c_name").alias("member_id"),
            F.concat(F.lit("member_"), F.col("c_custkey").cast("string")).alias("display_handle"),
            F.col("c_mktsegment").alias("member_tier"),
            F.col("c_nationkey").alias("home_geo_key"),
            F.date_add(F.lit(self.calendar.start), (F.col("c_custkey") % 730).cast("int")).alias("signup_date"),
        )

    # -- facts -------------------------------------------------------------

    def _day_key(self, column: str) -> Column:
        return self.calendar.date_key(F.col(column).cast("date"))

    def fact_order(self) -> DataFrame:
        """Orders. The source has no order geo, campaign, or later dates, so
        these follow from the order key; lines have their own."""
        state, key, day = F.col("o_orderstatus"), F.col("o_orderkey"), self._day_key("o_orderdate")
        return self.raw("orders").select(
            key.alias("order_key"),
            F.format_string("ORD-%d", key).alias("order_id"),
            F.col("o_custkey").alias("member_key"),
            (key % 25).cast("int").alias("geo_key"),
            (key % 10).alias("campaign_key"),
            day.alias("order_date_key"),
            (day + key % 8).cast("int").alias("ship_date_key"),
            (day + key % 15).cast("int").alias("recognition_date_key"),
            as_money(cents("o_totalprice")).alias("order_gross_amount"),
            F.when(state == "F", "FULFILLED").when(state == "P", "SHIPPED").otherwise("OPEN").alias("order_status"),
        )

    def lines(self, *columns: str, recognized: Bounds | None = None) -> DataFrame:
        """One line per business key, from a table in which the copies are settled
        once for each state of the source. It is laid out by day, so a span of
        days reads its own part and ranks nothing."""
        source = self.raw("lineitem")
        path = settled(source, f"{self.root}/lineitem.parquet", "lineitem", self._laid_out)
        schema = StructType([f for f in source.schema if f.name not in UNREAD])
        return self._lines(self.spark.read.schema(schema).parquet(path), columns, recognized)

    def settled_lines(self) -> DataFrame:
        """The counting copy of every line, by a rank over all copies: one of
        them may be of any day."""
        own = self._line_columns()
        order = [own[c] for c in LINE_ORDER]
        return first_per_key(self.raw("lineitem").drop(*UNREAD), [own["order_line_key"]], *order)

    def ranked_lines(self, *columns: str) -> DataFrame:
        """One line per business key, ranked when asked for."""
        return self._lines(self.settled_lines(), columns, None)

    def _laid_out(self, files: int) -> DataFrame:
        """Settled lines with a month in few files, sorted by day within each."""
        month = F.year("l_shipdate") * 12 + F.month("l_shipdate")
        # A month that holds a third of all lines still spreads over several files.
        part = F.pmod(F.xxhash64("l_orderkey", "l_linenumber"), F.lit(-(-files // 12)))
        return self.settled_lines().repartition(files, month, part).sortWithinPartitions("l_shipdate")

    def bronze_lines(self, *columns: str) -> DataFrame:
        return self._lines(self.raw("lineitem"), columns, None)

    def _line_columns(self) -> dict[str, Column]:
        """Those that follow from the line alone."""
        gross, off = cents("l_extendedprice"), cents("l_discount")
        quantity = F.col("l_quantity").cast("int")
        flag, state = F.col("l_returnflag"), F.col("l_linestatus")
        status = (
            F.when(flag == "R", "RETURNED")
            .when((flag == "A") & (state == "O"), "CANCELLED")
            .otherwise("FULFILLED")
        )
        day = self._day_key("l_shipdate")
        return {
            "order_line_key": F.col("l_orderkey") * 10 + F.col("l_linenumber"),
            "order_key": F.col("l_orderkey"),
            "product_key": F.col("l_partkey"),
            "qty": quantity,
            # Rounded half up in whole cents.
            "unit_price": as_money(F.floor((gross * 2 + quantity) / (quantity * 2))),
            "return_amount": as_money(gross * off, 4),
            "gross_amount": as_money(gross),
            "net_recognized_amount": as_money(F.when(status == "FULFILLED", gross * (100 - off)).otherwise(0), 4),
            "line_status": status,
            "campaign_key": F.col("l_suppkey"),
            "ship_date_key": day,
            "recognition_date_key": day,
        }

    def _lines(self, frame: DataFrame, columns: tuple[str, ...], recognized: Bounds | None) -> DataFrame:
        unknown = set(columns) - set(LINE_COLUMNS)
        if unknown:
            raise ValueError(f"no such order line columns: {sorted(unknown)}")
        wanted = set(columns)
        own = self._line_columns()
        frame = frame.where(_on_days("l_shipdate", recognized))
        if "geo_key" in wanted:
            supplier = self.raw("supplier").select("s_suppkey", F.col("s_nationkey").alias("geo_key"))
            frame = frame.join(supplier, F.col("l_suppkey") == F.col("s_suppkey"), "left")
        if wanted & {"member_key", "order_date_key"}:
            order = self.fact_order().select(F.col("order_key").alias("of_order"), "member_key", "order_date_key")
            frame = frame.join(order, F.col("l_orderkey") == F.col("of_order"), "left")
        return frame.select(*(own[c].alias(c) if c in own else F.col(c) for c in columns))

    def event_rows(self) -> DataFrame:
        """Events with the number their JSON carries."""
        return self.raw("events").withColumn("k", F.get_json_object("props", "$.k").cast("int"))

    def bronze_subscription_event(self, happened: Bounds | None = None, kinds: tuple[str, ...] = ()) -> DataFrame:
        """Every event, including types the silver expectation drops."""
        events = self.event_rows().where(_on_days("ts", happened))
        if kinds:
            events = events.where(F.col("event_type").isin(*kinds))
        kind = F.col("event_type")
        named = F.when(kind == "signup", "ACTIVATE").when(kind == "purchase", "RENEW").when(kind == "error", "CANCEL")
        amount = as_money(cents("value"))
        return events.select(
            F.col("event_id").alias("subscription_event_key"),
            F.col("user_id").alias("member_key"),
            F.coalesce(named, F.upper(kind)).alias("event_type"),
            self._day_key("ts").alias("event_date_key"),
            F.when(kind == "error", -amount).otherwise(amount).alias("mrr_delta"),
            (F.col("k") % 20).cast("long").alias("attribution_campaign_key"),
        )

    def subscriptions(self, happened: Bounds | None = None) -> DataFrame:
        return self.bronze_subscription_event(happened, ("signup", "purchase", "error"))

    def fact_usage_event(self) -> DataFrame:
        kinds = F.array(*map(F.lit, ("RIDE", "RUN", "STRENGTH", "YOGA", "ROW")))
        return self.event_rows().where(F.col("event_type").isin("click", "view")).select(
            F.col("event_id").alias("usage_event_key"),
            F.col("user_id").alias("member_key"),
            F.col("k").cast("long").alias("product_key"),
            self._day_key("ts").alias("event_date_key"),
            F.col("value").cast("int").alias("duration_sec"),
            (F.col("value") / 2).cast("int").alias("calories"),
            F.element_at(kinds, F.col("k") % 5 + 1).alias("workout_type"),
        )

    def fact_return(self) -> DataFrame:
        from kpiloom.sources.generator import sample_returns

        return sample_returns(self.lines(
            "order_line_key", "order_key", "member_key", "product_key",
            "return_amount", "recognition_date_key", "line_status",
        ))

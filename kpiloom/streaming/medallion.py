"""Bronze, silver and gold.

Bronze streams landed files as they are, with an ingest time. Silver drops
rows that break an expectation and duplicates of a business key. Gold is a
batch snapshot in clustered layout. Streams run until the landed files are
used up (``availableNow``), and resume from their checkpoint.

Dedup has three forms, as a copy may arrive at any time:

``batch``     The micro-batches of a run are taken in as they come, and then cut
              to one row per key all at once, with the rows of the key buckets
              they fall into: of a key's old and new rows the first counts, in
              one total order, so the result does not depend on how files fell
              into batches, and what a run writes not on their number.
              Neighbouring keys share a bucket, so a delivery of recent keys
              rewrites few, and readers rank nothing. Rows, and how many broke
              which expectation, are committed as one, and a retried batch
              changes neither. The default.
``stateful``  Spark's streaming ``dropDuplicates``; every key stays in state,
              which therefore lives in RocksDB rather than on the heap.
``watermark`` The same with state bounded by a delay, for copies that only
              come close together.
"""

from __future__ import annotations

import time
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener
from pyspark.sql.types import StructType

from kpiloom.operators.joins import first_per_key
from kpiloom.session import small_tasks
from kpiloom.sources import files
from kpiloom.sources.sinks import write_gold
from kpiloom.sources.star import LINE_ORDER, PRODUCT_CLASSES, SUBSCRIPTION_EVENTS, TABLE_KEYS
from kpiloom.sources.versioned import BUCKET, VersionedTable

OBSERVED = "expectations"
#: Buckets of a silver table, and how many neighbouring keys share one.
BUCKETS, NEIGHBOURS = 32, 1 << 16
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@dataclass(frozen=True)
class Expectation:
    """A row must satisfy ``rule``; NULL does not."""

    name: str
    rule: str

    @property
    def holds(self) -> Column:
        return F.coalesce(F.expr(self.rule), F.lit(False))


def _listed(values: tuple[str, ...]) -> str:
    return ", ".join(f"'{v}'" for v in values)


#: Expectations of each silver table.
EXPECTATIONS: dict[str, tuple[Expectation, ...]] = {
    name: (Expectation(f"valid_{key}", f"{key} IS NOT NULL"),) for name, key in TABLE_KEYS.items()
}
EXPECTATIONS["dim_product"] += (Expectation("known_class", f"product_class IN ({_listed(PRODUCT_CLASSES)})"),)
EXPECTATIONS["fact_order_line"] += (Expectation("non_null_recognized", "net_recognized_amount IS NOT NULL"),)
EXPECTATIONS["fact_subscription_event"] += (
    Expectation("known_event_type", f"event_type IN ({_listed(SUBSCRIPTION_EVENTS)})"),
)

#: Casts a silver table applies; a value that does not cast becomes NULL.
CASTS = {
    "dim_date": {
        "date_key": "int",
        "calendar_date": "date",
        "fiscal_year": "int",
        "fiscal_month": "int",
        "fiscal_quarter": "int",
        "iso_week": "int",
        "date_label": "string",
    }
}


def normalized_types(frame: DataFrame, name: str) -> DataFrame:
    casts = CASTS.get(name, {})
    return frame.select(*(F.col(c).try_cast(casts[c]).alias(c) if c in casts else F.col(c) for c in frame.columns))


def meets(name: str) -> Column:
    """All expectations of a table hold."""
    result = F.lit(True)
    for expectation in EXPECTATIONS[name]:
        result = result & expectation.holds
    return result


def _checked(frame: DataFrame, name: str, observation: Observation | str) -> DataFrame:
    """Rows of silver's types that meet all expectations; the others are counted."""
    typed = normalized_types(frame, name)
    broken = [F.count_if(~e.holds).alias(e.name) for e in EXPECTATIONS[name]]
    return typed.observe(observation, F.count(F.lit(1)).alias("n_rows"), *broken).where(meets(name))


def one_per_key(frame: DataFrame, name: str) -> DataFrame:
    """The first copy of each business key, in an order of the rows' own values.
    Rows that have their bucket are left sorted by it."""
    first = [c for c in LINE_ORDER if name == "fact_order_line"]
    order = dict.fromkeys((*first, *(c for c in frame.columns if not c.startswith("_"))))
    bucket = [c for c in frame.columns if c == BUCKET]
    return first_per_key(frame, [*bucket, TABLE_KEYS[name]], *order, "_ingest_ts")


def quality_report(frame: DataFrame, name: str) -> DataFrame:
    """Rows each expectation of a table drops, in one pass."""
    rules = EXPECTATIONS[name]
    counts = frame.agg(
        F.count(F.lit(1)).alias("n_rows"),
        *(F.count_if(~e.holds).alias(e.name) for e in rules),
        F.count_if(meets(name)).alias("n_kept"),
    )
    stacked = ", ".join(f"'{e.name}', {e.name}" for e in rules)
    return counts.selectExpr(
        f"'{name}' AS table_name", "n_rows", "n_kept", f"stack({len(rules)}, {stacked}) AS (expectation, n_dropped)"
    )


class _Counts(StreamingQueryListener):
    """The counts observed in each micro-batch of one query, however many it has."""

    def __init__(self):
        self.batches: dict[int, dict[str, int]] = {}

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        row = event.progress.observedMetrics.get(OBSERVED)
        if row is not None:
            # A batch that is tried again replaces its own counts.
            self.batches[event.progress.batchId] = row.asDict()

    def settled(self, query: StreamingQuery, patience: float = 10.0) -> dict[str, int]:
        """The sums, once the last batch's progress has come in."""
        last, end = query.lastProgress, time.monotonic() + patience
        while last and last.observedMetrics.get(OBSERVED) and last.batchId not in self.batches and time.monotonic() < end:
            time.sleep(0.05)
        return summed(self.batches.values())


def summed(batches: Iterable[dict[str, int]]) -> dict[str, int]:
    totals: dict[str, int] = {}
    for counts in batches:
        for name, count in counts.items():
            totals[name] = totals.get(name, 0) + count
    return totals


class Medallion:
    """The tables under one root folder: ``landing``, ``bronze``, ``silver``, ``gold``."""

    #: Bounds one micro-batch when a large backlog has landed.
    MAX_BYTES = 2 << 40

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def path(self, layer: str, name: str) -> str:
        return f"{self.root}/{layer}/{name}"

    def land(self, frame: DataFrame, name: str) -> None:
        """Drop another batch of raw files, in blocks of the usual size: each makes
        a file of bronze."""
        frame.write.mode("append").option("compression", files.PACKED["compression"]).parquet(self.path("landing", name))

    def _run(self, stream: DataFrame, layer: str, name: str) -> StreamingQuery:
        query = (
            stream.writeStream.format("parquet")
            .outputMode("append")
            .option("checkpointLocation", self.path("checkpoints", f"{layer}-{name}"))
            .options(**files.PACKED)
            .trigger(availableNow=True)
            .start(self.path(layer, name))
        )
        query.awaitTermination()
        return query

    def _stream(self, layer: str, name: str, schema: StructType) -> DataFrame:
        reader = self.spark.readStream.schema(schema).option("maxBytesPerTrigger", self.MAX_BYTES)
        return reader.parquet(self.path(layer, name))

    def ingest(self, name: str, schema: StructType | None = None) -> None:
        """Landed files to bronze.

        Without a schema it is the merged one of all landed files, so columns
        that newer files add are taken on when the stream next starts.
        """
        schema = schema or self.spark.read.option("mergeSchema", "true").parquet(self.path("landing", name)).schema
        landed = self._stream("landing", name, schema)
        self._run(landed.withColumn("_ingest_ts", F.current_timestamp()), "bronze", name)

    def refine(self, name: str, dedup: str = "batch", within: str = "1 day") -> dict[str, int]:
        """Bronze to silver: types, expectations, dedup on the business key.

        Returns how many rows came in and how many broke each expectation,
        counted while they streamed by.
        """
        stream, key = self._stream("bronze", name, self.table("bronze", name).schema), TABLE_KEYS[name]
        if dedup == "batch":
            return self._refine_by_batch(stream, name)
        checked = _checked(stream, name, OBSERVED)
        if dedup == "stateful":
            return self._with_rocksdb(checked.dropDuplicates([key]), name)
        if dedup == "watermark":
            bounded = checked.withWatermark("_ingest_ts", within)
            return self._with_rocksdb(bounded.dropDuplicatesWithinWatermark([key]), name)
        raise ValueError(f"no such dedup: {dedup}")

    def _with_rocksdb(self, stream: DataFrame, name: str) -> dict[str, int]:
        provider, counts = "spark.sql.streaming.stateStore.providerClass", _Counts()
        before = self.spark.conf.get(provider)
        self.spark.conf.set(provider, ROCKSDB)
        self.spark.streams.addListener(counts)
        try:
            return counts.settled(self._run(stream, "silver", name))
        finally:
            self.spark.streams.removeListener(counts)
            self.spark.conf.set(provider, before)

    def silver(self, name: str) -> VersionedTable:
        """The silver table that batches are merged into."""
        run = F.floor(F.col(TABLE_KEYS[name]) / NEIGHBOURS)
        return VersionedTable(self.spark, self.path("silver", name), F.pmod(F.xxhash64(run), F.lit(BUCKETS)))

    def _refine_by_batch(self, stream: DataFrame, name: str) -> dict[str, int]:
        target, size = self.silver(name), files.size(self.spark, self.path("bronze", name))
        before = set(target.manifest().batches)

        def settled(rows: DataFrame) -> DataFrame:
            return one_per_key(rows, name)

        def write(batch: DataFrame, batch_id: int) -> None:
            seen = Observation()
            # The stream keeps the number of partitions it once began with.
            with small_tasks(batch.sparkSession, size):
                target.take(_checked(batch, name, seen), settled, str(batch_id), lambda: seen.get)

        with small_tasks(self.spark, size):
            query = (
                stream.writeStream.foreachBatch(write)
                .option("checkpointLocation", self.path("checkpoints", f"silver-{name}"))
                .trigger(availableNow=True)
                .start()
            )
            query.awaitTermination()
        target.settle(settled)
        return summed(counts for batch, counts in target.manifest().batches.items() if batch not in before)

    def broken(self, name: str) -> dict[str, int]:
        """Rows that came into a silver table merged by batches, and how many of
        them broke each expectation, over all its runs."""
        return summed(self.silver(name).manifest().batches.values())

    def publish(self, name: str) -> None:
        """Silver to gold, as a clustered snapshot."""
        silver = self.table("silver", name).drop("_ingest_ts")
        write_gold(silver, name, self.path("gold", name), size=files.size(self.spark, self.path("silver", name)))

    def build(self, name: str, dedup: str = "batch") -> DataFrame:
        """One table through all layers; returns gold."""
        self.ingest(name)
        self.refine(name, dedup)
        self.publish(name)
        return self.table("gold", name)

    def table(self, layer: str, name: str) -> DataFrame:
        """A layer's table; in silver, one row per key."""
        if layer == "silver" and (table := self.silver(name)).exists():
            return table.read()
        return self.spark.read.option("mergeSchema", "true").parquet(self.path(layer, name))

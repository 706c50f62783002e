"""Writers: overwrite, clustered layout, replace by run, append."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kpiloom.session import shared_dir, small_tasks
from kpiloom.sources import files
from kpiloom.sources.star import CLUSTER_KEYS, TABLE_KEYS
from kpiloom.sources.versioned import VersionedTable

RUN_BUCKETS = 16
#: Bits of each key that a curve goes by, and bytes of a file laid along it.
CURVE_BITS, FILE_BYTES = 6, 128 << 20


def overwrite(frame: DataFrame, path: str) -> None:
    """Replace a table with its schema."""
    frame.write.mode("overwrite").options(**files.PACKED).parquet(path)


def clustered(frame: DataFrame, keys: tuple[str, ...], unique: str) -> DataFrame:
    """Rows ranged over partitions by ``keys`` and sorted within them.

    Files then hold narrow key ranges, so their min/max statistics let a
    filtered scan skip them. Ranging on the unique key last splits even a day
    that holds a third of all rows over several files.
    """
    return frame.repartitionByRange(*keys, unique).sortWithinPartitions(*keys)


def _slot(key: str, cuts: list) -> Column:
    """Which of the equally filled ranges between the cuts a value lies in, by
    binary search; NULL lies before them all."""
    array = F.array(*map(F.lit, cuts))
    steps = F.array(*[F.lit(1 << b) for b in reversed(range(len(cuts).bit_length()))])
    further = lambda at, s: F.when((at + s <= len(cuts)) & (F.get(array, at + s - 1) <= F.col(key)), at + s).otherwise(at)
    return F.aggregate(steps, F.lit(0), further)


def along_curve(frame: DataFrame, keys: tuple[str, ...]) -> Column:
    """A row's place on a space-filling curve through the keys: the bits of its
    slots of all keys, interleaved. Rows that are near on the curve are near in
    every key, so files cut from it are narrow in each of them.

    The slots come from quantile sketches of the keys, one pass over them.
    """
    slots = 1 << CURVE_BITS
    wanted = F.array(*[F.lit(i / slots) for i in range(1, slots)])
    found = frame.agg(*(F.approx_percentile(k, wanted, F.lit(20 * slots)).alias(k) for k in keys)).first()
    # A value that fills several slots gives several equal cuts.
    placed = {k: _slot(k, sorted(set(found[k] or ()))) for k in keys}
    place = F.lit(0).cast("long")
    for bit in reversed(range(CURVE_BITS)):
        for slot in placed.values():
            place = F.shiftleft(place, 1).bitwiseOR(F.shiftright(slot, bit).bitwiseAND(F.lit(1)).cast("long"))
    return place


def write_along_curve(frame: DataFrame, keys: tuple[str, ...], unique: str, path: str, file_bytes: int = FILE_BYTES) -> None:
    """Replace a table by rows laid along a curve through all its keys, in as many
    files as its size asks for. The rows are worked out once, and staged for it."""
    spark, stage = frame.sparkSession, shared_dir(frame.sparkSession, "curve")
    frame.write.parquet(stage)
    staged = spark.read.schema(frame.schema).parquet(stage)
    count = max(1, -(-files.size(spark, stage) // file_bytes))
    placed = staged.withColumn("_place", along_curve(staged, keys))
    overwrite(placed.repartitionByRange(count, "_place", unique).sortWithinPartitions("_place").drop("_place"), path)
    files.remove(spark, stage)


def write_gold(frame: DataFrame, name: str, path: str, layout: str = "first_key", size: int = 0) -> None:
    """Write a gold table in the layout its readers prune on: by its first key,
    then the others, or along a ``curve`` through all of them, which serves filters
    on any key and costs those on the first one some of their sharpness. Tasks
    follow the ``size`` in bytes of what the frame reads."""
    keys = CLUSTER_KEYS.get(name)
    with small_tasks(frame.sparkSession, size):
        if keys and layout == "curve":
            return write_along_curve(frame, keys, TABLE_KEYS[name], path)
        overwrite(clustered(frame, keys, TABLE_KEYS[name]) if keys else frame, path)


def runs_table(spark: SparkSession, path: str) -> VersionedTable:
    """A table of runs. They are spread over a fixed number of buckets, so any
    number of them stays a small directory tree."""
    return VersionedTable(spark, path, F.pmod(F.crc32(F.encode("run_id", "UTF-8")), F.lit(RUN_BUCKETS)))


def append_runs(rows: DataFrame, path: str) -> None:
    """Add rows of new runs to a table of runs."""
    runs_table(rows.sparkSession, path).append(rows)


def replace_runs(rows: DataFrame, path: str) -> None:
    """Replace the rows of every run in ``rows``, leaving other runs alone.

    Running it twice gives the same table. The rows are worked out once, only
    buckets a replaced run lives in are rewritten, and readers see the table
    before or after, whatever happens in between.
    """

    def settle(present: DataFrame, fresh: DataFrame) -> DataFrame:
        kept = present.join(fresh.select("run_id").distinct(), "run_id", "left_anti")
        return kept.unionByName(fresh, allowMissingColumns=True)

    runs_table(rows.sparkSession, path).merge(rows, settle)


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a table of runs has been written at ``path``."""
    return runs_table(spark, path).exists()


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    return runs_table(spark, path).read()

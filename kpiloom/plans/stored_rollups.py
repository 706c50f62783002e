"""Rollups stored at a fine grain, from which any coarser one is answered.

Sums and counts add up. Distinct counts are kept as bitmaps: a counted column's
values fall into buckets of 64 consecutive numbers, each a long with one bit per
value, and the bitmaps of a coarser group are those of its parts or-ed together, so
counts stay exact however often they are rolled up. Keys that are spread thinly over
the groups take a few bytes each, where wide bitmaps would be empty for the most
part and fill a task's memory with zeros. Percentiles are kept as mergeable
quantile sketches. What is stored grows with the groups and, for bitmaps, with the
buckets that their values touch, not with the facts.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kpiloom.operators.aggregates import as_double
from kpiloom.plans.scoring import ANSWER_KEY
from kpiloom.session import small_tasks
from kpiloom.sources.sinks import overwrite

#: Size of a quantile sketch: ranks are off by about 1.7 / SKETCH**0.9 at most.
SKETCH = 400
#: Values of a bitmap, as a power of two: those of a long.
BITS = 6


@dataclass(frozen=True)
class Rollup:
    """A table of ``keys`` under ``path``, with summed columns beside and bitmaps
    of the counted columns in a table of their own."""

    path: str
    keys: tuple[str, ...]
    sums: tuple[str, ...] = ()
    counted: tuple[str, ...] = ()

    def write(self, frame: DataFrame, size: int = 0) -> None:
        """Folds the facts; ``frame`` has the keys and columns that the rollup names.

        The counted columns share one pass: every value goes to its own column's
        bucket, where the bits of a task's rows are combined before they move.
        Tasks follow the ``size`` in bytes of what the frame reads.
        """
        sums = [F.sum(c).alias(c) for c in self.sums]
        with small_tasks(frame.sparkSession, size):
            overwrite(frame.groupBy(*self.keys).agg(F.count(F.lit(1)).alias("n_rows"), *sums), f"{self.path}/sums")
            if self.counted:
                values = F.explode(F.array(*[F.struct(F.lit(c).alias("counted"), F.col(c).cast("long").alias("value")) for c in self.counted]))
                rows = frame.select(*self.keys, values.alias("v")).where("v.value is not null")
                bits = F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), F.col("v.value").bitwiseAND(F.lit((1 << BITS) - 1)).cast("int"))).alias("bits")
                bucket = F.shiftright("v.value", BITS).alias("bucket")
                overwrite(rows.groupBy(*self.keys, F.col("v.counted").alias("counted"), bucket).agg(bits), f"{self.path}/bitmaps")

    def read(self, spark, keys: tuple[str, ...]) -> DataFrame:
        """The rollup by some of its keys: n_rows, the sums, and the number of
        different values of each counted column. Reads no facts."""
        unknown = set(keys) - set(self.keys)
        if unknown:
            raise ValueError(f"the rollup is not stored by {sorted(unknown)}")
        stored = spark.read.parquet(f"{self.path}/sums")
        totals = [F.sum(c).alias(c) for c in ("n_rows", *self.sums)]
        empty = [F.lit(None).cast("long").alias(c) for c in self.counted]
        parts = stored.groupBy(*keys).agg(*totals).select(*keys, "n_rows", *self.sums, *empty)
        if self.counted:
            bitmaps = spark.read.parquet(f"{self.path}/bitmaps")
            merged = bitmaps.groupBy(*keys, "counted", "bucket").agg(F.bit_or("bits").alias("bits"))
            size = F.bit_count("bits")
            counts = [F.sum(F.when(F.col("counted") == c, size).otherwise(0)).alias(c) for c in self.counted]
            parts = parts.unionByName(merged.groupBy(*keys).agg(*counts), allowMissingColumns=True)
        # Both sides have a group once, so max only brings their columns together.
        wide = parts.groupBy(*keys).agg(*(F.max(c).alias(c) for c in ("n_rows", *self.sums, *self.counted)))
        return wide.withColumns({c: F.coalesce(c, F.lit(0)) for c in self.counted}) if self.counted else wide


def write_latencies(answers: DataFrame, path: str) -> None:
    """A quantile sketch of the questions' latencies per run and tier."""
    questions = answers.groupBy(*ANSWER_KEY).agg(F.max("latency_ms").alias("latency_ms"))
    sketch = F.kll_sketch_agg_double(as_double(F.col("latency_ms")), F.lit(SKETCH)).alias("latencies")
    counted = questions.where(F.col("latency_ms").isNotNull()).groupBy("run_id", "tier").agg(F.count(F.lit(1)).alias("n_questions"), sketch)
    overwrite(counted, path)


def latency_percentiles(stored: DataFrame, keys: list[str], fractions: dict[str, float]) -> DataFrame:
    """Percentiles of any groups of runs and tiers, from the stored sketches alone."""
    merged = stored.groupBy(*keys).agg(F.sum("n_questions").alias("n_questions"), F.kll_merge_agg_double("latencies").alias("merged"))
    return merged.select(*keys, "n_questions", *(_at("merged", f).alias(name) for name, f in fractions.items()))


def _at(sketch: str, fraction: float) -> Column:
    return F.kll_sketch_get_quantile_double(sketch, F.lit(float(fraction)))


def rank_error() -> float:
    """How far a percentile's rank may be from the one asked for."""
    return 1.7 / SKETCH**0.9 * 1.5


def within_rank(estimates: DataFrame, questions: DataFrame, keys: list[str], fractions: dict[str, float]) -> DataFrame:
    """For each percentile whether its value's exact ranks among the questions'
    latencies come within ``rank_error`` of the one asked for."""
    joined = questions.join(estimates, keys)
    n = F.count(F.lit(1))
    checks = []
    for name, fraction in fractions.items():
        below, upto = F.count_if(F.col("latency_ms") < F.col(name)) / n, F.count_if(F.col("latency_ms") <= F.col(name)) / n
        checks.append(((below - fraction <= rank_error()) & (fraction - upto <= rank_error())).alias(f"{name}_within"))
    return joined.groupBy(*keys).agg(n.alias("n_questions"), *checks)

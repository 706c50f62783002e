"""Aggregate building blocks that give the same answer on any partitioning."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def as_double(value: Column) -> Column:
    return value.cast("double")


def money(value: Column) -> Column:
    """A decimal sum as a double rounded to cents; NULL on empty input."""
    return F.round(value, 2).cast("double")


def money_sum(column: str | Column) -> Column:
    return money(F.sum(column))


def when_sum(condition: Column, value: Column) -> Column:
    """Sum of ``value`` where ``condition`` holds, 0 elsewhere."""
    return F.sum(F.when(condition, value).otherwise(F.lit(0)))


def safe_ratio(top: Column, bottom: Column) -> Column:
    """``top / bottom`` as a double; NULL when the bottom is 0 or NULL."""
    return F.try_divide(as_double(top), as_double(bottom))


def mean_of(value: Column) -> Column:
    """Mean through an exact decimal sum, so the order of rows cannot show."""
    return safe_ratio(F.sum(value), F.count(value))


#: Enough places for cents split over hours and then over answers.
FINE = "decimal(30,13)"


def exact_sum(value: str | Column) -> Column:
    """The sum of a double column, free of the order of its rows."""
    column = F.col(value) if isinstance(value, str) else value
    return as_double(F.sum(column.cast(FINE)))


def exact_mean(value: str | Column) -> Column:
    return F.try_divide(exact_sum(value), as_double(F.count(value)))


def spread(value: Column) -> dict[str, Column]:
    """Mean, sample deviation, standard error, minimum and maximum.

    The deviation of a single value is 0. Deviations are rounded, because
    Spark merges partial moments in whatever order the partitions finish.
    """
    deviation = F.coalesce(F.stddev_samp(value), F.lit(0.0))
    count = F.count(value)
    known = count > 0
    return {
        "mean": exact_mean(value),
        "std": F.round(F.when(known, deviation).otherwise(F.lit(0.0)), 8),
        "se": F.round(F.when(known, deviation / F.sqrt(count)), 8),
        "min": F.min(value),
        "max": F.max(value),
    }


def distinct_by_flag(
    frame: DataFrame, keys: list[str], member: str, flags: dict[str, Column]
) -> DataFrame:
    """Several filtered ``COUNT(DISTINCT member)`` in two plain aggregations.

    Asking Spark for them directly expands every row once per filter. Folding
    to one row per (keys, member) with a boolean per filter first needs one
    shuffle, combines map-side, and so also tames a hot member or a hot key.
    """
    folded = frame.groupBy(*keys, member).agg(
        *(F.max(F.coalesce(flag, F.lit(False))).alias(name) for name, flag in flags.items())
    )
    known = F.col(member).isNotNull()
    counts = [F.count(F.when(known & F.col(name), 1)).alias(name) for name in flags]
    return folded.groupBy(*keys).agg(*counts)


def exact_percentile(
    frame: DataFrame, keys: list[str], value: str, fraction: float, name: str
) -> DataFrame:
    """Interpolated percentile per group without gathering any group.

    Equal values collapse to counts first. Their running count over coarse,
    order-preserving buckets finds the buckets with the two neighbouring
    ranks, and only the values of those buckets are then ordered. Buckets are
    1/32 of a power of two, so a group has at most some thousands of them, and
    of a whole-numbered measure like milliseconds each holds few values.
    """
    counts = (
        frame.where(F.col(value).isNotNull())
        .groupBy(*keys, F.col(value).cast("double").alias("_value"))
        .agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_bucket", _bucket_of("_value"))
    )
    return _ranked_percentile(counts, keys, fraction, name)


def _bucket_of(column: str) -> Column:
    value = F.col(column)
    return (F.signum(value) * F.floor(F.log2(F.abs(value) + 1) * 32)).cast("long")


def _ranked_percentile(counts: DataFrame, keys: list[str], fraction: float, name: str) -> DataFrame:
    per_bucket = counts.groupBy(*keys, "_bucket").agg(F.sum("_n").alias("_bucket_n"))
    within = Window.partitionBy(*keys)
    until = within.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    position = F.lit(fraction) * (F.col("_total") - 1)
    wanted = (
        per_bucket.withColumn("_total", F.sum("_bucket_n").over(within))
        .withColumn("_before", F.coalesce(F.sum("_bucket_n").over(until), F.lit(0)))
        .withColumn("_low", F.floor(position))
        .withColumn("_high", F.ceil(position))
        .withColumn("_part", position - F.floor(position))
        .where(
            (F.col("_low") < F.col("_before") + F.col("_bucket_n")) & (F.col("_high") >= F.col("_before"))
        )
    )
    ranks = wanted.select(
        *(F.col(k).alias(f"_of_{k}") for k in [*keys, "_bucket"]), "_before", "_low", "_high", "_part"
    )
    same = reduce(Column.__and__, (F.col(k).eqNullSafe(F.col(f"_of_{k}")) for k in [*keys, "_bucket"]))
    candidates = counts.join(ranks, same)
    inside = Window.partitionBy(*keys, "_bucket").orderBy("_value").rowsBetween(Window.unboundedPreceding, 0)
    ranked = candidates.withColumn("_until", F.col("_before") + F.sum("_n").over(inside))
    first = F.col("_until") - F.col("_n")

    def at(rank: str) -> Column:
        hit = (first <= F.col(rank)) & (F.col(rank) < F.col("_until"))
        return F.max(F.when(hit, F.col("_value")))

    low, high = at("_low"), at("_high")
    return ranked.groupBy(*keys).agg((low + (high - low) * F.max("_part")).alias(name))

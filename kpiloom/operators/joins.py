"""Join patterns the built-in join does not name."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def with_valid_price(usage: DataFrame, prices: DataFrame) -> DataFrame:
    """Usage with the list price in force when its bucket began.

    Equal cloud and SKU make this an equi-join with the validity span as a
    residual test; an open span has no end. Whether the price list is small
    enough to broadcast is left to its measured size.
    """
    p = prices.select(
        F.col("cloud").alias("_cloud"),
        F.col("sku_name").alias("_sku"),
        "price_start_time",
        "price_end_time",
        F.col("pricing.effective_list.default").alias("unit_price"),
    )
    began = F.col("usage_start_time")
    valid = (began >= F.col("price_start_time")) & (
        F.col("price_end_time").isNull() | (began < F.col("price_end_time"))
    )
    matched = (F.col("cloud") == F.col("_cloud")) & (F.col("sku_name") == F.col("_sku"))
    return usage.join(p, matched & valid).drop("_cloud", "_sku", "price_start_time", "price_end_time")


def first_per_key(frame: DataFrame, keys: list[str | Column], *order) -> DataFrame:
    """The first row of every key in a total order.

    Spark turns the rank filter into a group limit before the shuffle, so a
    task sends at most one row per key, however many copies a key has.
    """
    ranked = frame.withColumn("_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.where(F.col("_rank") == 1).drop("_rank")

"""Distinct customers that add up: exact bitmaps per day, merged for any longer period.

A count of distinct customers per day cannot be added up to weeks.  Customers get dense numbers once,
and each day keeps bitmaps of the numbers that ordered: one row of 4 KiB for every 32,768 numbers
that the day touches.  Bitmaps of days are merged by OR, so weeks, months or any other set of days
are counted exactly from the stored rows, without the orders.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

BUCKETS = 1024  # parts in which keys are numbered, each by one task
BITMAP_BYTES = 4096  # Spark's bitmaps hold 32,768 bits


def dense_numbers(keys: DataFrame, key: str, into: str, buckets: int = BUCKETS) -> DataFrame:
    """(key, into): the distinct keys numbered from 1 without gaps; NULL has no number.

    Keys are numbered inside hash buckets, whose sizes (``buckets`` rows) are added up to offsets, so
    no task sees all keys.  The same keys get the same numbers.
    """
    distinct = keys.where(F.col(key).isNotNull()).select(key).distinct()
    dealt = distinct.withColumn("_bucket", F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int"))
    earlier = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        dealt.groupBy("_bucket")
        .agg(F.count(F.lit(1)).alias("_size"))
        .select("_bucket", F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_before"))
    )
    place = F.row_number().over(Window.partitionBy("_bucket").orderBy(key))
    return (
        dealt.withColumn("_place", place)
        .join(offsets, "_bucket")
        .select(key, (F.col("_before") + F.col("_place")).alias(into))
    )


def daily_customer_bitmaps(orders: DataFrame, numbers: DataFrame) -> DataFrame:
    """(order_date, bitmap_bucket, bitmap): the customers of every day, as numbers of ``numbers``.

    Orders are reduced to one row per day and customer before they meet the numbers, so a customer
    with very many orders brings at most one row per day.  Undated orders are left out.
    """
    n = F.col("customer_number")
    days = orders.where(F.col("order_date").isNotNull()).select("order_date", "customer_id").distinct()
    return (
        days.join(numbers, "customer_id")
        .groupBy("order_date", F.bitmap_bucket_number(n).alias("bitmap_bucket"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position(n)).alias("bitmap"))
    )


def customers_by_period(bitmaps: DataFrame) -> DataFrame:
    """(period_kind, period_start, customers): distinct customers per day, week and month, from one scan."""
    periods = {
        "day": F.col("order_date"),
        "week": F.trunc("order_date", "week"),
        "month": F.trunc("order_date", "month"),
    }
    each = F.array(*[F.struct(F.lit(kind).alias("period_kind"), start.alias("period_start")) for kind, start in periods.items()])
    merged = (
        bitmaps.select(F.inline(each), "bitmap_bucket", "bitmap")
        .groupBy("period_kind", "period_start", "bitmap_bucket")
        .agg(F.bitmap_or_agg("bitmap").alias("bitmap"))
    )
    return merged.groupBy("period_kind", "period_start").agg(F.sum(F.bitmap_count("bitmap")).alias("customers"))

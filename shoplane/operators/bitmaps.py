"""Distinct counts that can be added up: bitmaps of ids by day.

A distinct count of one day can't be merged with that of the next. A bitmap of the ids seen can: by ``or``. Ids
are dealt to buckets of 32,768 by Spark's ``bitmap_bucket_number``, and a day's ids of a bucket are one bitmap of
4 kB. Days are reduced once; weeks, months or rolling windows are then made from the bitmaps, without the rows, and exactly.

This pays where a day's ids are dense, such as all users of a shop. For few ids of a large range (one product's
orders) a bitmap for each would be larger than the ids.

At scale: bitmaps are built with map-side combine and are bounded, by days times buckets of 32,768 ids, so a day
with a third of all rows is a few bitmaps per task before the shuffle. A rolling window reads each bitmap once per
day that it counts for.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def daily_bitmaps(rows: DataFrame, date: str, member: str | Column, by: tuple[str, ...] = ()) -> DataFrame:
    """(day, by..., bucket, bitmap) of the integer ids ``member``; NULL ids and rows without a date are in none."""
    member = (F.col(member) if isinstance(member, str) else member).cast("bigint")
    ids = rows.select(F.col(date).alias("day"), *by, member.alias("id")).filter(F.col("day").isNotNull() & F.col("id").isNotNull())
    return (ids.select("day", *by, F.bitmap_bucket_number("id").alias("bucket"), F.bitmap_bit_position("id").alias("position"))
            .groupBy("day", *by, "bucket").agg(F.bitmap_construct_agg("position").alias("bitmap")))


def merged(bitmaps: DataFrame, *keys: str | Column) -> DataFrame:
    """Bitmaps of coarser keys, such as a month instead of its days: by ``or``."""
    return bitmaps.groupBy(*keys, "bucket").agg(F.bitmap_or_agg("bitmap").alias("bitmap"))


def counts(bitmaps: DataFrame, *keys: str, out: str = "distinct_count") -> DataFrame:
    """Distinct ids per key: bits of all its buckets."""
    return bitmaps.groupBy(*keys).agg(F.sum(F.bitmap_count("bitmap")).cast("bigint").alias(out))


def rolling(bitmaps: DataFrame, days: int, by: tuple[str, ...] = (), out: str = "distinct_count") -> DataFrame:
    """(day, by..., out): distinct ids of each day with bitmaps and the ``days - 1`` days before it."""
    there = bitmaps.select("day", *by).distinct()
    ends = F.explode(F.sequence("day", F.date_add("day", days - 1)))
    reached = bitmaps.withColumn("day", ends).join(there, ["day", *by], "left_semi")
    return counts(merged(reached, "day", *by), "day", *by, out=out)

"""Exact distinct counts that can be merged: bitmaps of numbered keys, per group and range of numbers.

The sum of daily distinct counts is not the distinct count of a month. A bitmap per day is kept instead: bitmaps of days make those of
weeks and months, and bitmaps of new days are added without reading old orders. A bitmap covers 32,768 numbers in 4 KB, so numbers
are dense, and most of a thin bitmap is zeros, which Parquet packs.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from smeltworks.sources.scratch import materialise

_ROW_BITS = 33


def number_keys(keys: DataFrame, key: str, known: DataFrame | None = None) -> DataFrame:
    """``(key, number)`` for each distinct key that is not null, numbered from 1 without gaps.

    Keys of ``known``, an earlier result, keep their numbers; new ones follow. Which new key gets which number is left open.
    """
    new = keys.where(F.col(key).isNotNull()).select(key).distinct()
    if known is not None:
        new = new.join(known.select(key), key, "left_anti")
    placed = materialise(new.select(key, F.monotonically_increasing_id().alias("_at")), "keys")
    placed = placed.select(key, F.shiftright("_at", _ROW_BITS).alias("_part"), F.col("_at").bitwiseAND((1 << _ROW_BITS) - 1).alias("_row"))
    sizes = placed.groupBy("_part").agg(F.count("*").alias("n"))
    if known is not None:
        last = known.agg(F.lit(-1).cast("bigint").alias("_part"), F.coalesce(F.max("number"), F.lit(0)).alias("n"))
        sizes = sizes.unionByName(last)
    # One row per written partition.
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_start"))
    fresh = placed.join(starts, "_part").select(key, (F.col("_start") + F.col("_row") + 1).alias("number"))
    return fresh if known is None else known.select(key, "number").unionByName(fresh)


def member_bitmaps(rows: DataFrame, number: str, *groups: str) -> DataFrame:
    """``(*groups, bucket, members)``: who occurs in each group. Rows without a number count for nothing.

    Repeats go in the map tasks first; then a task gets at most 32,768 rows per group and bucket, and no bitmap travels.
    """
    once = rows.where(F.col(number).isNotNull()).select(*groups, F.col(number).alias("_number")).distinct()
    placed = once.select(*groups, F.bitmap_bucket_number("_number").alias("bucket"), F.bitmap_bit_position("_number").alias("_bit"))
    placed = placed.repartition(*groups, "bucket")
    return placed.groupBy(*groups, "bucket").agg(F.bitmap_construct_agg("_bit").alias("members"))


def merge_bitmaps(bitmaps: DataFrame, **groups: Column) -> DataFrame:
    """Bitmaps of coarser or other ``groups``, given as expressions over the old ones; also of a union of several sets of bitmaps."""
    renamed = bitmaps.select(*[c.alias(name) for name, c in groups.items()], "bucket", "members")
    return renamed.groupBy(*groups, "bucket").agg(F.bitmap_or_agg("members").alias("members"))


def count_members(bitmaps: DataFrame, *groups: str) -> DataFrame:
    """``(*groups, members)``: the exact number of distinct keys per group; ``bitmaps`` has one row per group and bucket."""
    return bitmaps.groupBy(*groups).agg(F.sum(F.bitmap_count("members")).alias("members"))


def distinct_by_period(daily: DataFrame, **groups: Column) -> DataFrame:
    """Distinct members per group, and ``summed``, what adding up the counts of the ``daily`` bitmaps gives."""
    merged = count_members(merge_bitmaps(daily, **groups), *groups)
    added = daily.select(*[c.alias(name) for name, c in groups.items()], F.bitmap_count("members").alias("n"))
    return merged.join(added.groupBy(*groups).agg(F.sum("n").alias("summed")), list(groups))

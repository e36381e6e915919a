"""Exact counts of distinct whole numbers by bitmaps, without moving the numbers.

Numbers are dealt to buckets of 32768; within a group, a bucket's numbers are bits of one bitmap. Each
task makes the bitmaps of its own rows, and only those are moved and merged. Where numbers lie together,
as ids handed out in sequence do in a table kept in key order, a task has few buckets, however many
rows. Where they are scattered, bitmaps are nearly empty and compress to some ten bytes, still
one a number.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def distinct_counts(df: DataFrame, groups: list[str], number: str, **flags: Column) -> DataFrame:
    """Per group of `df`: for each of `flags` how many distinct values the integer column `number` has in
    rows where that flag is true. NULL numbers and flags do not count."""
    known = df.filter(F.col(number).isNotNull())
    bit = F.bitmap_bit_position(number)
    bitmaps = known.groupBy(*groups, F.bitmap_bucket_number(number).alias("bucket")).agg(
        *[F.bitmap_construct_agg(F.when(flag, bit)).alias(name) for name, flag in flags.items()]
    )
    counts = [F.sum(F.bitmap_count(name)).alias(name) for name in flags]
    return bitmaps.groupBy(*groups).agg(*counts)

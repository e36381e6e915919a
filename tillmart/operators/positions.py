"""The position of each row in an order, without bringing all rows into one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillmart.sources import tables


def with_positions(df: DataFrame, order: list[Column], folder: str) -> DataFrame:
    """`df` with `position`, from 1, by `order`; rows that tie in it are ordered by their columns.

    Rows are dealt to tasks by ranges of the order and written to `folder`, with the number of their
    range. How many rows the ranges before have is a prefix sum over one row a range; within a range
    a row's position is its rank there.
    """
    spark = df.sparkSession
    by = [*order, *df.columns]
    tables.delete(spark, folder)
    ranged = df.repartitionByRange(*by).withColumn("range", F.spark_partition_id())
    ranged.write.parquet(folder)
    rows = spark.read.parquet(folder)
    before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    counts = rows.groupBy("range").agg(F.count(F.lit(1)).alias("rows"))
    bases = counts.select("range", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("base"))
    rank = F.row_number().over(Window.partitionBy("range").orderBy(*by))
    placed = rows.withColumn("rank", rank).join(bases, "range")
    return placed.select(*df.columns, (F.col("base") + F.col("rank")).alias("position"))

"""Data-quality checks. Each function returns the failing rows; none means passed."""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillmart.functions import utc_now


def violates_not_null(column: str) -> Column:
    return F.col(column).isNull()


def violates_accepted_values(column: str, values: Sequence[Any]) -> Column:
    """NULL passes."""
    return ~F.col(column).isin(list(values))


def violates_accepted_range(column: str, low: str, high: str) -> Column:
    """Bounds included, given as decimal text; NULL passes."""
    bound = "decimal(18,2)"
    return ~F.col(column).between(F.lit(low).cast(bound), F.lit(high).cast(bound))


def not_null(df: DataFrame, column: str) -> DataFrame:
    return df.filter(violates_not_null(column))


def accepted_values(df: DataFrame, column: str, values: Sequence[Any]) -> DataFrame:
    return df.filter(violates_accepted_values(column, values))


def accepted_range(df: DataFrame, column: str, low: str, high: str) -> DataFrame:
    return df.filter(violates_accepted_range(column, low, high))


def unique(df: DataFrame, column: str) -> DataFrame:
    """Values that occur more than once, and how often."""
    return (
        df.filter(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("n_records"))
        .filter(F.col("n_records") > 1)
    )


def orphan_counts(
    child: DataFrame, child_column: str, parent: DataFrame, parent_column: str
) -> DataFrame:
    """Child values without a parent, and how many rows have them.

    Counting first leaves one row per value and task, so a parent with very many
    children, known or unknown, is no burden on the join.
    """
    counts = (
        child.filter(F.col(child_column).isNotNull())
        .groupBy(child_column)
        .agg(F.count(F.lit(1)).alias("n_records"))
    )
    keys = parent.select(F.col(parent_column).alias(child_column)).distinct()
    return counts.join(keys, child_column, "left_anti")


def stores_created_after_first_transaction(fact: DataFrame, dim_stores: DataFrame) -> DataFrame:
    first = fact.groupBy("store_id").agg(F.min("transaction_at").alias("first_transaction_at"))
    return (
        dim_stores.join(first, "store_id")
        .filter(F.col("created_at") > F.col("first_transaction_at"))
        .select(
            "store_id",
            "store_name",
            "store_country",
            "store_typology",
            "created_at",
            "first_transaction_at",
        )
    )


def future_transactions(fact: DataFrame, now: Column | None = None) -> DataFrame:
    """One row with the number of transactions after `now` (default: the UTC clock), or none."""
    latest = utc_now() if now is None else now
    return (
        fact.filter(F.col("transaction_at") > latest)
        .agg(F.count(F.lit(1)).alias("future_transactions"))
        .filter(F.col("future_transactions") > 0)
    )

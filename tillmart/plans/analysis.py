"""The seven business reports.

Each one aggregates the fact by its own keys first and joins a dimension to the far
smaller result, so a hot store or device shrinks to one row per task before anything
moves. The count of distinct transactions per device type moves bitmaps of ids where ids are
not known to be unique, and the ids themselves only where they are no whole numbers.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillmart.functions import calendar_days, completed, count_ratio, elapsed_days, money_ratio
from tillmart.operators.bitmaps import distinct_counts
from tillmart.operators.ranking import dense_top_n

FIRST_DAYS = 90
ACTIVATION_RANK = 5


def _sales(fact: DataFrame, *keys: str) -> DataFrame:
    """Completed transactions per key: how many, their total, and how many have an amount."""
    totals = (
        fact.filter(completed())
        .groupBy(*keys)
        .agg(
            F.sum("amount_eur").alias("revenue"),
            F.count("amount_eur").alias("priced"),
            F.count_if(F.col("amount_eur").isNull()).alias("unpriced"),
        )
    )
    # With NULL amounts counted apart, the ranking needs all three aggregates, in this
    # order: both its readers then have equal plans and share one shuffle of the fact.
    return totals.select(
        *keys, "revenue", (F.col("priced") + F.col("unpriced")).alias("sales"), "priced"
    )


def top_stores(fact: DataFrame, dim_stores: DataFrame, n: int = 10) -> DataFrame:
    """Stores by completed revenue, then count. Transactions of no known store form one group."""
    ranked = dense_top_n(_sales(fact, "store_id"), n, "revenue", "sales")
    attributes = dim_stores.select(
        F.col("store_id").alias("known_store"), "store_name", "store_country", "store_typology"
    )
    return (
        ranked.join(attributes, F.col("store_id") == F.col("known_store"), "left")
        # By the key too: sorted by rank alone, all tied rows would be in one task.
        .orderBy("rank", "store_id")
        .select(
            F.col("known_store").alias("store_id"),
            "store_name",
            "store_country",
            "store_typology",
            F.col("sales").alias("transaction_count"),
            F.col("revenue").alias("total_amount_eur"),
            money_ratio(F.col("revenue"), F.col("priced")).alias("avg_transaction_amount_eur"),
            "rank",
        )
    )


def top_products(fact: DataFrame, n: int = 10) -> DataFrame:
    """Products by completed revenue, then count. A product code is unique within a store only."""
    ranked = dense_top_n(_sales(fact, "store_id", "product_sku"), n, "revenue", "sales")
    return ranked.select(
        "store_id",
        "product_sku",
        F.col("sales").alias("times_sold"),
        F.col("revenue").alias("total_revenue_eur"),
        money_ratio(F.col("revenue"), F.col("priced")).alias("avg_amount_eur"),
        "rank",
    ).orderBy("rank", "store_id", "product_sku")


def transactions_by_device_type(fact: DataFrame, dim_devices: DataFrame) -> DataFrame:
    """Share of all transactions per device type; unknown devices form a NULL type."""
    per_device = fact.groupBy("device_id").agg(F.count(F.lit(1)).alias("transactions"))
    per_type = (
        per_device.join(dim_devices.select("device_id", "device_type"), "device_id", "left")
        .groupBy("device_type")
        .agg(F.sum("transactions").alias("device_count"))
    )
    # One row per device type is left, so the unpartitioned window is a handful of rows.
    total = F.sum("device_count").over(Window.partitionBy())
    return per_type.select(
        "device_type",
        "device_count",
        count_ratio(F.col("device_count"), total, 2, times=100).cast("double").alias("percentage"),
    ).orderBy(F.col("percentage").desc())


def amount_by_typology_country(fact: DataFrame, dim_stores: DataFrame) -> DataFrame:
    """Amounts of all transactions per store country and typology."""
    per_store = fact.groupBy("store_id").agg(
        F.count(F.lit(1)).alias("transactions"),
        F.count("amount_eur").alias("priced"),
        F.sum("amount_eur").alias("amount"),
        F.min("amount_eur").alias("smallest"),
        F.max("amount_eur").alias("largest"),
    )
    places = dim_stores.select("store_id", "store_country", "store_typology")
    return (
        per_store.join(places, "store_id", "left")
        .groupBy("store_country", "store_typology")
        .agg(
            F.sum("transactions").alias("transaction_count"),
            F.sum("amount").cast("decimal(28,2)").alias("total_amount_eur"),
            money_ratio(F.sum("amount"), F.sum("priced")).alias("avg_amount_eur"),
            F.min("smallest").alias("min_amount_eur"),
            F.max("largest").alias("max_amount_eur"),
        )
        .orderBy("store_country", "store_typology")
    )


def time_to_fifth_transaction(fact: DataFrame, dim_stores: DataFrame) -> DataFrame:
    """Days from a store's creation to its fifth transaction, over stores that got there.

    The rank limit is applied within each task before the shuffle, so at most five rows
    per task and store move, however many transactions a store has.
    """
    by_time = Window.partitionBy("store_id").orderBy("transaction_at")
    fifth = (
        # No store: cannot match a dimension row, and would be one large group.
        fact.filter(F.col("store_id").isNotNull())
        .select("store_id", "transaction_at", F.row_number().over(by_time).alias("position"))
        .filter(F.col("position") == ACTIVATION_RANK)
    )
    days = elapsed_days(F.col("created_at"), F.col("transaction_at"))
    activated = (
        fifth.join(dim_stores.select("store_id", "created_at"), "store_id")
        .filter(F.col("transaction_at") >= F.col("created_at"))
        .select(days.cast("bigint").alias("days"))
    )
    stores = F.count(F.lit(1))
    return activated.agg(
        count_ratio(F.sum("days"), stores, 2).alias("avg_days_to_5th_tx"),
        F.min("days").alias("min_days_to_5th_tx"),
        F.max("days").alias("max_days_to_5th_tx"),
        stores.alias("stores_with_5_tx"),
    )


def _distinct_transactions(typed: DataFrame) -> DataFrame:
    """Distinct ids, and distinct ids with a success, per type: by bitmaps if ids are whole numbers.
    Otherwise equal ids are brought together by (type, id), carrying nothing but a flag."""
    if isinstance(typed.schema["transaction_id"].dataType, T.IntegralType):
        return distinct_counts(
            typed,
            ["counted_type"],
            "transaction_id",
            total_transactions=F.lit(True),
            successful_transactions=F.col("success"),
        )
    return (
        typed.groupBy("counted_type", "transaction_id")
        .agg(F.max("success").alias("success"))
        .groupBy("counted_type")
        .agg(
            F.count("transaction_id").alias("total_transactions"),
            F.count(F.when(F.col("success"), F.col("transaction_id"))).alias(
                "successful_transactions"
            ),
        )
    )


def device_efficiency(
    fact: DataFrame, dim_devices: DataFrame, unique_keys: bool = False
) -> DataFrame:
    """Volume, success and revenue per device type.

    Everything but the transaction counts comes from one row per device, store and task.
    Pass `unique_keys` where the uniqueness checks on the fact and the device dimension
    have passed: the transaction counts then come from there as well. Otherwise they are those
    of distinct ids, see `_distinct_transactions`.
    """
    types = dim_devices.select("device_id", "device_type")
    per_type = (
        fact.groupBy("device_id", "store_id")
        .agg(
            F.count(F.lit(1)).alias("transactions"),
            F.count_if(completed()).alias("successes"),
            F.sum(F.when(completed(), F.col("amount_eur")).otherwise(F.lit(0))).alias("revenue"),
            F.count(F.when(completed(), F.col("amount_eur"))).alias("priced"),
        )
        .join(types, "device_id", "left")
        .groupBy("device_type")
        .agg(
            F.count_distinct("store_id").alias("stores_using"),
            F.count_distinct("device_id").alias("unique_devices"),
            F.sum("transactions").alias("total_transactions"),
            F.sum("successes").alias("successful_transactions"),
            F.sum("revenue").cast("decimal(28,2)").alias("revenue"),
            F.sum("priced").alias("priced"),
        )
    )
    if not unique_keys:
        typed = fact.select("device_id", "transaction_id", completed().alias("success")).join(
            types, "device_id", "left"
        )
        counted = _distinct_transactions(typed.withColumnRenamed("device_type", "counted_type"))
        per_type = (
            per_type.drop("total_transactions", "successful_transactions")
            .join(counted, F.col("device_type").eqNullSafe(F.col("counted_type")), "left")
            .fillna(0, ["total_transactions", "successful_transactions"])
        )

    transactions, devices = F.col("total_transactions"), F.col("unique_devices")
    stores, euros = F.col("stores_using"), F.col("revenue")
    return per_type.select(
        "device_type",
        "stores_using",
        "unique_devices",
        "total_transactions",
        "successful_transactions",
        count_ratio(F.col("successful_transactions"), transactions, 2, times=100)
        .cast("double")
        .alias("success_rate_pct"),
        euros.alias("total_revenue_eur"),
        money_ratio(euros, F.col("priced")).alias("avg_transaction_value_eur"),
        count_ratio(transactions, devices, 1).cast("double").alias("avg_transactions_per_device"),
        money_ratio(euros, devices).alias("avg_revenue_per_device_eur"),
        count_ratio(transactions, stores, 1).cast("double").alias("avg_transactions_per_store"),
        money_ratio(euros, stores).alias("avg_revenue_per_store_eur"),
    ).orderBy(F.col("total_revenue_eur").desc())


def store_adoption(
    fact: DataFrame, dim_stores: DataFrame, unique_keys: bool = False
) -> DataFrame:
    """Cumulative activity of stores by day since creation, days 0 to 90.

    A store counts on the days it traded; days without trade are not filled in.
    Later days are dropped first, by a semi join with the stores' creation dates: Catalyst
    broadcasts them where they are few, else the adaptive join splits a hot store. Then
    transactions are reduced to one row per store and date.
    `unique_keys` as in `device_efficiency`.
    """
    distinct_count = F.count if unique_keys else F.count_distinct
    opened = dim_stores.select("store_id", "created_at")
    # Rows without a store or a date have no day offset and fall out below anyway.
    trades = fact.filter(F.col("store_id").isNotNull() & F.col("transaction_at").isNotNull())
    opening = opened.select(F.col("store_id").alias("opened_store"), "created_at")
    offset = calendar_days(F.col("created_at"), F.col("transaction_at"))
    in_first_days = (F.col("store_id") == F.col("opened_store")) & offset.between(0, FIRST_DAYS)
    trades = trades.join(opening, in_first_days, "left_semi")
    daily = trades.groupBy("store_id", F.to_date("transaction_at").alias("traded_on")).agg(
        distinct_count("transaction_id").alias("transactions"),
        F.sum(F.when(completed(), F.col("amount_eur")).otherwise(F.lit(0))).alias("revenue"),
    )
    if not unique_keys:
        # Equal dimension rows would repeat a store's revenue but not its transactions.
        opened = opened.groupBy("store_id", "created_at").agg(F.count(F.lit(1)).alias("copies"))
    day = calendar_days(F.col("created_at"), F.col("traded_on"))
    first_days = (
        daily.join(opened, "store_id")
        .withColumn("milestone_day", day.cast("bigint"))
        .filter(F.col("milestone_day").between(0, FIRST_DAYS))
    )
    if not unique_keys:
        revenue = (F.col("revenue") * F.col("copies")).cast("decimal(28,2)")
        first_days = first_days.withColumn("revenue", revenue)
    so_far = (
        Window.partitionBy("store_id")
        .orderBy("milestone_day")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    running = first_days.select(
        "store_id",
        "milestone_day",
        F.sum("transactions").over(so_far).alias("transactions"),
        F.sum("revenue").over(so_far).alias("revenue"),
        F.count(F.lit(1)).over(so_far).alias("active_days"),
    )
    rows = F.count(F.lit(1))
    return (
        running.groupBy("milestone_day")
        .agg(
            distinct_count("store_id").alias("stores_in_sample"),
            count_ratio(F.sum("transactions"), rows, 1).cast("double").alias("avg_transactions"),
            F.min("transactions").alias("min_transactions"),
            F.max("transactions").alias("max_transactions"),
            money_ratio(F.sum("revenue"), F.count("revenue")).alias("avg_revenue_eur"),
            count_ratio(F.sum("active_days"), rows, 1).cast("double").alias("avg_active_days"),
        )
        .orderBy("milestone_day")
    )

"""The star schema: the store of each transaction, two dimensions, one fact."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

FACT_COLUMNS = (
    "transaction_id",
    "device_id",
    "store_id",
    "product_sku",
    "amount_eur",
    "transaction_status",
    "transaction_at",
    "record_created_at",
)


def int_transactions_joined(stg_transactions: DataFrame, stg_devices: DataFrame) -> DataFrame:
    """Each transaction with the store of its device; unknown devices leave it NULL.

    The only place a whole transaction is ever shuffled, and only where the two device
    columns are too large to broadcast. A device with very many transactions is then
    split by the adaptive skew join; bucketing by device would take that away.
    """
    store_of_device = stg_devices.select("device_id", "store_id")
    return stg_transactions.join(store_of_device, "device_id", "left").select(
        *FACT_COLUMNS, F.current_timestamp().alias("dbt_updated_at")
    )


def fact_transactions(int_transactions_joined: DataFrame) -> DataFrame:
    return int_transactions_joined.select(
        *FACT_COLUMNS, F.current_timestamp().alias("dbt_updated_at")
    )


def dim_stores(stg_stores: DataFrame) -> DataFrame:
    return stg_stores.drop("dbt_loaded_at").withColumn("dbt_updated_at", F.current_timestamp())


def dim_devices(stg_devices: DataFrame) -> DataFrame:
    return stg_devices.drop("dbt_loaded_at").withColumn("dbt_updated_at", F.current_timestamp())

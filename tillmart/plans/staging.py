"""Raw tables renamed, typed and cleaned; one row in, one row out."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillmart.functions import clean_product_sku, normalise_status, to_amount

STORE_COLUMNS = ("name", "address", "city", "country", "typology")


def stg_stores(stores: DataFrame) -> DataFrame:
    return stores.select(
        F.col("id").alias("store_id"),
        *[F.col(name).alias(f"store_{name}") for name in STORE_COLUMNS],
        "customer_id",
        "created_at",
        F.current_timestamp().alias("dbt_loaded_at"),
    )


def stg_devices(devices: DataFrame) -> DataFrame:
    return devices.select(
        F.col("id").alias("device_id"),
        F.col("type").alias("device_type"),
        "store_id",
        F.current_timestamp().alias("dbt_loaded_at"),
    )


def stg_transactions(transactions: DataFrame) -> DataFrame:
    """Card numbers end here: no later table carries them."""
    sku = F.col("product_sku")
    return transactions.select(
        F.col("id").alias("transaction_id"),
        "device_id",
        sku.alias("product_sku_raw"),
        clean_product_sku(sku).alias("product_sku"),
        to_amount(F.col("amount")).alias("amount_eur"),
        normalise_status(F.col("status")).alias("transaction_status"),
        F.col("happened_at").alias("transaction_at"),
        F.col("created_at").alias("record_created_at"),
        F.current_timestamp().alias("dbt_loaded_at"),
    )

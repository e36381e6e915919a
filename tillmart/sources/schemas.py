"""Column names and types of the raw tables and of the incremental one."""

from __future__ import annotations

from pyspark.sql import types as T

BIGINT, TEXT, DOUBLE = T.LongType(), T.StringType(), T.DoubleType()
MOMENT, AUDIT = T.TimestampNTZType(), T.TimestampType()


def _schema(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, data_type) for name, data_type in columns.items()])


# The raw columns and their types, as staging expects them.
RAW_SCHEMAS = {
    "stores": _schema(
        id=BIGINT,
        name=TEXT,
        address=TEXT,
        city=TEXT,
        country=TEXT,
        typology=TEXT,
        customer_id=BIGINT,
        created_at=MOMENT,
    ),
    "devices": _schema(id=BIGINT, type=BIGINT, store_id=BIGINT, created_at=MOMENT),
    "transactions": _schema(
        id=BIGINT,
        device_id=BIGINT,
        product_sku=TEXT,
        amount=DOUBLE,
        status=TEXT,
        card_number=TEXT,
        happened_at=MOMENT,
        created_at=MOMENT,
    ),
}

# Added to the written raw transactions: the date of created_at, which Parquet can filter by.
CREATED_ON = "created_on"

STG_TRANSACTIONS = _schema(
    transaction_id=BIGINT,
    device_id=BIGINT,
    product_sku_raw=TEXT,
    product_sku=TEXT,
    amount_eur=T.DecimalType(18, 2),
    transaction_status=TEXT,
    transaction_at=MOMENT,
    record_created_at=MOMENT,
    dbt_loaded_at=AUDIT,
)

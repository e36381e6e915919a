"""The small lookup of device types."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Device type and what it is called.
DEVICE_DESCRIPTIONS = [
    (1, "Countertop terminal"),
    (2, "Mobile card reader"),
    (3, "Smartphone app-only"),
    (4, "QR reader"),
    (5, "App-only"),
]
SEED_SCHEMA = "device_id bigint, device_description string"


def device_descriptions(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(DEVICE_DESCRIPTIONS, SEED_SCHEMA)


def read_seed(spark: SparkSession, path: str) -> DataFrame:
    """The same lookup from a CSV file whose header may carry trailing blanks."""
    return (
        spark.read.option("header", True)
        .option("ignoreTrailingWhiteSpace", True)
        .option("enforceSchema", False)
        .schema(SEED_SCHEMA)
        .csv(path)
    )

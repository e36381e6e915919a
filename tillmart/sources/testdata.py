"""Raw stores, devices and transactions derived from the driver's customer and event tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


# Columns used of each table; given, so that no job has to look for them.
COLUMNS = {
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_mktsegment string",
    "nation": "n_nationkey int, n_name string",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
    "value double, props string",
}


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.schema(COLUMNS[table]).parquet(f"{sf_dir}/{table}.parquet")


OPENED = """timestamp_ntz'2023-12-25 00:00:00' + make_dt_interval(
    cast(c_custkey % 20 as int), cast(c_custkey * 7 % 24 as int))"""
DIGITS = "regexp_extract(props, '[0-9]+', 0)"


def stores(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = _read(spark, sf_dir, "customer")
    # Visibly one row per key, so that reports without the country need not join it.
    nations = _read(spark, sf_dir, "nation").dropDuplicates(["n_nationkey"])
    return customers.join(nations, customers.c_nationkey == nations.n_nationkey, "left").selectExpr(
        "c_custkey as id",
        "c_name as name",
        "concat('Street ', c_custkey % 97) as address",
        "concat('City ', c_custkey % 13) as city",
        "n_name as country",
        "c_mktsegment as typology",
        "c_custkey as customer_id",
        f"{OPENED} as created_at",
    )


def devices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two devices per store."""
    pairs = _read(spark, sf_dir, "customer").selectExpr(
        "c_custkey", "explode(array(c_custkey * 2, c_custkey * 2 + 1)) as device"
    )
    return pairs.selectExpr(
        "device as id",
        "device % 5 + 1 as type",
        "c_custkey as store_id",
        f"{OPENED} as created_at",
    )


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every 97th transaction comes from a device that does not exist."""
    return _read(spark, sf_dir, "events").selectExpr(
        "event_id as id",
        "if(event_id % 97 = 0, -1, user_id * 2 + event_id % 2) as device_id",
        f"""case event_id % 3 when 0 then concat('v', {DIGITS}) when 1 then concat({DIGITS}, '.0')
            else {DIGITS} end as product_sku""",
        "value as amount",
        """case event_type when 'error' then 'refused' when 'signup' then 'cancelled'
            else 'accepted' end as status""",
        "'4000-0000' as card_number",
        "ts as happened_at",
        "ts + make_dt_interval(0, cast(event_id % 7 as int), 5) as created_at",
    )


RAW_TABLES = {"stores": stores, "devices": devices, "transactions": transactions}

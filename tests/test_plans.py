"""Physical plans: what is read, shuffled and brought together."""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import replace

import pytest
from conftest import TESTDATA
from pyspark.sql import functions as F

import __spark_entry__ as entry
from tillmart.plans import analysis, build, marts, quality

SF_DIR = f"{TESTDATA}/sf0.001"


def initial_plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def final_plan(df):
    df.collect()
    return initial_plan(df).split("== Initial Plan ==")[0]


@pytest.fixture(scope="module")
def warehouse(spark):
    return entry.built(spark, SF_DIR)


def report(warehouse, name):
    return build.MODELS[name].query(warehouse)


@pytest.mark.parametrize("name", [*entry.ON_MODELS, *entry.ON_FILES])
def test_no_python_and_no_products_in_any_query(spark, name):
    plan = initial_plan(entry.queries()[name](spark, SF_DIR))
    for operator in ("Python", "ArrowEval", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert operator not in plan


@pytest.mark.parametrize("name", ["top_10_stores", "top_10_products"])
def test_top_n_shuffles_the_fact_once(warehouse, name):
    plan = final_plan(report(warehouse, name))
    assert len(re.findall(r"FileScan parquet.*amount_eur", plan)) == 1
    assert "ReusedExchange" in plan


def test_top_n_reads_only_what_it_needs(warehouse):
    plan = initial_plan(report(warehouse, "top_10_stores"))
    assert "EqualTo(transaction_status,completed)" in plan
    schemas = re.findall(r"ReadSchema: struct<([^>]*transaction_status[^>]*)>", plan)
    assert {re.sub(r":[^,]*(\(18)?", "", schema) for schema in schemas} == {
        "store_id,amount_eur,2),transaction_status"
    }


def test_fifth_transaction_is_limited_before_the_shuffle(warehouse):
    plan = initial_plan(report(warehouse, "avg_time_to_5_transactions"))
    limits = re.findall(r"WindowGroupLimit .*row_number\(\), 5, (\w+)", plan)
    assert limits == ["Final", "Partial"]


@pytest.mark.parametrize(
    "name",
    [
        "percentage_transactions_by_device",
        "avg_amount_by_typology_country",
        "device_efficiency",
        "store_adoption",
    ],
)
def test_the_fact_is_aggregated_before_it_is_joined(spark, warehouse, name):
    """Going up from the scan of the fact, a partial aggregate comes before any shuffle."""
    unique = replace(warehouse, unique_keys=True)
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    try:
        lines = initial_plan(report(unique, name)).splitlines()
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    scans = [i for i, line in enumerate(lines) if "FileScan" in line and "fact_transactions" in line]
    assert len(scans) == 1
    depth, operators = len(lines[scans[0]]), []
    for line in reversed(lines[: scans[0]]):
        indent = len(re.match(r"[\s:+-]*", line)[0])
        if indent < depth:
            depth = indent
            operators.append(line.strip(" :+-").split("(")[0].split(" ")[0])
    moved = ("Aggregate", "SortMergeJoin", "ShuffledHashJoin", "Exchange")
    first = next(op for op in operators if any(word in op for word in moved))
    assert "Aggregate" in first


@pytest.mark.parametrize("threshold", ["32MB", "-1"])
def test_adoption_drops_later_days_first_at_any_size(spark, warehouse, threshold):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        plan = initial_plan(report(warehouse, "store_adoption"))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    semi_joins = re.findall(r"(\w+)Join .*LeftSemi", plan)
    assert semi_joins == ["BroadcastHash" if threshold != "-1" else "SortMerge"]


def test_unique_keys_spare_the_distinct_transactions(warehouse):
    checked = initial_plan(report(replace(warehouse, unique_keys=True), "device_efficiency"))
    unchecked = initial_plan(report(warehouse, "device_efficiency"))
    assert "transaction_id" not in checked
    assert "transaction_id" in unchecked
    moved = [line for line in unchecked.splitlines() if "Exchange" in line]
    assert moved and not any("transaction_id" in line for line in moved)


def test_ids_that_are_no_numbers_are_counted_too(warehouse):
    fact, devices = warehouse.table("fact_transactions"), warehouse.table("dim_devices")
    texts = fact.withColumn("transaction_id", fact["transaction_id"].cast("string"))
    found = [analysis.device_efficiency(f, devices).collect() for f in (fact, texts)]
    assert found[0] == found[1]


def test_outer_join_of_adoption_needs_no_nulls(spark):
    plan = initial_plan(entry.queries()["store_adoption"](spark, SF_DIR))
    assert "LeftOuter" not in plan
    assert "n_nationkey" not in plan  # the country is not needed
    assert re.search(r"BroadcastHashJoin .*LeftSemi", plan)


SHUFFLE_JOINS = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10KB",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
}


@pytest.mark.parametrize("hot", [7, None])
def test_a_hot_device_is_split(spark, hot):
    """Where devices cannot be broadcast, a device with most transactions is no single task."""
    before = {key: spark.conf.get(key, None) for key in SHUFFLE_JOINS}
    for key, value in SHUFFLE_JOINS.items():
        spark.conf.set(key, value)
    try:
        ids = spark.range(0, 100_000, numPartitions=8)
        transactions = ids.select(
            F.col("id").alias("transaction_id"),
            F.when(F.col("id") % 2 == 0, F.lit(hot)).otherwise(F.col("id") % 1000).alias("device_id"),
            *[F.col("id").cast("string").alias(n) for n in marts.FACT_COLUMNS if n not in KEYS],
        )
        devices = spark.range(0, 1000).select(
            F.col("id").alias("device_id"), (F.col("id") % 10).alias("store_id")
        )
        fact = marts.int_transactions_joined(transactions, devices)
        per_device = fact.groupBy("device_id").agg(F.count("product_sku"), F.max("store_id"))
        plan = final_plan(per_device)
        assert "skew=true" in plan
        counts = {row[0]: row[1] for row in per_device.collect()}
        assert counts[hot] == 50_000 + (100 if hot else 0) and sum(counts.values()) == 100_000
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


KEYS = ("transaction_id", "device_id", "store_id")


def test_small_dimensions_are_broadcast_by_size(warehouse):
    plan = initial_plan(report(warehouse, "avg_amount_by_typology_country"))
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_many_devices_in_a_small_file_are_not_broadcast(spark, warehouse, tmp_path):
    """Ids in sequence take next to no space in a file, but all of it in the driver."""
    path = str(tmp_path / "devices")
    ids = spark.range(500_000, numPartitions=2)
    ids.selectExpr("id as device_id", "id div 2 as store_id").write.parquet(path)
    devices = spark.read.parquet(path)
    joined = marts.int_transactions_joined(warehouse.table("stg_transactions"), devices)
    assert "Broadcast" not in final_plan(joined)


def test_no_report_ranks_or_sums_the_fact_in_one_task(warehouse):
    """A single-partition exchange is fed by a global aggregate or by one row per group."""
    for name in build.select(tags=["analysis"]):
        plan = initial_plan(report(warehouse, name))
        for before, line in zip(plan.splitlines(), plan.splitlines()[1:], strict=False):
            if "Exchange SinglePartition" in before:
                assert "HashAggregate" in line


def test_tied_rows_are_dealt_to_many_tasks(spark):
    ties = spark.range(200_000).select(
        F.col("id").alias("store_id"),
        F.lit("a").alias("product_sku"),
        F.lit("1.00").cast("decimal(18,2)").alias("amount_eur"),
        F.lit("completed").alias("transaction_status"),
    )
    small = {
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "200KB",
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "50KB",
    }
    before = {key: spark.conf.get(key) for key in small}
    for key, value in small.items():
        spark.conf.set(key, value)
    try:
        products = analysis.top_products(ties)
        parts = products.select(F.spark_partition_id().alias("part"), "store_id").collect()
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    sizes = Counter(row["part"] for row in parts)
    assert len(parts) == 200_000 and len(sizes) > 1 and max(sizes.values()) < 100_000
    assert [row["store_id"] for row in parts] == list(range(200_000))


def test_checks_read_the_fact_four_times(spark, warehouse):
    """Once for all its single-row checks, once for its key, and once for each parent."""
    tables = {name: warehouse.table(name) for name in quality.NOT_NULL}
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    try:
        plan = initial_plan(quality.run_checks(tables))
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    places = [line for line in plan.splitlines() if "FileScan" in line]
    scans = Counter(
        next((t for t in ("fact_transactions", "stg_transactions") if f"/{t}" in line), "other")
        for line in places
    )
    assert scans["fact_transactions"] == 4
    assert scans["stg_transactions"] == 3  # two of its own, one of the view


def test_analysis_has_no_hints():
    """Join strategy is left to the optimizer's size check."""
    import inspect

    assert "F.broadcast(" not in inspect.getsource(analysis) + inspect.getsource(marts)

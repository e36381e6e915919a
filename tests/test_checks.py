"""Each check on a table that violates it."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F
from test_reports import DEVICES, FACT, NOON, STORES, tuples

from tillmart.operators import checks
from tillmart.plans import quality


@pytest.fixture
def fact(rows):
    return rows(
        FACT,
        (1, 1, 1, "a", "0.01", "completed", NOON, NOON),
        (2, 1, 1, "a", "100000.00", "failed", NOON, NOON),
        (2, 7, 1, "a", "0.00", "other", "2999-01-01 00:00:00", NOON),
        (None, 7, 8, "a", "100000.01", None, NOON, NOON),
        (None, None, None, None, None, "cancelled", None, None),
    )


def test_not_null(fact):
    assert checks.not_null(fact, "transaction_id").count() == 2


def test_unique_ignores_null(fact):
    assert tuples(checks.unique(fact, "transaction_id")) == [(2, 2)]


def test_accepted_values_let_null_pass(fact):
    found = checks.accepted_values(fact, "transaction_status", quality.STATUSES)
    assert tuples(found, "transaction_status") == [("other",)]


def test_accepted_range_includes_its_bounds(fact):
    found = checks.accepted_range(fact, "amount_eur", "0.01", "100000.00")
    assert sorted(str(row[0]) for row in tuples(found, "amount_eur")) == ["0.00", "100000.01"]


def test_orphan_counts_ignore_null(rows, fact):
    found = checks.orphan_counts(fact, "device_id", rows(DEVICES, (1, 1, 1)), "device_id")
    assert tuples(found) == [(7, 2)]


def test_stores_created_after_first_transaction(rows, fact):
    stores = rows(
        STORES,
        (1, "late", "DE", "x", "2024-01-01 12:00:01"),
        (8, "in time", "DE", "x", NOON),
        (9, "idle", "DE", "x", NOON),
    )
    found = checks.stores_created_after_first_transaction(fact, stores)
    assert tuples(found, "store_id", "store_name") == [(1, "late")]


def test_future_transactions(fact):
    assert tuples(checks.future_transactions(fact)) == [(1,)]
    never = F.lit("3000-01-01 00:00:00").cast("timestamp_ntz")
    assert tuples(checks.future_transactions(fact, never)) == []


def test_there_are_49_checks():
    kinds = [check.kind for check in quality.CHECKS]
    assert {kind: kinds.count(kind) for kind in set(kinds)} == {
        "not_null": 33,
        "unique": 7,
        "accepted_values": 3,
        "relationships": 3,
        "accepted_range": 1,
        "created_after_first_transaction": 1,
        "in_the_future": 1,
    }
    assert sum(check.severity == quality.WARN for check in quality.CHECKS) == 5


@pytest.fixture
def results(rows, fact):
    dims = {
        "dim_stores": rows(
            STORES + ", customer_id bigint, dbt_updated_at timestamp",
            (1, "a", "DE", "x", "2024-02-01 00:00:00", 1, NOON),
            (1, "a", None, "x", NOON, 1, NOON),
        ),
        "dim_devices": rows(DEVICES + ", dbt_updated_at timestamp", (1, 6, 1, NOON), (2, 1, 9, NOON)),
    }
    return quality.run_checks({"fact_transactions": fact, **dims})


def test_run_checks(results):
    failed = {tuple(r)[:3]: r["failures"] for r in results.collect() if r["failures"]}
    assert failed == {
        ("not_null", "fact_transactions", "transaction_id"): 2,
        ("not_null", "fact_transactions", "device_id"): 1,
        ("not_null", "fact_transactions", "store_id"): 1,
        ("not_null", "fact_transactions", "product_sku"): 1,
        ("not_null", "fact_transactions", "amount_eur"): 1,
        ("not_null", "fact_transactions", "record_created_at"): 1,
        ("not_null", "dim_stores", "store_country"): 1,
        ("unique", "fact_transactions", "transaction_id"): 1,
        ("unique", "dim_stores", "store_id"): 1,
        ("accepted_values", "fact_transactions", "transaction_status"): 1,
        ("accepted_range", "fact_transactions", "amount_eur"): 2,
        ("relationships", "dim_devices", "store_id"): 1,
        ("relationships", "fact_transactions", "device_id"): 2,
        ("relationships", "fact_transactions", "store_id"): 1,
        ("created_after_first_transaction", "dim_stores", "created_at"): 1,
        ("in_the_future", "fact_transactions", "transaction_at"): 1,
    }


def test_errors_stop_and_warnings_pass(results):
    with pytest.raises(quality.ChecksFailed, match="unique dim_stores.store_id: 1"):
        quality.raise_on_error(results)
    quality.raise_on_error(results.filter("severity = 'warn'"))


def test_checks_of_an_empty_table_pass(rows):
    results = quality.run_checks({"fact_transactions": rows(FACT)})
    assert {row["failures"] for row in results.collect()} == {0}


def test_keys_are_unique_needs_all_six_key_checks(results):
    assert not quality.keys_are_unique(results)
    assert not quality.keys_are_unique(results.filter("false"))
    passed = results.withColumn("failures", F.lit(0).cast("bigint"))
    assert quality.keys_are_unique(passed)
    assert not quality.keys_are_unique(passed.filter("`table` != 'dim_devices'"))

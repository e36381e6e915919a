"""Reports on small hand-made tables."""

from __future__ import annotations

from decimal import Decimal

import pytest

from tillmart.operators.ranking import dense_top_n
from tillmart.plans import analysis

FACT = (
    "transaction_id bigint, device_id bigint, store_id bigint, product_sku string, "
    "amount_eur decimal(18,2), transaction_status string, transaction_at timestamp_ntz, "
    "record_created_at timestamp_ntz"
)
STORES = (
    "store_id bigint, store_name string, store_country string, store_typology string, "
    "created_at timestamp_ntz"
)
DEVICES = "device_id bigint, device_type bigint, store_id bigint"
NOON = "2024-01-01 12:00:00"


@pytest.fixture
def fact(rows):
    """Transactions given as (id, device, store, sku, amount, status, at)."""
    return lambda *values: rows(FACT, *[(*v, v[6]) for v in values])


def tuples(df, *columns):
    return [tuple(row) for row in (df.select(*columns) if columns else df).collect()]


def sales(store, *amounts, sku="a", status="completed", start=0):
    return [(start + i, store, store, sku, a, status, NOON) for i, a in enumerate(amounts)]


def test_dense_top_n_keeps_ties_and_leaves_no_gaps(rows):
    df = rows("k string, total int, n int", ("a", 100, 2), ("b", 100, 2), ("c", 100, 1), ("d", 90, 5))
    assert sorted(tuples(dense_top_n(df, 2, "total", "n"), "k", "rank")) == [
        ("a", 1),
        ("b", 1),
        ("c", 2),
    ]


def test_dense_top_n_ranks_null_last(rows):
    df = rows("k string, total int", ("a", None), ("b", 5), ("c", None))
    assert sorted(tuples(dense_top_n(df, 5, "total"), "k", "rank")) == [("a", 2), ("b", 1), ("c", 2)]


def test_dense_top_n_does_not_gather_ties(spark):
    """All rows tied: the single-task ranking still sees one row."""
    tied = spark.range(10_000).selectExpr("id", "id div 1000000 as total")
    top = dense_top_n(tied, 3, "total")
    assert top.count() == 10_000
    plan = top._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan and "Exchange SinglePartition" not in plan


def test_top_stores(rows, fact):
    f = fact(
        *sales(1, "60.00", "40.00"),
        *sales(2, "50.00", "50.00", start=10),
        *sales(3, "100.00", start=20),
        *sales(None, "99.00", start=30),
        *sales(4, "500.00", status="failed", start=40),
    )
    stores = rows(STORES, *[(i, f"s{i}", "DE", "cafe", NOON) for i in (1, 2, 4)])
    top = analysis.top_stores(f, stores, n=3)
    found = tuples(top, "store_id", "store_name", "transaction_count", "total_amount_eur", "rank")
    assert sorted(found, key=str) == sorted(
        [
            (1, "s1", 2, Decimal("100.00"), 1),
            (2, "s2", 2, Decimal("100.00"), 1),
            (None, None, 1, Decimal("100.00"), 2),  # a store without a dimension row
            (None, None, 1, Decimal("99.00"), 3),  # transactions without a store
        ],
        key=str,
    )
    assert [row["rank"] for row in top.collect()] == [1, 1, 2, 3]


def test_top_products_are_per_store(fact):
    f = fact(
        *sales(1, "5.00", "5.00"),
        *sales(2, "5.00", start=10),
        *sales(2, "1.00", None, sku="b", start=20),
    )
    columns = "store_id", "product_sku", "times_sold", "total_revenue_eur", "avg_amount_eur", "rank"
    assert tuples(analysis.top_products(f), *columns) == [
        (1, "a", 2, Decimal("10.00"), Decimal("5.00"), 1),
        (2, "a", 1, Decimal("5.00"), Decimal("5.00"), 2),
        (2, "b", 2, Decimal("1.00"), Decimal("1.00"), 3),  # a NULL amount counts as sold only
    ]


def test_transactions_by_device_type(rows, fact):
    f = fact(*[(i, d, 1, "a", "1.00", "failed", NOON) for i, d in enumerate([1, 1, 2, 9, None, 1])])
    devices = rows(DEVICES, (1, 5, 1), (2, 3, 1))
    assert sorted(tuples(analysis.transactions_by_device_type(f, devices)), key=str) == [
        (3, 1, 16.67),
        (5, 3, 50.0),
        (None, 2, 33.33),
    ]


def test_amount_by_typology_country(rows, fact):
    f = fact(
        *sales(1, "1.00", "2.00", status="failed"),
        *sales(2, "0.05", start=10),
        *sales(3, None, start=20),
    )
    stores = rows(STORES, (1, "a", "DE", "cafe", NOON), (2, "b", "DE", "cafe", NOON))
    assert tuples(analysis.amount_by_typology_country(f, stores)) == [
        (None, None, 1, None, None, None, None),
        ("DE", "cafe", 3, *map(Decimal, ("3.05", "1.02", "0.05", "2.00"))),
    ]


def at(*moments, store=1, start=0):
    return [
        (start + i, 1, store, "a", "1.00", "failed", moment) for i, moment in enumerate(moments)
    ]


def test_time_to_fifth_transaction(rows, fact):
    days = [f"2024-01-{d:02d} 11:00:00" for d in range(2, 9)]
    f = fact(
        *at(*days[::-1]),  # fifth on the 6th: four whole days
        *at(*days[:4], store=2, start=100),  # only four
        *at(*days, store=3, start=200),  # created after its fifth
        *at(*days, store=None, start=300),
        *at(*[days[0]] * 5, store=4, start=400),  # all at once
    )
    stores = rows(
        STORES,
        (1, "a", "DE", "x", NOON),
        (2, "b", "DE", "x", NOON),
        (3, "c", "DE", "x", "2024-02-01 00:00:00"),
        (4, "d", "DE", "x", NOON),
    )
    assert tuples(analysis.time_to_fifth_transaction(f, stores)) == [(Decimal("2.00"), 0, 4, 2)]


def test_time_to_fifth_transaction_without_any_store(rows, fact):
    result = analysis.time_to_fifth_transaction(fact(*at(NOON)), rows(STORES))
    assert tuples(result) == [(None, None, None, 0)]


def test_device_efficiency(rows, fact):
    f = fact(
        (1, 1, 10, "a", "2.00", "completed", NOON),
        (2, 1, 10, "a", "3.01", "completed", NOON),
        (3, 2, 11, "a", "9.00", "failed", NOON),
        (4, 3, None, "a", "1.00", "cancelled", NOON),
        (5, 3, None, "a", None, "completed", NOON),
    )
    devices = rows(DEVICES, (1, 5, 10), (2, 5, 11))
    expected = {
        (5, 2, 2, 3, 2, 66.67, Decimal("5.01"), Decimal("2.51"), 1.5, Decimal("2.51"), 1.5, Decimal("2.51")),
        (None, 0, 1, 2, 1, 50.0, Decimal("0.00"), None, 2.0, Decimal("0.00"), None, None),
    }
    for unique_keys in (False, True):
        found = analysis.device_efficiency(f, devices, unique_keys)
        assert set(tuples(found)) == expected


def test_device_efficiency_counts_repeated_ids_once(rows, fact):
    f = fact(
        (1, 1, 10, "a", "2.00", "completed", NOON),
        (1, 2, 11, "a", "3.00", "failed", NOON),
        (1, 3, 12, "a", "4.00", "failed", NOON),
        (None, 1, 10, "a", "5.00", "completed", NOON),
    )
    devices = rows(DEVICES, (1, 5, 10), (2, 5, 11), (3, 4, 12))
    columns = (
        "device_type",
        "stores_using",
        "unique_devices",
        "total_transactions",
        "successful_transactions",
        "total_revenue_eur",
    )
    assert tuples(analysis.device_efficiency(f, devices), *columns) == [
        (5, 2, 2, 1, 1, Decimal("7.00")),
        (4, 1, 1, 1, 0, Decimal("0.00")),
    ]


ADOPTION_STORES = [(1, "a", "DE", "x", NOON), (2, "b", "DE", "x", NOON)]


@pytest.mark.parametrize("unique_keys", [False, True])
def test_store_adoption_fills_no_gaps(rows, fact, unique_keys):
    f = fact(
        *sales(1, "1.00", "2.00"),
        (5, 1, 1, "a", "4.00", "failed", "2024-01-03 00:00:00"),
        *sales(2, "1.00", "1.00", "1.00", "1.00", start=10),
        (20, 1, 2, "a", "4.00", "completed", "2024-03-31 23:59:59"),  # day 90
        (21, 1, 2, "a", "4.00", "completed", "2024-04-01 00:00:00"),  # day 91
        (22, 1, 2, "a", "4.00", "completed", "2023-12-31 23:59:59"),  # day -1
        (23, 1, None, "a", "4.00", "completed", NOON),
    )
    found = analysis.store_adoption(f, rows(STORES, *ADOPTION_STORES), unique_keys)
    assert tuples(found) == [
        (0, 2, 3.0, 2, 4, Decimal("3.50"), 1.0),
        (2, 1, 3.0, 3, 3, Decimal("3.00"), 2.0),
        (90, 1, 5.0, 5, 5, Decimal("8.00"), 2.0),
    ]


def test_store_adoption_with_repeated_keys(rows, fact):
    """Equal ids on a day count once; equal dimension rows repeat the revenue only."""
    f = fact(*sales(1, "1.00", "2.00"), *sales(1, "2.00"))
    stores = rows(STORES, ADOPTION_STORES[0], ADOPTION_STORES[0])
    assert tuples(analysis.store_adoption(f, stores)) == [(0, 1, 2.0, 2, 2, Decimal("10.00"), 1.0)]


def test_store_adoption_without_broadcast(spark, rows, fact):
    """Dropping later days early, where stores can be broadcast, changes no result."""
    f = fact(
        *sales(1, "1.00", "2.00"),
        (5, 1, 1, "a", "4.00", "completed", "2024-03-31 23:59:59"),
        (6, 1, 1, "a", "4.00", "completed", "2024-04-01 00:00:00"),
        (7, 1, 9, "a", "4.00", "completed", NOON),
    )
    stores = rows(STORES, *ADOPTION_STORES)
    early = tuples(analysis.store_adoption(f, stores))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        late = tuples(analysis.store_adoption(f, stores))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert early == late and [row[0] for row in early] == [0, 90]

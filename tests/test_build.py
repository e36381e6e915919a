"""Raw files to reports, on disk."""

from __future__ import annotations

import os
from dataclasses import replace

import pytest

from tillmart.__main__ import main
from tillmart.plans import build, quality
from tillmart.sources import tables
from tillmart.sources.raw import ingest, read_csv
from tillmart.sources.schemas import RAW_SCHEMAS

STORES = "id,name,address,city,country,typology,customer_id,created_at\n"
DEVICES = "id,type,store_id,created_at\n"
TRANSACTIONS = "id,device_id,product_sku,amount,status,card_number,happened_at,created_at\n"


@pytest.fixture
def raw(tmp_path):
    root = tmp_path / "raw"

    def write(name, header, *lines):
        (root / name).mkdir(parents=True, exist_ok=True)
        (root / name / "part.csv").write_text(header + "\n".join(lines) + "\n")

    write("stores", STORES, "1,Shop,Street 1,Berlin,DE,cafe,5,2024-01-01 08:00:00")
    write("devices", DEVICES, "10,4,1,2024-01-01 08:00:00", ",,,")
    write("transactions", TRANSACTIONS, *transactions(range(6)))
    write.root, write.warehouse = str(root), str(tmp_path / "warehouse")
    return write


def transactions(keys, device=10):
    return [
        f"{k},{device},v{k}.0,{k + 1}.50,accepted,4000,2024-01-02 0{k}:00:00,2024-01-02 0{k}:05:00"
        for k in keys
    ]


REPORTS = [
    "top_10_stores",
    "top_10_products",
    "percentage_transactions_by_device",
    "avg_amount_by_typology_country",
    "avg_time_to_5_transactions",
    "device_efficiency",
    "store_adoption",
]


def test_build(spark, raw):
    warehouse = build.Warehouse(spark, raw.warehouse)
    results = build.build(warehouse, raw.root, "csv")
    assert results.count() == len(quality.CHECKS)
    assert results.filter("failures > 0").count() == 0
    for name in REPORTS:
        assert os.path.isdir(f"{raw.warehouse}/analysis/{name}")
    top = warehouse.table("top_10_stores").first()
    assert (top["store_name"], top["transaction_count"], str(top["total_amount_eur"])) == (
        "Shop",
        6,
        "24.00",
    )
    assert warehouse.table("fact_transactions").columns == [
        "transaction_id",
        "device_id",
        "store_id",
        "product_sku",
        "amount_eur",
        "transaction_status",
        "transaction_at",
        "record_created_at",
        "dbt_updated_at",
    ]
    assert "card_number" not in warehouse.table("stg_transactions").columns
    assert warehouse.table("device_efficiency").first()["total_transactions"] == 6


def test_second_build_adds_new_transactions(spark, raw):
    warehouse = build.Warehouse(spark, raw.warehouse)
    build.build(warehouse, raw.root, "csv")
    raw("transactions", TRANSACTIONS, *transactions([0, 8, 9]))
    build.build(warehouse, raw.root, "csv")
    keys = warehouse.table("fact_transactions").select("transaction_id").collect()
    assert sorted(row[0] for row in keys) == [0, 1, 2, 3, 4, 5, 8, 9]


def test_failed_error_checks_stop_before_the_reports(spark, raw):
    raw("transactions", TRANSACTIONS, *transactions(range(2)), *transactions([3], device=99))
    warehouse = build.Warehouse(spark, raw.warehouse)
    with pytest.raises(quality.ChecksFailed, match="not_null fact_transactions.store_id: 1"):
        build.build(warehouse, raw.root, "csv")
    assert not tables.is_complete(spark, f"{raw.warehouse}/analysis/store_adoption")
    again = replace(warehouse, full_refresh=True)
    results = build.build(again, raw.root, "csv", stop_on_error=False)
    assert results.filter("check = 'relationships' and failures = 1").count() == 1
    assert tables.is_complete(spark, f"{raw.warehouse}/analysis/store_adoption")


def test_repeated_ids_are_still_counted_once(spark, raw):
    """The shortcut for unique keys is not taken when the check found them repeated."""
    raw("transactions", TRANSACTIONS, *transactions([1, 1, 2]))
    warehouse = build.Warehouse(spark, raw.warehouse)
    build.build(warehouse, raw.root, "csv", stop_on_error=False)
    assert warehouse.table("device_efficiency").first()["total_transactions"] == 2


def test_checks_look_at_the_view_itself(spark, raw):
    """Staging has changed since the fact was written."""
    warehouse = build.Warehouse(spark, raw.warehouse)
    build.build(warehouse, raw.root, "csv")
    raw("transactions", TRANSACTIONS, *transactions(range(6)), *transactions([3]))
    ingest(spark, raw.warehouse, raw.root, "csv")
    build.run(replace(warehouse, full_refresh=True), models=["stg_transactions"])
    results = build.check(warehouse).filter("check = 'unique' and failures > 0").collect()
    assert {(r["table"], r["failures"]) for r in results} == {
        ("stg_transactions", 1),
        ("int_transactions_joined", 1),
    }


def test_selected_tables_only(spark, raw):
    warehouse = build.Warehouse(spark, raw.warehouse, top_products_n=2)
    build.build(warehouse, raw.root, "csv")
    assert warehouse.table("top_10_products").count() == 2
    wider = build.Warehouse(spark, raw.warehouse, top_products_n=3)
    assert build.run(wider, models=["top_10_products"]) == ["top_10_products"]
    assert warehouse.table("top_10_products").count() == 3


def test_tables_can_be_queried_by_name(spark, raw):
    warehouse = build.Warehouse(spark, raw.warehouse)
    build.build(warehouse, raw.root, "csv")
    warehouse.register()
    query = """
        select store_name, count(*) from fact_transactions join dim_stores using (store_id)
        where device_id in (select id from devices) group by 1"""
    assert [tuple(row) for row in spark.sql(query).collect()] == [("Shop", 6)]
    assert spark.table("store_adoption").columns == warehouse.table("store_adoption").columns


def test_command_line(spark, raw, capsys):
    def tillmart(*words):
        main([*words, "--warehouse", raw.warehouse])
        return capsys.readouterr().out

    tillmart("ingest", "--raw", raw.root, "--format", "csv")
    assert tillmart("run", "--models", "stg_transactions").split() == ["stg_transactions"]
    assert "dim_stores" in tillmart("run", "--tags", "marts")
    assert "unique" in tillmart("check")
    assert tillmart("run", "--models", "top_10_stores", "--top-stores-n", "3").split() == [
        "top_10_stores"
    ]
    tillmart("build", "--raw", raw.root, "--format", "csv", "--full-refresh")
    assert build.Warehouse(spark, raw.warehouse).table("store_adoption").count() == 1


def test_command_line_loads_new_files(spark, raw, tmp_path):
    files = tmp_path / "files"
    read_csv(spark, f"{raw.root}/transactions", RAW_SCHEMAS["transactions"]).write.parquet(
        str(files / "transactions")
    )
    for _ in range(2):
        main(["load-files", "--warehouse", raw.warehouse, "--raw", str(files)])
    assert build.Warehouse(spark, raw.warehouse).table("stg_transactions").count() == 6


def test_select():
    assert build.select(tags=["dimensions"]) == ["dim_stores", "dim_devices"]
    assert build.select(tags=["facts"]) == ["fact_transactions"]
    assert build.select(tags=["analysis"]) == REPORTS
    assert build.select(["store_adoption"], ["facts"]) == ["fact_transactions", "store_adoption"]
    assert build.select(["stg_transactions", "stg_stores"]) == ["stg_transactions"]
    assert len(build.select()) == 11
    with pytest.raises(ValueError, match="nonsense"):
        build.select(["nonsense"])

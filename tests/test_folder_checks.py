"""Checks that read only the folders of the merged table that changed."""

from __future__ import annotations

import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tillmart.plans import quality
from tillmart.plans.folder_checks import run_folder_checks, served
from tillmart.plans.incremental import transactions_table
from tillmart.sources.schemas import STG_TRANSACTIONS

COLUMNS = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in STG_TRANSACTIONS.fields)


@pytest.fixture
def table(tmp_path):
    return transactions_table(str(tmp_path / "warehouse"), keys_per_range=10, folders=5)


def batch(rows, seed, keys, number):
    rng = random.Random(seed)
    values = []
    for _ in range(number):
        key = rng.choice([None, *keys])
        status = rng.choice(["completed", "failed", "lost", None])
        moment = rng.choice([None, "2024-01-01 00:00:00"])
        amount = rng.choice([None, "1.00"])
        values.append((key, 1, "a", "a", amount, status, moment, "2024-01-02 00:00:00", moment))
    return rows(COLUMNS, *values)


def own_checks(table):
    return [check for check in quality.CHECKS if served(table, check)]


def found(df):
    return sorted(map(tuple, df.collect()))


def in_full(spark, table):
    return found(quality.run_checks({table.name: table.read(spark)}, own_checks(table)))


def test_counts_are_those_of_a_full_run(spark, rows, table, tmp_path):
    stored = str(tmp_path / "counts")
    table.replace(batch(rows, 0, range(50), 120))
    for seed, keys in enumerate([range(0, 5), range(20, 45), [None], range(0, 200), [7]]):
        by_folder = found(run_folder_checks(spark, table, own_checks(table), stored))
        assert by_folder == in_full(spark, table)
        assert {kind for kind, *_ in by_folder} == {"not_null", "unique", "accepted_values"}
        table.merge(batch(rows, seed, keys, 20))
    assert found(run_folder_checks(spark, table, own_checks(table), stored)) == in_full(spark, table)


def test_folders_that_did_not_change_are_not_read(spark, rows, table, tmp_path):
    stored = str(tmp_path / "counts")
    table.replace(batch(rows, 0, range(50), 200))
    run_folder_checks(spark, table, own_checks(table), stored)
    table.merge(rows(COLUMNS, (3, *[None] * 8)))
    expected = in_full(spark, table)
    others = [f for f in Path(table.path).glob("*=*/*.parquet") if not f.parent.name.endswith("=0")]
    assert len(others) >= 4
    for file in others:  # what is no Parquet file any more cannot be read
        file.write_bytes(b"nothing")
        (file.parent / f".{file.name}.crc").unlink(missing_ok=True)
    assert found(run_folder_checks(spark, table, own_checks(table), stored)) == expected


def test_nothing_is_read_where_nothing_changed(spark, rows, table, tmp_path):
    stored = str(tmp_path / "counts")
    table.replace(batch(rows, 0, range(50), 100))
    first = found(run_folder_checks(spark, table, own_checks(table), stored))
    for file in Path(table.path).glob("*=*/*.parquet"):
        file.write_bytes(b"nothing")
    assert found(run_folder_checks(spark, table, own_checks(table), stored)) == first


def test_other_checks_are_counted_anew(spark, rows, table, tmp_path):
    stored = str(tmp_path / "counts")
    table.replace(batch(rows, 0, range(50), 100))
    run_folder_checks(spark, table, own_checks(table)[:2], stored)
    assert found(run_folder_checks(spark, table, own_checks(table), stored)) == in_full(spark, table)


def test_a_table_without_rows(spark, rows, table, tmp_path):
    table.replace(batch(rows, 0, range(50), 100).filter(F.lit(False)))
    counts = found(run_folder_checks(spark, table, own_checks(table), str(tmp_path / "counts")))
    assert len(counts) == len(own_checks(table))
    assert {row[-1] for row in counts} == {0}

"""Every registered query against its oracle, as the driver compares them."""

from __future__ import annotations

import os

import duckdb
import pandas as pd
import pytest
from conftest import TESTDATA

import __spark_entry__ as entry

SF_DIR = os.environ.get("TEST_SF_DIR", f"{TESTDATA}/sf0.01")
NAMES = [*entry.ON_MODELS, *entry.ON_FILES]
QUERIES = {name: entry.queries()[name] for name in NAMES}
ORACLES = {name: sql for name, sql in entry.oracle_sql().items() if name in NAMES}


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    connection.execute("set timezone = 'UTC'")
    for file in os.listdir(SF_DIR):
        name = file.removesuffix(".parquet")
        connection.execute(f"create view {name} as from '{SF_DIR}/{file}'")
    return connection


def _sorted(frame: pd.DataFrame) -> list[tuple]:
    frame = frame[sorted(frame.columns)].astype(object)
    records = frame.where(frame.notna(), None).itertuples(index=False, name=None)
    return sorted(records, key=lambda row: tuple((v is not None, str(v)) for v in row))


def test_each_query_has_an_oracle():
    assert QUERIES.keys() == ORACLES.keys()


@pytest.mark.parametrize("name", QUERIES)
def test_query_matches_oracle(spark, duck, name):
    found = QUERIES[name](spark, SF_DIR).toPandas()
    expected = duck.execute(ORACLES[name]).df()
    assert sorted(found.columns) == sorted(expected.columns)
    assert len(found) == len(expected)
    assert _sorted(found) == _sorted(expected)


def test_entry(spark):
    assert entry.entry(spark).count() == 10


def test_queries_leave_no_folders_behind(spark):
    """Written again, not beside what is there."""
    root = spark.conf.get("spark.sql.warehouse.dir").removeprefix("file:")
    counts = []
    for _ in range(2):
        QUERIES["incremental_load"](spark, SF_DIR)
        entry.built.cache_clear()
        entry.built(spark, SF_DIR)
        counts.append(sum(len(folders) for _, folders, _ in os.walk(root)))
    assert counts[0] == counts[1]

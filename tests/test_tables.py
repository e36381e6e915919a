"""Tables that are replaced: what readers find before, during and after a write, also a failed one."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from tillmart.sources import tables


@pytest.fixture
def path(tmp_path):
    return str(tmp_path / "layer" / "table")


def numbers(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "n long")


def found(df):
    return sorted(row.n for row in df.collect())


def failing(spark):
    """Some tasks write rows before one fails."""
    return spark.range(0, 100, 1, 4).select(
        F.when(F.col("id") == 99, F.raise_error(F.lit("lost")).cast("long")).otherwise(F.col("id")).alias("n")
    )


def test_the_latest_version_is_read(spark, path):
    for values in ((1,), (2, 3), (4,), ()):
        tables.replace(numbers(spark, *values), path)
        assert found(tables.read(spark, path)) == sorted(values)
    assert tables.is_complete(spark, path)


def test_two_versions_are_kept(spark, path):
    for n in range(5):
        tables.replace(numbers(spark, n), path)
    assert sorted(os.listdir(path)) == ["version-000000004", "version-000000005"]


def test_after_a_failed_write_the_old_table_is_there(spark, path):
    tables.replace(numbers(spark, 1, 2), path)
    before = tables.read(spark, path)
    for _ in range(2):
        with pytest.raises(Exception, match="lost"):
            tables.replace(failing(spark), path)
        assert found(tables.read(spark, path)) == found(before) == [1, 2]
    tables.replace(numbers(spark, 7), path)
    assert found(tables.read(spark, path)) == [7]
    assert found(before) == [1, 2]  # planned before, and still there


def test_a_table_may_be_written_from_itself(spark, path):
    tables.replace(numbers(spark, 1, 2), path)
    tables.replace(tables.read(spark, path).select((F.col("n") + 1).alias("n")), path)
    assert found(tables.read(spark, path)) == [2, 3]


def test_during_a_write_the_old_table_is_read(spark, path, monkeypatch):
    tables.replace(numbers(spark, 1), path)
    seen = []
    writing = numbers(spark, 5)
    original = type(writing.write).parquet

    def parquet(self, target, *args):
        seen.append(found(tables.read(spark, path)))
        original(self, target, *args)
        os.remove(f"{target}/_SUCCESS")  # all files are there, but the write has not finished
        seen.append(found(tables.read(spark, path)))
        open(f"{target}/_SUCCESS", "w").close()

    monkeypatch.setattr(type(writing.write), "parquet", parquet)
    tables.replace(writing, path)
    assert seen == [[1], [1]]
    assert found(tables.read(spark, path)) == [5]


def test_a_first_write_that_failed_leaves_no_table(spark, path):
    with pytest.raises(Exception, match="lost"):
        tables.replace(failing(spark), path)
    assert not tables.is_complete(spark, path)


def test_folders_of_plain_files_can_be_read(spark, path):
    numbers(spark, 3).write.parquet(path)
    assert found(tables.read(spark, path)) == [3]
    assert tables.is_complete(spark, path)


def test_published_tables_are_switched(spark, path):
    spark.sql("CREATE DATABASE IF NOT EXISTS tillmart_test")
    name = "tillmart_test.numbers"
    try:
        for values in ((1,), (2, 3)):
            tables.replace(numbers(spark, *values), path)
            tables.publish(spark, path, name)
            assert found(spark.table(name)) == sorted(values)
        with pytest.raises(Exception, match="lost"):
            tables.replace(failing(spark), path)
        assert found(spark.table(name)) == [2, 3]
        spark.sql(f"DROP TABLE {name}")
        assert found(tables.read(spark, path)) == [2, 3]  # external: the files stay
    finally:
        spark.sql("DROP DATABASE tillmart_test CASCADE")

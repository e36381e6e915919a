"""CSV files whose cells hold line ends, read by many tasks; and types of columns without a hint."""

from __future__ import annotations

import csv
import random
from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillmart.sources import csv_rows, infer, raw, tables
from tillmart.sources.schemas import RAW_SCHEMAS

NO_HINTS = T.StructType([])
TEXTS = T.StructType([T.StructField(name, T.StringType()) for name in ("id", "cell", "more")])


@pytest.fixture
def small_splits(spark):
    """Files of more than so many bytes are dealt to several tasks."""
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    old = {name: spark.conf.get(name) for name in names}

    def set_to(size):
        spark.conf.set(names[0], size)
        spark.conf.set(names[1], 1)

    yield set_to
    for name, value in old.items():
        spark.conf.set(name, value)


def write_csv(folder, files, end="\n"):
    folder.mkdir(parents=True, exist_ok=True)
    for name, rows in files.items():
        with (folder / name).open("w", newline="") as file:
            csv.writer(file, lineterminator=end).writerows(rows)
    return str(folder)


def collected(df):
    return sorted(map(tuple, df.collect()), key=str)


def one_task(spark, path):
    """Spark's own reader, which reads a file whole where cells may hold line ends."""
    options = {"header": True, "multiLine": True, "quote": '"', "escape": '"'}
    return raw.drop_blank_rows(spark.read.options(**options).schema(TEXTS).csv(path))


@pytest.mark.parametrize("end", ["\n", "\r\n"])
@pytest.mark.parametrize("size", [60, 300, 2**20])
def test_rows_are_those_of_one_task(spark, tmp_path, small_splits, size, end):
    rng = random.Random(size)
    letters = ["a", '"', "\n", "\n\n", ",", "b c", "é", "\n\"", " "]
    files = {}
    for f in range(3):
        rows = [["id", "cell", "more"]]
        for k in range(rng.randint(12, 25)):
            cell = "".join(rng.choices(letters, k=rng.randint(0, 25 if k % 9 else 200)))
            rows.append([f"{f}-{k}", cell, rng.choice(["", "x", "1"])])
        files[f"{f}.csv"] = rows
    path = write_csv(tmp_path / "t", files, end)
    small_splits(size)
    splits = csv_rows.read_lines(spark, path).select("file", "start").distinct().count()
    assert splits > (3 if size < 2**20 else 0)
    found = raw.read_csv(spark, path, TEXTS, str(tmp_path / "scratch"))
    expected = [(a, b or None, c or None) for rows in files.values() for a, b, c in rows[1:]]
    assert collected(found) == sorted(expected, key=str) == collected(one_task(spark, path))


def test_a_cell_longer_than_many_splits(spark, tmp_path, small_splits):
    long = "\n".join(f'line {i}, "{i}"' for i in range(200))
    path = write_csv(tmp_path / "t", {"a.csv": [["id", "cell"], ["1", long], ["2", "b"], ["3", long]]})
    small_splits(64)
    found = raw.read_csv(spark, path, TEXTS, str(tmp_path / "scratch"))
    assert collected(found) == sorted([("1", long), ("2", "b"), ("3", long)])


def test_headers_with_line_ends(spark, tmp_path, small_splits):
    header = ["id", "a\nlong name" * 9]
    files = {f"{k}.csv": [header, [str(k), "x\ny"]] for k in range(3)}
    path = write_csv(tmp_path / "t", files)
    small_splits(16)
    found = raw.read_csv(spark, path, NO_HINTS, str(tmp_path / "scratch"))
    assert found.columns == header
    assert collected(found) == [(0, "x\ny"), (1, "x\ny"), (2, "x\ny")]


def test_unlike_headers_are_found_beside_line_ends(spark, tmp_path):
    files = {"a.csv": [["id", "x"], ["1", "a\nb"]], "b.csv": [["x", "id"], ["1", "2"]]}
    path = write_csv(tmp_path / "t", files)
    with pytest.raises(ValueError, match="different headers"):
        raw.read_csv(spark, path, NO_HINTS, str(tmp_path / "scratch"))


def test_headers_may_be_quoted_in_one_file_only(spark, tmp_path):
    write_csv(tmp_path / "t", {"a.csv": [["id", "store_id"], ["1", "2"]]})
    (tmp_path / "t" / "b.csv").write_text('"id","store_id"\r\n3,4\r\n')
    found = raw.read_csv(spark, str(tmp_path / "t"), RAW_SCHEMAS["devices"])
    assert collected(found) == [(1, 2), (3, 4)]


@pytest.mark.parametrize("text", ["", "\n\n", "id,store_id", "id,store_id\n\n\n"])
def test_files_without_rows(spark, tmp_path, text):
    (tmp_path / "t").mkdir()
    (tmp_path / "t" / "a.csv").write_text(text)
    assert raw.read_csv(spark, str(tmp_path / "t"), RAW_SCHEMAS["devices"]).count() == 0


def test_a_cell_that_is_never_closed_goes_on_to_the_end(spark, tmp_path, small_splits):
    (tmp_path / "t").mkdir()
    text = 'id,cell\n1,"a\n' + "2,b\n" * 50
    (tmp_path / "t" / "a.csv").write_text(text)
    small_splits(32)
    found = raw.read_csv(spark, str(tmp_path / "t"), TEXTS, str(tmp_path / "scratch"))
    ((number, cell),) = collected(found)
    assert number == "1" and cell.count("2,b") == 50


def test_lines_are_dealt_to_many_tasks(spark, tmp_path, small_splits):
    """The plan that makes rows of lines has as many tasks as the file has splits."""
    rows = [["id", "cell"]] + [[str(i), "a\nb"] for i in range(4000)]
    path = write_csv(tmp_path / "t", {"a.csv": rows})
    small_splits(2000)
    lines = csv_rows.read_lines(spark, path)
    assert lines.rdd.getNumPartitions() > 15
    assert raw.read_csv(spark, path, TEXTS, str(tmp_path / "scratch")).count() == 4000


def test_input_split_in_another_way_is_refused(spark, tmp_path, small_splits):
    path = write_csv(tmp_path / "t", {"a.csv": [["id", "cell"]] + [["1", "a\nb"]] * 50})
    lines = csv_rows.read_lines(spark, path)
    small_splits(100)
    with pytest.raises(Exception, match="split in another way"):
        csv_rows.whole_rows(lines, {(0, 0): False}, str(tmp_path / "scratch"))


def test_ingest_leaves_no_rows_behind(spark, tmp_path):
    rows = [["id", "name"], ["1", "a\nb"]]
    write_csv(tmp_path / "raw" / "stores", {"a.csv": rows})
    assert raw.ingest(spark, str(tmp_path / "warehouse"), str(tmp_path / "raw"), "csv") == ["stores"]
    landed = tables.read(spark, tables.table_path(str(tmp_path / "warehouse"), "raw", "stores"))
    assert collected(landed.select("id", "name")) == [(1, "a\nb")]
    assert not [p for p in tmp_path.rglob("csv-*") if any(p.iterdir())]


@pytest.mark.parametrize(
    "cells, expected",
    [
        (["1", "-20", None, ""], "bigint"),
        (["9223372036854775807"], "bigint"),
        (["9223372036854775808", "1"], "decimal(19,0)"),
        (["1", "2.50", "-30.125"], "decimal(5,3)"),
        (["0.1", "123456789012345678901234567890"], "decimal(31,1)"),
        (["0.1234567890", "123456789012345678901234567890"], "string"),
        (["0012", "7"], "string"),
        (["1", "x"], "string"),
        (["2024-01-01", "2024-01-01 10:00:00", "2024-01-01T10:00:00.5"], "timestamp_ntz"),
        (["2024-02-31"], "string"),
        (["2024-01-01", "1"], "string"),
        (["1e5"], "string"),
        (["-0", "0"], "bigint"),
        ([None, ""], "string"),
        ([], "string"),
    ],
)
def test_inferred_types(spark, cells, expected):
    df = spark.createDataFrame([(cell,) for cell in cells], "`a b` string").repartition(3)
    assert infer.infer_types(df, ["a b"])["a b"].simpleString() == expected


def test_types_do_not_depend_on_how_rows_are_dealt(spark):
    rng = random.Random(4)
    cells = [str(rng.randint(-(10**12), 10**12)) for _ in range(500)] + ["1.5", "0.125", "9" * 13]
    df = spark.createDataFrame([(cell,) for cell in cells], "a string")
    types = {infer.infer_types(df.repartition(n), ["a"])["a"] for n in (1, 2, 7)}
    assert types == {T.DecimalType(16, 3)}


def test_columns_without_a_hint_are_typed(spark, tmp_path):
    rows = [
        ["id", "opened", "staff", "rent", "code"],
        ["1", "2024-01-01 10:00:00", "12", "10.5", "007"],
        ["2", "", "0", "7", "x"],
        ["", "", "0", "0.0", ""],  # blank: zero counts as nothing in a column of numbers
    ]
    path = write_csv(tmp_path / "t", {"a.csv": rows})
    found = raw.read_csv(spark, path, RAW_SCHEMAS["stores"])
    assert [kind for _, kind in found.dtypes] == [
        "bigint", "timestamp_ntz", "bigint", "decimal(3,1)", "string",
    ]
    assert collected(found) == [
        (1, datetime(2024, 1, 1, 10), 12, Decimal("10.5"), "007"),
        (2, None, 0, Decimal("7.0"), "x"),
    ]


def test_one_pass_reads_all_columns(spark):
    df = spark.range(10).select(*[F.col("id").cast("string").alias(f"c{i}") for i in range(30)])
    assert set(infer.infer_types(df, df.columns).values()) == {T.LongType()}
    assert infer.infer_types(df, []) == {}

"""Positions in an order against sorting, and distinct counts by bitmaps against sets."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from tillmart.operators.bitmaps import distinct_counts
from tillmart.operators.positions import with_positions


@pytest.mark.parametrize("tied", [False, True])
def test_positions(spark, tmp_path, tied):
    rng = random.Random(3)
    values = [(rng.randint(0, 3 if tied else 10**6), rng.choice([None, "a", "b"]), i) for i in range(2000)]
    values += [(None, None, -1)]
    df = spark.createDataFrame(values, "a int, b string, c int").repartition(5)
    found = with_positions(df, [F.desc("a"), F.asc("b")], str(tmp_path / "ranges")).collect()
    # Largest first, NULL last; then NULL first; ties by the columns.
    expected = sorted(values, key=lambda v: (-(v[0] if v[0] is not None else -1), v[1] or "", v[2]))
    assert [(r.a, r.b, r.c) for r in sorted(found, key=lambda r: r.position)] == expected
    assert sorted(r.position for r in found) == list(range(1, len(values) + 1))


def test_equal_rows_have_positions_of_their_own(spark, tmp_path):
    df = spark.createDataFrame([(1, "x")] * 500, "a int, b string")
    found = with_positions(df, [F.asc("a")], str(tmp_path / "ranges"))
    assert sorted(r.position for r in found.collect()) == list(range(1, 501))


def test_positions_of_nothing(spark, tmp_path):
    df = spark.createDataFrame([], "a int")
    assert with_positions(df, [F.asc("a")], str(tmp_path / "ranges")).count() == 0


def test_positions_use_many_tasks(spark, tmp_path):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = spark.range(5000).select(F.col("id").alias("a"))
        with_positions(df, [F.desc("a")], str(tmp_path / "ranges")).collect()
        ranges = spark.read.parquet(str(tmp_path / "ranges")).select("range").distinct().count()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert ranges == 8


@pytest.mark.parametrize("spread", [50, 10**6, 2**62])
def test_distinct_counts(spark, spread):
    rng = random.Random(spread)
    edges = [0, 1, -1, 32767, 32768, 32769, -32768, -32769, 2**63 - 1, -(2**63) + 1]
    values = []
    for _ in range(600):
        number = rng.choice([None, rng.choice(edges), rng.randint(-spread, spread)])
        values.append((rng.choice([None, 1, 2]), number, rng.choice([None, True, False])))
    df = spark.createDataFrame(values, "g int, n bigint, flag boolean").repartition(4)
    found = distinct_counts(df, ["g"], "n", everything=F.lit(True), flagged=F.col("flag")).collect()
    for g in (None, 1, 2):
        own = [v for v in values if v[0] == g and v[1] is not None]
        (row,) = [r for r in found if r.g == g]
        assert row.everything == len({n for _, n, _ in own})
        assert row.flagged == len({n for _, n, flag in own if flag})


def test_numbers_are_not_moved(spark):
    df = spark.range(100_000).select((F.col("id") % 3).alias("g"), F.col("id").alias("number"))
    counts = distinct_counts(df, ["g"], "number", n=F.lit(True))
    plan = counts._jdf.queryExecution().executedPlan().toString()
    moved = [line for line in plan.splitlines() if "Exchange" in line]
    assert moved and not any("number" in line.split("Exchange")[1] for line in moved)
    assert [r.n for r in counts.orderBy("g").collect()] == [33334, 33333, 33333]

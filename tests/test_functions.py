from __future__ import annotations

from datetime import datetime, timedelta
from decimal import Decimal
from fractions import Fraction
from math import floor

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tillmart import functions as fn


@pytest.mark.parametrize(
    ("raw", "clean"),
    [
        ("v123.0", "123"),
        ("vv12", "12"),
        ("12.0", "12"),
        ("10", "10"),
        ("V12", "V12"),
        ("abc.0", "abc"),
        ("12.00", "12.00"),
        ("1.0.0", "1.0"),
        (".0", ""),
        ("v", ""),
        ("v.0", ""),
        ("", ""),
        (None, None),
    ],
)
def test_clean_product_sku(rows, raw, clean):
    df = rows("sku string", (raw,))
    assert df.select(fn.clean_product_sku(F.col("sku"))).first()[0] == clean


@pytest.mark.parametrize(
    ("raw", "word"),
    [
        ("accepted", "completed"),
        ("refused", "failed"),
        ("cancelled", "cancelled"),
        ("other", "other"),
        (None, None),
    ],
)
def test_normalise_status(rows, raw, word):
    df = rows("status string", (raw,))
    assert df.select(fn.normalise_status(F.col("status"))).first()[0] == word


@pytest.mark.parametrize(
    ("raw", "euros"),
    [("10.129", "10.13"), ("0.005", "0.01"), ("1.005", "1.01"), ("10", "10.00"), ("abc", None)],
)
def test_amount_from_text(rows, raw, euros):
    found = rows("amount string", (raw,)).select(fn.to_amount(F.col("amount"))).first()[0]
    assert found == (None if euros is None else Decimal(euros))


def test_amount_from_double(spark):
    df = spark.createDataFrame([(10.129,), (1.005,), (float("nan"),)], "amount double")
    found = [row[0] for row in df.select(fn.to_amount(F.col("amount"))).collect()]
    assert found == [Decimal("10.13"), Decimal("1.01"), None]


@pytest.mark.parametrize(
    ("end", "elapsed", "calendar"),
    [
        ("2024-01-06 11:59:59", 4, 5),
        ("2024-01-06 12:00:00", 5, 5),
        ("2024-01-01 12:00:00", 0, 0),
        ("2023-12-31 18:00:00", 0, -1),
        (None, None, None),
    ],
)
@pytest.mark.parametrize("zone", ["UTC", "Europe/Berlin"])
def test_days(spark, rows, zone, end, elapsed, calendar):
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        df = rows("a timestamp_ntz, b timestamp_ntz", ("2024-01-01 12:00:00", end))
        found = df.select(
            fn.elapsed_days(F.col("a"), F.col("b")), fn.calendar_days(F.col("a"), F.col("b"))
        ).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert tuple(found) == (elapsed, calendar)


def test_elapsed_days_over_a_clock_change(spark, rows):
    spark.conf.set("spark.sql.session.timeZone", "Europe/Berlin")
    try:
        df = rows(
            "a timestamp_ntz, b timestamp_ntz", ("2024-03-30 02:30:00", "2024-03-31 02:30:00")
        )
        assert df.select(fn.elapsed_days(F.col("a"), F.col("b"))).first()[0] == 1
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_utc_now_does_not_depend_on_the_session_zone(spark):
    from datetime import UTC

    spark.conf.set("spark.sql.session.timeZone", "Pacific/Auckland")
    try:
        found = spark.range(1).select(fn.utc_now()).first()[0]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert abs(found - datetime.now(UTC).replace(tzinfo=None)) < timedelta(minutes=1)


def test_zero_denominator_gives_null(rows):
    df = rows("amount decimal(18,2), n bigint", ("1.00", 0))
    found = df.select(
        fn.money_ratio(F.col("amount"), F.col("n")), fn.count_ratio(F.col("n"), F.col("n"), 2)
    ).first()
    assert tuple(found) == (None, None)


def _half_up(value: Fraction, scale: int) -> Fraction:
    return Fraction(floor(value * 10**scale + Fraction(1, 2)), 10**scale)


@settings(max_examples=5, deadline=None)
@given(
    st.lists(
        st.tuples(st.integers(0, 10**15), st.integers(1, 10**7)), min_size=50, max_size=50
    )
)
def test_ratios_round_the_exact_value(spark, pairs):
    df = spark.createDataFrame(pairs, "cents bigint, n bigint").select(
        "cents",
        "n",
        fn.money_ratio((F.col("cents") / 100).cast("decimal(18,2)"), F.col("n")).alias("money"),
        fn.count_ratio(F.col("cents"), F.col("n"), 1).alias("rate"),
    )
    for row in df.collect():
        assert Fraction(row["money"]) == _half_up(Fraction(row["cents"], 100 * row["n"]), 2)
        assert Fraction(row["rate"]) == _half_up(Fraction(row["cents"], row["n"]), 1)

"""Rounded ratios in exact decimal arithmetic.

``avg(decimal(18,2))`` keeps only six decimals before it is rounded again, and doubles
round 1.005 differently per engine, so every average and rate is a decimal division
(12 or 18 decimals) followed by one half-up round. A zero denominator gives NULL.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def money_ratio(amount: Column, count: Column, scale: int = 2) -> Column:
    """``amount / count`` for a sum of euros."""
    return F.round(amount.cast("decimal(28,2)") / F.nullif(count, F.lit(0)), scale)


def count_ratio(part: Column, whole: Column, scale: int, times: int = 1) -> Column:
    """``times * part / whole`` for two counts."""
    scaled = part.cast("decimal(20,0)") * F.lit(times).cast("decimal(3,0)")
    return F.round(scaled.cast("decimal(20,0)") / F.nullif(whole, F.lit(0)), scale)

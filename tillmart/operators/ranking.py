"""Top-N with ties, without bringing the ties together in one task."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def dense_top_n(df: DataFrame, n: int, *measures: str) -> DataFrame:
    """Rows whose dense rank by the measures, largest first, is at most `n`, with a `rank`.

    A window over all rows would bring every row tied at the top into one task. Here only
    the `n` best distinct measure values are ranked; joining them back finds the tied rows
    where they are. NULL measures rank last, as in the window.
    """
    largest_first = [F.col(name).desc() for name in measures]
    best = df.select(*measures).distinct().orderBy(*largest_first).limit(n)
    ranks = best.select(
        *[F.col(name).alias(f"best_{name}") for name in measures],
        F.row_number().over(Window.orderBy(*largest_first)).alias("rank"),
    )
    same_measures: Column = reduce(
        lambda a, b: a & b, [F.col(name).eqNullSafe(F.col(f"best_{name}")) for name in measures]
    )
    return df.join(ranks, same_measures).select(*df.columns, "rank")

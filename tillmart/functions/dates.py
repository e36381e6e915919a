"""Day arithmetic on zone-less timestamps; independent of the session time zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def elapsed_days(start: Column, end: Column) -> Column:
    """Whole 24-hour days from start to end, truncated toward zero."""
    return F.extract(F.lit("DAY"), end - start)


def calendar_days(start: Column, end: Column) -> Column:
    """Difference of the two calendar dates."""
    return F.datediff(F.to_date(end), F.to_date(start))


def utc_now() -> Column:
    """The current UTC wall clock as a zone-less timestamp."""
    return F.convert_timezone(F.current_timezone(), F.lit("UTC"), F.localtimestamp())

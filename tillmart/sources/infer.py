"""Types of text columns, from all of their cells.

The types form a chain, each cell being of the first that takes it: bigint, exact decimal, timestamp, text.
Where cells of a column differ, numbers meet in a decimal that holds them all, and anything else in
text. What a column needs is a few maxima and flags that can be merged in any order, so one aggregate
reads all columns, whatever the number of tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Numbers as they are written without loss: codes with leading zeros are text.
NUMBER = r"^-?(0|[1-9][0-9]*)(\.[0-9]+)?$"
MOMENT = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}([ T][0-9]{2}:[0-9]{2}(:[0-9]{2}(\.[0-9]{1,6})?)?)?$"
MOST_DIGITS = 38


def _needs(cell: Column) -> Column:
    """What a column's type has to hold; a cell that is null or empty asks for nothing."""
    filled = cell != ""
    number, moment = cell.rlike(NUMBER), cell.rlike(MOMENT) & cell.try_cast("timestamp_ntz").isNotNull()
    digits = F.regexp_replace(cell, "^-", "")
    whole, fraction = F.split_part(digits, F.lit("."), F.lit(1)), F.split_part(digits, F.lit("."), F.lit(2))
    return F.struct(
        F.count_if(filled).alias("cells"),
        F.count_if(filled & number).alias("numbers"),
        F.count_if(filled & moment).alias("moments"),
        F.max(F.when(number, F.length(whole))).alias("whole"),
        F.max(F.when(number, F.length(fraction))).alias("fraction"),
        F.count_if(number & (fraction == "") & cell.try_cast("bigint").isNull()).alias("long"),
    )


def _type(needs) -> T.DataType:
    if not needs["cells"]:
        return T.StringType()
    if needs["numbers"] == needs["cells"]:
        if not needs["fraction"] and not needs["long"]:
            return T.LongType()
        digits = needs["whole"] + needs["fraction"]
        return T.DecimalType(digits, needs["fraction"]) if digits <= MOST_DIGITS else T.StringType()
    return T.TimestampNTZType() if needs["moments"] == needs["cells"] else T.StringType()


def infer_types(cells: DataFrame, columns: list[str]) -> dict[str, T.DataType]:
    """The narrowest type that holds every cell of each of these text columns without loss.

    A column without a filled cell is text. One row comes back from the cluster.
    """
    if not columns:
        return {}
    needs = [_needs(F.col(f"`{name}`")).alias(str(i)) for i, name in enumerate(columns)]
    found = cells.agg(*needs).first()
    return {name: _type(found[i]) for i, name in enumerate(columns)}

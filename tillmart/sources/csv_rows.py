"""Whole CSV rows from files that many tasks read, though cells may hold line ends.

A line end belongs to a cell if an odd number of quotes stands before it in its file (a doubled quote
counts twice, so it changes nothing). Three steps find the rows without reading a file in one task:

1. Spark deals the files to splits of whole lines. Each counts its quotes; prefix sums of the counts
   tell for each split whether it begins inside a cell. That is one row for each split, of
   which the driver plans as many anyway.
2. Each split goes through its lines again, knowing how it begins, and joins those of a row. What is left
   at its ends, of rows that other splits begin or finish, are pieces: two a split at most.
3. The pieces are put in order and joined across splits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

WHOLE, BEGINS, INSIDE, ENDS = 0, 1, 2, 3
PIECES = "file long, start long, place long, part int, record string"

def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, start, line, value): the lines, without LF, numbered in the order of their task, and where
    the split that has them starts."""
    return spark.read.text(path, lineSep="\n").select(
        F.xxhash64("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("line"),
        "value",
    )


def survey(lines: DataFrame) -> DataFrame:
    """A row for each split: (file, start, inside, open, first).

    Whether it begins inside a cell, whether it has a line that begins or ends inside one, and, for the
    first split of a file, the first line that is not blank.
    """
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    header = F.when((F.col("start") == 0) & (F.trim("value") != ""), F.col("line"))
    splits = lines.groupBy("file", "start").agg(
        F.sum(quotes).alias("quotes"),
        F.bool_or(quotes % 2 == 1).alias("open"),
        F.min_by("value", header).alias("first"),
    )
    before = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    inside = F.coalesce(F.sum("quotes").over(before) % 2 == 1, F.lit(False))
    return splits.select("file", "start", inside.alias("inside"), "open", "first")


class _Split:
    """Joins the lines of one split to rows and pieces, batch by batch."""

    def __init__(self, inside: bool):
        self.inside = inside  # a cell, at the line that comes next
        self.begun = not inside  # whether the open row began in this split
        self.open: list = []  # its lines so far

    def add(self, lines) -> Iterator[tuple[int, object]]:
        """(part, records) that are complete with these lines."""
        import pyarrow as pa
        import pyarrow.compute as pc

        quotes = pc.count_substring(lines, '"').to_numpy(zero_copy_only=False)
        after = (int(self.inside) + np.cumsum(quotes)) % 2 == 1
        inside = np.concatenate([[self.inside], after])
        starts = np.flatnonzero(~inside[:-1])
        first = int(starts[0]) if len(starts) else len(lines)
        if first:
            self.open.append(lines.slice(0, first))
        if self.open and not inside[first]:
            yield self._closed(WHOLE if self.begun else ENDS)
        if len(starts):
            self.begun = True
            ends = np.append(starts[1:], len(lines))
            closed = len(starts) - int(inside[-1])
            if closed:
                cuts = np.append(starts[:closed], ends[closed - 1]).astype(np.int32)
                rows = pa.ListArray.from_arrays(pa.array(cuts), lines)
                yield WHOLE, pc.binary_join(rows, "\n")
            if inside[-1]:
                self.open = [lines.slice(int(starts[-1]))]
        self.inside = bool(inside[-1])

    def end(self) -> Iterator[tuple[int, object]]:
        if self.open:
            yield self._closed(BEGINS if self.begun else INSIDE)

    def _closed(self, part: int) -> tuple[int, object]:
        import pyarrow as pa

        lines = [line for array in self.open for line in array.to_pylist()]
        self.open = []
        return part, pa.array(["\n".join(lines)])


def _pieces(lines: DataFrame, splits: dict[tuple[int, int], bool]) -> DataFrame:
    def run(batches) -> Iterator:
        import pyarrow as pa
        import pyarrow.compute as pc

        key, split, place = None, None, 0

        def rows(found):
            nonlocal place
            for part, records in found:
                if part == WHOLE:  # blank lines are no rows
                    records = records.filter(pc.not_equal(pc.utf8_trim_whitespace(records), ""))
                count = len(records)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(count, key[0], np.int64)),
                        pa.array(np.full(count, key[1], np.int64)),
                        pa.array(np.arange(place, place + count)),
                        pa.array(np.full(count, part, np.int32)),
                        records.cast(pa.string()),
                    ],
                    ["file", "start", "place", "part", "record"],
                )
                place += count

        for batch in batches:
            file, start = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            new = np.flatnonzero((np.diff(file) != 0) | (np.diff(start) != 0)) + 1
            cuts = [0, *new.tolist(), batch.num_rows]
            for a, b in zip(cuts, cuts[1:]):
                if b == a:
                    continue
                own = (int(file[a]), int(start[a]))
                if own != key:
                    if split:
                        yield from rows(split.end())
                    if own not in splits:
                        raise RuntimeError("the input was split in another way than before: retry")
                    key, split, place = own, _Split(splits[own]), 0
                # Lines at the front of their own array, which lists and slices of it go by.
                part = pa.concat_arrays([batch.column(2).slice(a, b - a)])
                yield from rows(split.add(part))
        if split:
            yield from rows(split.end())

    return lines.select("file", "start", "value").mapInArrow(run, PIECES)


def whole_rows(
    lines: DataFrame, splits: dict[tuple[int, int], bool], folder: str
) -> DataFrame:
    """(file, record, is_first): every row of the files as one text, and whether it is its file's first.

    `splits` tells for each (file, start) of `survey` whether it begins inside a cell.
    Rows and pieces are written to `folder`, which the result reads. A row that ends in CR LF has lost
    its CR, and has LF for each CR LF inside. A cell that is never closed goes on to the file's end.
    """
    spark = lines.sparkSession
    _pieces(lines, splits).write.mode("overwrite").partitionBy("part").parquet(folder)
    pieces = spark.read.schema(PIECES).parquet(folder)
    first = (F.col("start") == 0) & (F.col("place") == 0)
    whole = pieces.filter(F.col("part") == WHOLE).select("file", "record", first.alias("is_first"))
    broken = pieces.filter(F.col("part") != WHOLE)
    so_far = Window.partitionBy("file").orderBy("start", "place")
    number = F.sum((F.col("part") == BEGINS).cast("int")).over(so_far)
    parts = F.sort_array(F.collect_list(F.struct("start", "place", "record")))
    joined = (
        broken.withColumns({"number": number, "is_first": first})
        .groupBy("file", "number")
        .agg(parts.alias("parts"), F.bool_or("is_first").alias("is_first"))
        .select("file", F.array_join("parts.record", "\n").alias("record"), "is_first")
    )
    record = F.col("record")
    short = F.replace(F.expr("left(record, length(record) - 1)"), F.lit("\r\n"), F.lit("\n"))
    return whole.union(joined).withColumn("record", F.when(record.endswith("\r"), short).otherwise(record))

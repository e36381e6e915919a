"""Loading the three raw tables from CSV or Parquet files."""

from __future__ import annotations

import hashlib
import logging
import os
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillmart.sources import csv_rows, tables
from tillmart.sources.infer import infer_types
from tillmart.sources.schemas import CREATED_ON, RAW_SCHEMAS

log = logging.getLogger(__name__)

#: Amounts given as text; a double would lose cents of the largest.
EXACT = T.DecimalType(18, 2)


def raw_root(root: str | None = None) -> str:
    """The input folder: the argument, else ``RAW_DATA_PATH``, else ``data/raw``."""
    return root or os.environ.get("RAW_DATA_PATH", "data/raw")


def is_filled(cell: Column, data_type: T.DataType) -> Column:
    """False for NULL, empty text, zero and false; never NULL.

    `cell` may still be text: then a number is read from it first, and text that is
    no number counts as filled.
    """
    if isinstance(data_type, T.NumericType):
        nonzero = F.coalesce(cell.try_cast("double") != 0, F.lit(True))
        return F.coalesce(cell.cast("string") != "", F.lit(False)) & nonzero
    if isinstance(data_type, T.BooleanType):
        return F.coalesce(cell.try_cast(data_type), F.lit(False))
    return F.coalesce(cell.cast("string") != "", F.lit(False))


def drop_blank_rows(df: DataFrame, types: dict[str, T.DataType] | None = None) -> DataFrame:
    """Keep rows with at least one filled cell. `types` overrides the columns' own types."""
    types = types or {}
    filled = [
        is_filled(F.col(f"`{field.name}`"), types.get(field.name, field.dataType))
        for field in df.schema.fields
    ]
    return df.filter(reduce(lambda a, b: a | b, filled))


def last_occurrences(header: list[str]) -> dict[str, int]:
    """Position of each distinct name; of equal names the last one counts."""
    return {name: position for position, name in enumerate(header)}


#: Cells in double quotes, a quote in a cell doubled.
CSV_OPTIONS = {"quote": '"', "escape": '"'}


def _cells(spark: SparkSession, path: str, width: int, scratch: str | None) -> DataFrame:
    """The cells of all rows but the files' headers, as texts in columns `c0`, `c1`, ..."""
    columns = T.StructType([T.StructField(f"c{i}", T.StringType()) for i in range(width)])
    lines = csv_rows.read_lines(spark, path)
    header = F.from_csv("first", columns.simpleString(), CSV_OPTIONS)
    survey = csv_rows.survey(lines).withColumn("header", F.xxhash64(header))
    splits = survey.withColumn("headed", F.col("first").isNotNull()).drop("first").collect()
    if not any(split["open"] for split in splits):
        if len({split["header"] for split in splits if split["headed"]}) > 1:
            raise ValueError("files with different headers")
        # No cell has a line end, so Spark can split the files by itself.
        reader = spark.read.options(header=True, mode="FAILFAST", columnPruning=False, **CSV_OPTIONS)
        return reader.schema(columns).csv(path)
    name = f"csv-rows-{hashlib.sha256(path.encode()).hexdigest()[:16]}"
    inside = {(split["file"], split["start"]): split["inside"] for split in splits}
    rows = csv_rows.whole_rows(lines, inside, scratch or tables.session_path(spark, name))
    strict = F.from_csv("record", columns.simpleString(), {**CSV_OPTIONS, "mode": "FAILFAST"})
    rows = rows.select(strict.alias("cells"), "is_first")
    if len(rows.filter("is_first").select("cells").distinct().take(2)) > 1:
        raise ValueError("files with different headers")
    return rows.filter("not is_first").select("cells.*")


def read_csv(
    spark: SparkSession, path: str, hints: T.StructType, scratch: str | None = None
) -> DataFrame:
    """CSV files with one header line each; hinted columns typed, the types of the others inferred.

    All files must share one header, and all rows its length; anything else is an error. Files are
    split, also where cells hold line ends: their rows are then written to the folder `scratch`
    first, which the result reads (by default one of the session). Numbers with a fraction are read as
    exact decimals.
    """
    # Only the first row of the first file.
    first = spark.read.options(multiLine=True, **CSV_OPTIONS).csv(path).first()
    header = list(first) if first else hints.fieldNames()
    cells = _cells(spark, path, len(header), scratch)
    kept = last_occurrences(header)
    cells = cells.select(*[F.col(f"c{position}").alias(name) for name, position in kept.items()])
    hinted = {
        f.name: EXACT if isinstance(f.dataType, T.DoubleType) else f.dataType for f in hints.fields
    }
    inferred = infer_types(cells, [name for name in kept if name not in hinted])
    types = T.StructType([T.StructField(*field) for field in (hinted | inferred).items()])
    return apply_hints(drop_blank_rows(cells, hinted | inferred), types)


def read_parquet(spark: SparkSession, path: str, hints: T.StructType) -> DataFrame:
    """Parquet files; hinted columns are cast to their type, the others kept as they are."""
    return apply_hints(drop_blank_rows(spark.read.parquet(path)), hints)


def apply_hints(df: DataFrame, hints: T.StructType) -> DataFrame:
    """Cast the hinted columns; exact decimals stay where a double is hinted."""
    types = {field.name: field.dataType for field in hints.fields}
    for field in df.schema.fields:
        if isinstance(field.dataType, T.DecimalType) and isinstance(
            types.get(field.name), T.DoubleType
        ):
            del types[field.name]

    def typed(name: str) -> Column:
        column = F.col(f"`{name}`")
        return column.try_cast(types[name]).alias(name) if name in types else column

    return df.select(*map(typed, df.columns))


def load_table(
    spark: SparkSession, table: str, root: str, fmt: str = "parquet", scratch: str | None = None
) -> DataFrame | None:
    """One raw table from ``root/<table>`` or ``root/<table>.<fmt>``; None if there are no files."""
    for path in (f"{root}/{table}", f"{root}/{table}.{fmt}"):
        try:
            if fmt == "csv":
                return read_csv(spark, path, RAW_SCHEMAS[table], scratch)
            return read_parquet(spark, path, RAW_SCHEMAS[table])
        except AnalysisException as error:
            if error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                raise
    return None


def land(df: DataFrame, warehouse: str, table: str) -> None:
    """Replace a raw table of the warehouse."""
    if table == "transactions":
        df = df.withColumn(CREATED_ON, F.to_date("created_at"))
    tables.replace(df, tables.table_path(warehouse, "raw", table))


def ingest(
    spark: SparkSession, warehouse: str, root: str | None = None, fmt: str = "parquet"
) -> list[str]:
    """Full-refresh load of every raw table found; returns the names loaded.

    Blank rows can only be told by looking at every column, so they are dropped here,
    once; later readers of the written table read just the columns they need.
    """
    source = raw_root(root)
    loaded = []
    for table in RAW_SCHEMAS:
        of = hashlib.sha256(f"{warehouse}/{table}".encode()).hexdigest()[:16]
        scratch = tables.scratch_path(spark, warehouse, f"csv-{table}-{of}")
        df = load_table(spark, table, source, fmt, scratch)
        if df is None:
            log.warning("no %s input under %s, table skipped", table, source)
            continue
        land(df, warehouse, table)
        tables.delete(spark, scratch)
        loaded.append(table)
    return loaded

"""Incremental merge of new rows into a keyed table."""

from __future__ import annotations

import hashlib
import logging
from dataclasses import dataclass
from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillmart.sources import tables

log = logging.getLogger(__name__)

#: The folder of a table that holds the marks of merged batches, and how their names end.
MARKS, MARK = "_merged_batches", ".batch"
#: How Spark names the folder of NULL.
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"


class SchemaChanged(ValueError):
    """The batch does not have the target's columns."""


def require_same_columns(target: DataFrame, batch: DataFrame) -> None:
    """Refuse a batch whose column names or types differ from the target's."""
    expected, found = set(target.dtypes), set(batch.dtypes)
    if expected != found:
        missing, extra = sorted(expected - found), sorted(found - expected)
        raise SchemaChanged(f"missing or retyped: {missing}, unexpected: {extra}")


def high_water(
    target: DataFrame, time_column: str, day_column: str | None = None
) -> datetime | None:
    """The latest time in the target; None if it is empty.

    With `day_column`, the date of the same time, first the last day is found, in a column
    that takes next to no space, and then times are read of that day's row groups only.
    """
    if day_column:
        last_day = target.agg(F.max(day_column)).first()[0]
        target = target.filter(F.col(day_column) == F.lit(last_day))
    return target.agg(F.max(time_column)).first()[0]


def newer_than(
    source: DataFrame, time_column: str, bound: datetime | None, day_column: str | None = None
) -> DataFrame:
    """Source rows strictly later than `bound`; no rows if there is none.

    Rows at or before the bound are never picked up, late ones included. Parquet has no
    filter for zone-less timestamps; with `day_column`, the date of the same time, whole
    row groups of earlier days are skipped.
    """
    if bound is None:
        return source.filter(F.lit(False))
    moment = F.lit(bound.isoformat(sep=" ")).cast("timestamp_ntz")
    newer = F.col(time_column) > moment
    return source.filter(newer & (F.col(day_column) >= F.to_date(moment)) if day_column else newer)


def merge_rows(target: DataFrame, batch: DataFrame, key: str) -> DataFrame:
    """The target with the batch's rows replacing those of equal key, and the others added.

    Equal keys within the batch are all kept, for the uniqueness check to report.
    """
    require_same_columns(target, batch)
    # Distinct, so that a key repeated very often in the batch is one row per task.
    untouched = target.join(batch.select(key).distinct(), key, "left_anti")
    return untouched.unionByName(batch)


def newest_of_each(df: DataFrame, key: str, time: str) -> DataFrame:
    """One row per key, the one with the latest time; of equally late ones the largest by the other
    columns. A NULL time is earlier than any other. Rows without a key are all kept."""
    others = [name for name in df.columns if name not in (key, time)]
    newest = F.max(F.struct(time, *others)).alias("newest")
    chosen = df.filter(F.col(key).isNotNull()).groupBy(key).agg(newest).select(key, "newest.*")
    return chosen.select(*df.columns).unionByName(df.filter(F.col(key).isNull()))


def not_older(batch: DataFrame, target: DataFrame, key: str, time: str) -> DataFrame:
    """Batch rows for whose key the target has no later row."""
    held = target.select(F.col(key).alias("held_key"), F.col(time).alias("held_time"))
    later = F.coalesce(F.col("held_time") > F.col(time), F.col("held_time").isNotNull())
    return batch.join(held, (F.col(key) == F.col("held_key")) & later, "left_anti")


@dataclass(frozen=True)
class KeyedTable:
    """A Parquet table split into folders by ranges of its integer key.

    A merge then rewrites only the folders its batch has keys in, instead of the table:
    few, where keys are handed out in sequence. Ranges are dealt to the folders in turn,
    so keys of any kind fill at most `folders` of them. Old and new version of a row
    always share a folder, whatever else changed in it. Both numbers are part of the
    folder name, so one table cannot mix two layouts.
    """

    warehouse: str
    layer: str
    name: str
    key: str
    time: str
    schema: T.StructType
    keys_per_range: int = 100_000_000
    folders: int = 4096

    @property
    def path(self) -> str:
        return tables.table_path(self.warehouse, self.layer, self.name)

    @property
    def folder_column(self) -> str:
        return f"{self.key}_{self.keys_per_range}x{self.folders}"

    @property
    def day_column(self) -> str:
        return f"{self.time}_date"

    def exists(self, spark: SparkSession) -> bool:
        """Whether a first load has finished; one that broke off has to be repeated."""
        return tables.is_complete(spark, self.path)

    def read(self, spark: SparkSession) -> DataFrame:
        return self._read_placed(spark).drop(self.folder_column, self.day_column)

    def read_folders(self, spark: SparkSession, folders: list[int | None]) -> DataFrame:
        """The rows of some folders, with the folder of each; the other folders are not read."""
        placed = self._read_placed(spark).filter(self._is_one_of(folders))
        return placed.drop(self.day_column)

    def files(self, spark: SparkSession) -> dict[int | None, list[str]]:
        """The names of the files in each folder; a merge that rewrites a folder gives it new ones."""
        found: dict[int | None, list[str]] = {}
        for name in tables.names(spark, self.path):
            column, _, value = name.partition("=")
            if column == self.folder_column:
                folder = None if value == NO_VALUE else int(value)
                found[folder] = sorted(tables.names(spark, f"{self.path}/{name}"))
        return found

    def high_water(self, spark: SparkSession) -> datetime | None:
        return high_water(self._read_placed(spark), self.time, self.day_column)

    def replace(self, df: DataFrame) -> None:
        tables.delete(df.sparkSession, self._staging(df.sparkSession))
        self._write(self._place(df), self.path)

    def merge(self, batch: DataFrame, late_rows: bool = False, batch_id: str | None = None) -> None:
        """Replace rows of equal key, add the others. One merge at a time.

        With `late_rows`, the batch may hold rows older than the table's: per key its newest row
        counts, and only where the table has no later one. A table that does not exist yet is made.

        The batch and the rewritten folders are written out before the table is touched:
        a lost executor costs a task, and `finish_merge` completes a swap that broke off. With a
        `batch_id`, of the form `<source>-<number>`, the merge leaves a mark of it in the table, and a
        batch whose mark is there is passed over: so rows without a key are added just once, too.
        """
        spark = batch.sparkSession
        self.finish_merge(spark)
        if batch_id and self._has_merged(spark, batch_id):
            return
        held = self.exists(spark)
        if held:
            require_same_columns(self.read(spark), batch)
        else:
            tables.delete(spark, self.path)  # what a first load left that broke off
        if late_rows:
            batch = newest_of_each(batch, self.key, self.time)
        arrived_path = f"{self._staging(spark)}/arrived"
        self._place(batch).write.mode("overwrite").parquet(arrived_path)
        arrived = spark.read.parquet(arrived_path)
        # At most one value per folder of the table.
        touched = [row[0] for row in arrived.select(self.folder_column).distinct().collect()]
        if held and touched:
            current = self._read_placed(spark).filter(self._is_one_of(touched))
            if late_rows:
                arrived = not_older(arrived, current, self.key, self.time)
            arrived = merge_rows(current, arrived, self.key)
        log.info("%s: replacing %d folders", self.name, len(touched))
        self._write(arrived, self._merged(spark))
        if batch_id:
            # Before the marker of the whole, by which a broken swap is known and finished.
            tables.touch(spark, f"{self._staging(spark)}/{batch_id}{MARK}")
        tables.touch(spark, self._staged(spark))
        self.finish_merge(spark)

    def finish_merge(self, spark: SparkSession) -> None:
        """Swap in the folders of a merge, this one's or one that broke off while swapping.

        Each step can be done again and changes nothing then. What was staged incompletely is
        dropped: the table has not been touched then.
        """
        if tables.exists(spark, self._staged(spark)):
            # The staged files are of even size already, each of one folder.
            merged = self._read_folders(spark, self._merged(spark))
            self._store(merged, self.path, "dynamic")
            # Spark leaves this only where it overwrites all of a table.
            tables.touch(spark, f"{self.path}/_SUCCESS")
            for name in tables.names(spark, self._staging(spark)):
                if name.endswith(MARK):
                    self._mark(spark, name)
            # First, so that nothing half deleted is ever taken for a whole merge.
            tables.delete(spark, self._staged(spark))
        tables.delete(spark, self._staging(spark))

    def _has_merged(self, spark: SparkSession, batch_id: str) -> bool:
        return tables.exists(spark, f"{self.path}/{MARKS}/{batch_id}{MARK}")

    def _mark(self, spark: SparkSession, name: str) -> None:
        """Note the batch, and forget the ones before of its source: they do not come again."""
        tables.touch(spark, f"{self.path}/{MARKS}/{name}")
        source = name.rpartition("-")[0]
        for old in tables.names(spark, f"{self.path}/{MARKS}"):
            if old.rpartition("-")[0] == source and old != name:
                tables.delete(spark, f"{self.path}/{MARKS}/{old}")

    def _staging(self, spark: SparkSession) -> str:
        table = hashlib.sha256(self.path.encode()).hexdigest()[:16]
        return tables.scratch_path(spark, self.warehouse, f"{self.name}-{table}")

    def _merged(self, spark: SparkSession) -> str:
        return f"{self._staging(spark)}/merged"

    def _staged(self, spark: SparkSession) -> str:
        """There once all of a merge is staged."""
        return f"{self._staging(spark)}/whole"

    def _place(self, df: DataFrame) -> DataFrame:
        """Add the folder of each row, and the date that `high_water` goes by."""
        folder = f"pmod(`{self.key}` div {self.keys_per_range}, {self.folders})"
        return df.withColumns(
            {self.day_column: F.to_date(self.time), self.folder_column: F.expr(folder)}
        )

    def _read_placed(self, spark: SparkSession) -> DataFrame:
        return self._read_folders(spark, self.path)

    def _read_folders(self, spark: SparkSession, path: str) -> DataFrame:
        try:
            df = spark.read.parquet(path)
        except AnalysisException as error:
            if error.getCondition() != "UNABLE_TO_INFER_SCHEMA":
                raise
            return self._place(spark.createDataFrame([], self.schema))  # written without a row
        # Folder names alone do not tell the column's type: that of the folder of NULL is none.
        return df.withColumn(self.folder_column, F.col(self.folder_column).cast("bigint"))

    def _is_one_of(self, folders: list[int | None]) -> Column:
        listed = F.col(self.folder_column).isin([f for f in folders if f is not None])
        return listed | F.col(self.folder_column).isNull() if None in folders else listed

    def _write(self, df: DataFrame, path: str) -> None:
        # Rebalancing gives each folder few files of even size, however large one is.
        self._store(df.hint("rebalance", self.folder_column), path, "static")

    def _store(self, df: DataFrame, path: str, overwrite: str) -> None:
        (
            df.write.mode("overwrite")
            .option("partitionOverwriteMode", overwrite)
            .partitionBy(self.folder_column)
            .parquet(path)
        )

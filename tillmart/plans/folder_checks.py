"""Checks of the merged table, of which only what has changed since the last time is read.

Equal keys share a folder, so failures of single rows and repeated keys can be counted folder by folder.
The counts are kept, each with the state of its folder: the names of its files, which a merge that
rewrites the folder changes. The next run reads the folders whose state is new, and adds up all.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillmart.functions import utc_now
from tillmart.operators.upsert import KeyedTable
from tillmart.plans.quality import Check, violation
from tillmart.sources import tables

KINDS = ("not_null", "accepted_values", "accepted_range", "unique")
COUNTS = "folder bigint, state string, number int, failures bigint"


def served(table: KeyedTable, check: Check) -> bool:
    """Whether a check of the table can be counted folder by folder."""
    if check.table != table.name or check.kind not in KINDS:
        return False
    return check.kind != "unique" or check.column == table.key


def run_folder_checks(
    spark: SparkSession, table: KeyedTable, checks: Iterable[Check], stored: str
) -> DataFrame:
    """A row for each check, as `run_checks` gives them; the counts by folder are kept at `stored`."""
    checks = list(checks)
    # Files and checks, as a check that is worded anew has to be run anew.
    states = {
        folder: hashlib.sha256(f"{files}{checks}".encode()).hexdigest()
        for folder, files in table.files(spark).items()
    }
    schema = "folder bigint, state string"
    present = spark.createDataFrame(list(states.items()), schema)
    same = F.col("folder").eqNullSafe(F.col("of")) & (F.col("state") == F.col("as"))
    kept = spark.createDataFrame([], COUNTS)
    if tables.is_complete(spark, stored):
        now = present.select(F.col("folder").alias("of"), F.col("state").alias("as"))
        kept = tables.read(spark, stored).join(now, same, "left_semi")
    known = {(row.folder, row.state) for row in kept.select("folder", "state").distinct().collect()}
    changed = [folder for folder, state in states.items() if (folder, state) not in known]
    if changed:
        kept = kept.unionByName(_counted(spark, table, checks, changed, present))
        tables.replace(kept.coalesce(1), stored)
        kept = tables.read(spark, stored)
    sums = kept.groupBy("number").agg(F.sum("failures").alias("failures"))
    named = [(i, c.kind, c.table, c.column, c.severity) for i, c in enumerate(checks)]
    names = spark.createDataFrame(
        named, "number int, check string, table string, column string, severity string"
    )
    failures = F.coalesce("failures", F.lit(0)).cast("bigint").alias("failures")
    return names.join(sums, "number", "left").select("check", "table", "column", "severity", failures)


def _counted(
    spark: SparkSession,
    table: KeyedTable,
    checks: list[Check],
    folders: list[int | None],
    states: DataFrame,
) -> DataFrame:
    """(folder, state, number, failures) of these folders alone."""
    rows = table.read_folders(spark, folders).withColumnRenamed(table.folder_column, "folder")
    single = [(i, check) for i, check in enumerate(checks) if check.kind != "unique"]
    counts = [F.count_if(violation(check, utc_now())).alias(f"n{i}") for i, check in single]
    by_row = [F.struct(F.lit(i).alias("number"), F.col(f"n{i}").alias("failures")) for i, _ in single]
    parts = []
    if single:
        parts.append(rows.groupBy("folder").agg(*counts).select("folder", F.inline(F.array(*by_row))))
    keyed = [i for i, check in enumerate(checks) if check.kind == "unique"]
    if keyed:
        values = rows.filter(F.col(table.key).isNotNull()).groupBy("folder", table.key).count()
        repeated = values.groupBy("folder").agg(F.count_if(F.col("count") > 1).alias("failures"))
        parts += [repeated.select("folder", F.lit(i).alias("number"), "failures") for i in keyed]
    found = parts[0]
    for part in parts[1:]:
        found = found.unionByName(part)
    of = states.select(F.col("folder").alias("of"), "state")
    return found.join(of, F.col("folder").eqNullSafe(F.col("of"))).select(
        "folder", "state", "number", F.col("failures").cast("bigint").alias("failures")
    )

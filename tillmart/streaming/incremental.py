"""The incremental transaction load fed by new raw files instead of a full raw table."""

from __future__ import annotations

import hashlib

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from tillmart.operators.upsert import KeyedTable
from tillmart.plans.incremental import load_batch
from tillmart.sources import tables
from tillmart.sources.raw import apply_hints, drop_blank_rows
from tillmart.sources.schemas import RAW_SCHEMAS


def load_new_files(
    spark: SparkSession, folder: str, table: KeyedTable, progress: str | None = None
) -> None:
    """Load the raw Parquet transaction files that arrived since the last call, then stop.

    Spark remembers the files under `progress`, by default a folder of the warehouse for
    each input folder. All new files form one batch, so their order does not matter. As they
    are read once only, late rows count too: see `load_batch`. A batch that Spark repeats after a
    crash changes nothing, nor does it add rows without an id again.
    """

    hints = RAW_SCHEMAS["transactions"]
    try:
        schema = spark.read.parquet(folder).schema  # amounts may be doubles or decimals
    except AnalysisException as error:
        if error.getCondition() != "UNABLE_TO_INFER_SCHEMA":
            raise
        schema = hints

    source = hashlib.sha256(folder.encode()).hexdigest()[:16]
    default = tables.table_path(table.warehouse, "_progress", f"{table.name}-{source}")

    def load(batch: DataFrame, number: int) -> None:
        # Batches are numbered anew where Spark's progress was deleted, under another name then.
        stream = spark.read.json(f"{progress or default}/metadata").first()["id"]
        load_batch(apply_hints(drop_blank_rows(batch), hints), table, f"{stream}-{number}")

    query = (
        spark.readStream.schema(schema)
        .parquet(folder)
        .writeStream.trigger(availableNow=True)
        .option("checkpointLocation", progress or default)
        .foreachBatch(load)
        .start()
    )
    query.awaitTermination()

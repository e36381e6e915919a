"""The one incrementally loaded table, staged transactions."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tillmart.operators.upsert import KeyedTable, newer_than
from tillmart.plans.staging import stg_transactions
from tillmart.sources.schemas import CREATED_ON, STG_TRANSACTIONS


def transactions_table(warehouse: str, **layout: int) -> KeyedTable:
    return KeyedTable(
        warehouse,
        "staging",
        "stg_transactions",
        key="transaction_id",
        time="record_created_at",
        schema=STG_TRANSACTIONS,
        **layout,
    )


def load_transactions(raw: DataFrame, table: KeyedTable, full_refresh: bool = False) -> None:
    """All raw transactions the first time, afterwards those created since the latest one held.

    Loading the same transactions again changes nothing.
    """
    spark = raw.sparkSession
    if full_refresh or not table.exists(spark):
        table.replace(stg_transactions(raw))
        return
    table.finish_merge(spark)  # before asking for the latest row
    day_column = CREATED_ON if CREATED_ON in raw.columns else None
    new = newer_than(raw, "created_at", table.high_water(spark), day_column)
    table.merge(stg_transactions(new))


def load_batch(raw: DataFrame, table: KeyedTable, batch_id: str | None = None) -> None:
    """Raw transactions that are not handed in again: none is passed over for being late.

    Per id the latest created row counts, within the batch and against the table; a batch that is
    loaded twice changes nothing. Rows without an id are all kept; with a `batch_id`, of the form
    `<source>-<number>`, those of the source's latest batch are not added again.
    """
    table.merge(stg_transactions(raw), late_rows=True, batch_id=batch_id)


from __future__ import annotations

import hashlib
import importlib.util
import os
import sys
from collections.abc import Callable
from functools import cached_property, lru_cache

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillmart.operators import checks
from tillmart.operators.positions import with_positions
from tillmart.operators.upsert import high_water, merge_rows, newer_than
from tillmart.oracles import MAYBE_NULL, ORACLES
from tillmart.plans import analysis, build, incremental, marts, quality, staging
from tillmart.session import tune
from tillmart.sources import tables, testdata
from tillmart.sources.raw import drop_blank_rows, ingest
from tillmart.streaming.incremental import load_new_files


def _is_there(name: str) -> bool:
    """Whether there is a module of that name; a folder without one is none."""
    spec = importlib.util.find_spec(name)
    return spec is not None and spec.origin is not None


corpus_pipeline = llm_queries = None
if _is_there("tillmart.llm"):  # an add-on that the rest does without
    from tillmart.llm import queries as llm_queries

    if _is_there("corpus_pipeline"):
        import corpus_pipeline

Query = Callable[[SparkSession, str], DataFrame]

AUDIT_COLUMNS = ("dbt_loaded_at", "dbt_updated_at")
MOMENT = "2024-01-25 00:00:00"
HELD_UNTIL = "2024-01-20 00:00:00"


def _moment(text: str):
    return F.lit(text).cast("timestamp_ntz")


class Models:
    """The modelled tables over the driver's data, each a lazy plan built when asked for."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def raw(self, name: str) -> DataFrame:
        return testdata.RAW_TABLES[name](self.spark, self.sf_dir)

    @cached_property
    def stg_stores(self) -> DataFrame:
        return staging.stg_stores(self.raw("stores"))

    @cached_property
    def stg_devices(self) -> DataFrame:
        return staging.stg_devices(self.raw("devices"))

    @cached_property
    def stg_transactions(self) -> DataFrame:
        return staging.stg_transactions(self.raw("transactions"))

    @cached_property
    def int_transactions_joined(self) -> DataFrame:
        return marts.int_transactions_joined(self.stg_transactions, self.stg_devices)

    @cached_property
    def fact_transactions(self) -> DataFrame:
        return marts.fact_transactions(self.int_transactions_joined)

    @cached_property
    def dim_stores(self) -> DataFrame:
        return marts.dim_stores(self.stg_stores)

    @cached_property
    def dim_devices(self) -> DataFrame:
        return marts.dim_devices(self.stg_devices)

    def all(self) -> dict[str, DataFrame]:
        return {name: getattr(self, name) for name in quality.NOT_NULL}


def _comparable(name: str, df: DataFrame) -> DataFrame:
    """Drop the run's timestamps; one width for whole numbers, doubles for decimals."""
    columns = []
    for field in df.schema.fields:
        column = F.col(f"`{field.name}`")
        maybe_null = field.name in MAYBE_NULL.get(name, ())
        if maybe_null or isinstance(field.dataType, T.DecimalType):
            column = column.cast("double")
        elif isinstance(field.dataType, T.IntegralType):
            column = column.cast("bigint")
        if field.name not in AUDIT_COLUMNS:
            columns.append(column.alias(field.name))
    return df.select(*columns)


def _checks_of(kind: str) -> Callable[[Models], DataFrame]:
    selected = [check for check in quality.CHECKS if check.kind == kind]
    return lambda m: quality.run_checks(m.all(), selected)


def _resent(raw: DataFrame) -> DataFrame:
    """All transactions again, and those refused early on a second time, now accepted."""
    corrected = raw.filter(
        (F.col("status") == "refused") & (F.col("created_at") <= _moment(HELD_UNTIL))
    ).withColumns(
        {
            "status": F.lit("accepted"),
            "amount": F.col("amount") + 1,
            "created_at": F.col("created_at") + F.make_dt_interval(F.lit(30)),
        }
    )
    return raw.unionByName(corrected)


def _held(raw: DataFrame) -> DataFrame:
    return raw.filter(F.col("created_at") <= _moment(HELD_UNTIL))


def _upsert(m: Models) -> DataFrame:
    raw = m.raw("transactions")
    target = staging.stg_transactions(_held(raw))
    new = newer_than(_resent(raw), "created_at", high_water(target, "record_created_at"))
    return merge_rows(target, staging.stg_transactions(new), "transaction_id")


def _some_blank_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Signups lose every cell, errors every cell but the id."""
    signup = F.col("event_type") == "signup"
    blank = signup | (F.col("event_type") == "error")
    rows = spark.read.parquet(f"{sf_dir}/events.parquet").select(
        F.when(signup, F.lit(0)).otherwise(F.col("event_id")).alias("id"),
        F.when(~blank, F.col("user_id")).alias("device_id"),
        F.when(blank, "").otherwise(F.col("props")).alias("product_sku"),
        F.when(blank, F.lit(0.0)).otherwise(F.col("value")).alias("amount"),
    )
    return drop_blank_rows(rows)


def _folder(spark: SparkSession, sf_dir: str, name: str) -> str:
    """An empty folder that all executors share; the same each time within a session."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    source = hashlib.sha256(sf_dir.encode()).hexdigest()[:16]
    app = spark.sparkContext.applicationId
    folder = f"{root.rstrip('/')}/tillmart-{app}/{name}-{source}"
    tables.delete(spark, folder)
    return folder


@lru_cache(maxsize=None)
def built(spark: SparkSession, sf_dir: str) -> build.Warehouse:
    """A warehouse built from the driver's tables as raw files, once per session and folder."""
    folder = _folder(spark, sf_dir, "build")
    for name, read in testdata.RAW_TABLES.items():
        read(spark, sf_dir).write.parquet(f"{folder}/raw/{name}")
    warehouse = build.Warehouse(spark, f"{folder}/warehouse")
    # Unknown devices leave transactions without a store, which is an error to the checks.
    build.build(warehouse, f"{folder}/raw", stop_on_error=False)
    return warehouse


def _incremental_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = testdata.transactions(spark, sf_dir)
    folder = _folder(spark, sf_dir, "incremental")
    table = incremental.transactions_table(folder, keys_per_range=1000)
    incremental.load_transactions(_held(raw), table)
    incremental.load_transactions(_resent(raw), table)
    return table.read(spark)


def _file_fed_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two sets of files that overlap in time: the second has rows older than, as old as and newer
    than those of the first, some of its rows again, changed, and some older versions of them."""
    raw = testdata.transactions(spark, sf_dir)
    folder = _folder(spark, sf_dir, "files")
    table = incremental.transactions_table(f"{folder}/warehouse", keys_per_range=1000)
    even = F.col("id") % 2 == 0

    def moved(kind: int, days: int, status: str) -> DataFrame:
        return raw.filter(even & (F.col("id") % 5 == kind)).withColumns(
            {
                "created_at": F.col("created_at") + F.make_dt_interval(F.lit(days)),
                "status": F.lit(status),
            }
        )

    for part in (
        raw.filter(even),
        raw.filter(~even).unionByName(moved(0, 1, "refused")).unionByName(moved(1, -1, "cancelled")),
    ):
        part.write.mode("append").parquet(f"{folder}/raw")
        load_new_files(spark, f"{folder}/raw", table)
    return table.read(spark)


def _from_csv(name: str) -> Query:
    """A raw table written as CSV, ingested, and staged."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        folder = _folder(spark, sf_dir, f"csv-{name}")
        raw = testdata.RAW_TABLES[name](spark, sf_dir)
        # As text, since the CSV writer would cut times to milliseconds.
        cells = raw.select(*[F.col(column).cast("string") for column in raw.columns])
        cells.write.options(header=True, quote='"', escape='"').csv(f"{folder}/raw/{name}")
        ingest(spark, f"{folder}/warehouse", f"{folder}/raw", "csv")
        landed = build.Warehouse(spark, f"{folder}/warehouse").raw(name)
        return staging.stg_stores(landed) if name == "stores" else staging.stg_transactions(landed)

    return query


def _ingest_inferred(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stores as CSV with line ends and quotes in cells, and columns that no hint names."""
    folder = _folder(spark, sf_dir, "csv-inferred")
    cells = testdata.stores(spark, sf_dir).selectExpr(
        "cast(id as string) as id",
        "concat('Floor ', id % 3, '\n\n\"Door\", ', id % 5) as address",
        "cast(id * 1000003 as string) as staff",
        "if(id % 7 = 0, null, concat(id % 1000, '.', id % 10)) as rent",
        "cast(created_at as string) as opened",
        "lpad(cast(id as string), 9, '0') as code",
    )
    cells.write.options(header=True, quote='"', escape='"').csv(f"{folder}/raw/stores")
    ingest(spark, f"{folder}/warehouse", f"{folder}/raw", "csv")
    landed = build.Warehouse(spark, f"{folder}/warehouse").raw("stores")
    return landed.select(
        "*",
        *[
            F.lit(landed.schema[name].dataType.typeName()).alias(f"{name}_type")
            for name in ("staff", "rent", "opened", "code")
        ],
    )


def _positions(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Reports and the fact with each row's place in their order."""
    models, folder = Models(spark, sf_dir), _folder(spark, sf_dir, f"positions-{name}")
    if name == "products":
        best = analysis.top_products(models.fact_transactions)
        best = best.select("store_id", "product_sku", "rank")
        return with_positions(best, [F.asc("rank")], folder)
    fact = models.fact_transactions.select("transaction_id", "store_id", "amount_eur", "transaction_at")
    return with_positions(fact, [F.desc("amount_eur"), F.asc("transaction_at")], folder)


def _lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/lineitem.parquet")


ON_MODELS: dict[str, Callable[[Models], DataFrame]] = {
    **{name: lambda m, name=name: getattr(m, name) for name in quality.NOT_NULL},
    "top_10_stores": lambda m: analysis.top_stores(m.fact_transactions, m.dim_stores),
    "top_5_stores": lambda m: analysis.top_stores(m.fact_transactions, m.dim_stores, n=5),
    "top_10_products": lambda m: analysis.top_products(m.fact_transactions),
    "top_5_products": lambda m: analysis.top_products(m.fact_transactions, n=5),
    "percentage_transactions_by_device": lambda m: analysis.transactions_by_device_type(
        m.fact_transactions, m.dim_devices
    ),
    "avg_amount_by_typology_country": lambda m: analysis.amount_by_typology_country(
        m.fact_transactions, m.dim_stores
    ),
    "avg_time_to_5_transactions": lambda m: analysis.time_to_fifth_transaction(
        m.fact_transactions, m.dim_stores
    ),
    "device_efficiency": lambda m: analysis.device_efficiency(m.fact_transactions, m.dim_devices),
    "store_adoption": lambda m: analysis.store_adoption(m.fact_transactions, m.dim_stores),
    "check_not_null": _checks_of("not_null"),
    "check_unique": _checks_of("unique"),
    "check_accepted_values": _checks_of("accepted_values"),
    "check_accepted_range": _checks_of("accepted_range"),
    "check_relationships": _checks_of("relationships"),
    "check_store_created_after_first_tx": lambda m: checks.stores_created_after_first_transaction(
        m.fact_transactions, m.dim_stores
    ),
    "check_future_transactions": lambda m: checks.future_transactions(
        m.fact_transactions, _moment(MOMENT)
    ),
    "check_summary": lambda m: quality.run_checks(m.all(), now=_moment(MOMENT)),
    "failing_not_null": lambda m: checks.not_null(m.fact_transactions, "store_id"),
    "failing_accepted_values": lambda m: checks.accepted_values(
        m.raw("transactions").select("id", "status"), "status", ["accepted", "refused"]
    ),
    "failing_accepted_range": lambda m: checks.accepted_range(
        m.fact_transactions, "amount_eur", "1.00", "99.99"
    ),
    "failing_relationships": lambda m: checks.orphan_counts(
        m.fact_transactions, "device_id", m.dim_devices, "device_id"
    ),
    "upsert_transactions": _upsert,
}

ON_FILES: dict[str, Query] = {
    "failing_unique": lambda spark, sf: checks.unique(_lineitem(spark, sf), "l_orderkey"),
    "ingest_blank_row_drop": _some_blank_rows,
    "incremental_load": _incremental_load,
    "file_fed_load": _file_fed_load,
    "ingest_csv_stores": _from_csv("stores"),
    "ingest_csv_transactions": _from_csv("transactions"),
    "ingest_inferred": _ingest_inferred,
    "top_10_products_positions": lambda spark, sf: _positions(spark, sf, "products"),
    "fact_positions": lambda spark, sf: _positions(spark, sf, "fact"),
    "build_check_results": lambda spark, sf: tables.read(
        spark, tables.table_path(built(spark, sf).path, "quality", "check_results")
    ),
    "build_device_efficiency": lambda spark, sf: built(spark, sf).table("device_efficiency"),
    "build_store_adoption": lambda spark, sf: built(spark, sf).table("store_adoption"),
}


def entry(spark: SparkSession) -> DataFrame:
    """The ten best stores of the smallest data set."""
    models = Models(tune(spark), "/root/testdata/sf0.001")
    return analysis.top_stores(models.fact_transactions, models.dim_stores)


def queries() -> dict[str, Query]:
    """Every registered query, by name."""

    def on_models(name: str) -> Query:
        return lambda spark, sf_dir: _comparable(name, ON_MODELS[name](Models(tune(spark), sf_dir)))

    def on_files(name: str) -> Query:
        return lambda spark, sf_dir: _comparable(name, ON_FILES[name](tune(spark), sf_dir))

    found = {name: on_models(name) for name in ON_MODELS} | {
        name: on_files(name) for name in ON_FILES
    }
    if llm_queries:
        found |= llm_queries.QUERIES
    if corpus_pipeline:
        found["pipeline"] = corpus_pipeline.run
    return found


def oracle_sql() -> dict[str, str]:
    """DuckDB SQL for each of `queries()`."""
    found = dict(ORACLES)
    if llm_queries:
        found |= llm_queries.ORACLES
    if corpus_pipeline and corpus_pipeline.ORACLE_SQL:
        found["pipeline"] = corpus_pipeline.ORACLE_SQL
    return found

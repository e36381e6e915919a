"""The whole warehouse, or selected tables of it, from raw files to reports."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field, replace

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

from tillmart.plans import analysis, marts, quality, staging
from tillmart.plans.folder_checks import run_folder_checks, served
from tillmart.plans.incremental import load_transactions, transactions_table
from tillmart.sources import tables
from tillmart.sources.raw import ingest
from tillmart.sources.schemas import RAW_SCHEMAS


@dataclass(frozen=True)
class Warehouse:
    """Where the tables are, and the settings of a run."""

    spark: SparkSession
    path: str
    top_stores_n: int = 10
    top_products_n: int = 10
    # Load all raw transactions again instead of the new ones.
    full_refresh: bool = False
    # Set by `build` once the uniqueness checks have passed.
    unique_keys: bool = False

    def raw(self, name: str) -> DataFrame:
        return tables.read(self.spark, tables.table_path(self.path, "raw", name))

    def table(self, name: str) -> DataFrame:
        """A view computed from its inputs, or a written table."""
        if name in VIEWS:
            return VIEWS[name](self)
        if name == STAGED:
            return transactions_table(self.path).read(self.spark)
        return tables.read(self.spark, tables.table_path(self.path, MODELS[name].layer, name))

    def register(self) -> None:
        """Make every table and view available to `spark.sql` under its name."""
        for name in RAW_SCHEMAS:
            if tables.is_complete(self.spark, tables.table_path(self.path, "raw", name)):
                self.raw(name).createOrReplaceTempView(name)
        for name in [*VIEWS, *MODELS]:
            self.table(name).createOrReplaceTempView(name)

    def publish(self, database: str) -> None:
        """Have an external table in a catalog's database for each raw table, dimension, fact and report
        that is written, and point it at the present version.

        The merged table has no versions; it and the views are left to `register`.
        """
        self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
        layers = [("raw", name) for name in RAW_SCHEMAS]
        layers += [(model.layer, name) for name, model in MODELS.items() if model.query]
        for layer, name in layers:
            path = tables.table_path(self.path, layer, name)
            if tables.is_complete(self.spark, path):
                tables.publish(self.spark, path, f"{database}.{name}")


@dataclass(frozen=True)
class Model:
    """A table written by a run: merged into if it has no query, else replaced by it."""

    layer: str
    tags: tuple[str, ...]
    query: Callable[[Warehouse], DataFrame] | None = field(repr=False)


VIEWS: dict[str, Callable[[Warehouse], DataFrame]] = {
    "stg_stores": lambda w: staging.stg_stores(w.raw("stores")),
    "stg_devices": lambda w: staging.stg_devices(w.raw("devices")),
    "int_transactions_joined": lambda w: marts.int_transactions_joined(
        w.table("stg_transactions"), w.table("stg_devices")
    ),
}

STAGED = "stg_transactions"
LAYERS = ("staging", "marts", "analysis")
_DIMENSION, _FACT, _REPORT = ("marts", "dimensions"), ("marts", "facts"), ("analysis",)

# In the order they are written.
MODELS: dict[str, Model] = {
    STAGED: Model("staging", ("staging",), None),
    "dim_stores": Model("marts", _DIMENSION, lambda w: marts.dim_stores(w.table("stg_stores"))),
    "dim_devices": Model("marts", _DIMENSION, lambda w: marts.dim_devices(w.table("stg_devices"))),
    "fact_transactions": Model(
        "marts", _FACT, lambda w: marts.fact_transactions(w.table("int_transactions_joined"))
    ),
    "top_10_stores": Model(
        "analysis",
        _REPORT,
        lambda w: analysis.top_stores(
            w.table("fact_transactions"), w.table("dim_stores"), w.top_stores_n
        ),
    ),
    "top_10_products": Model(
        "analysis",
        _REPORT,
        lambda w: analysis.top_products(w.table("fact_transactions"), w.top_products_n),
    ),
    "percentage_transactions_by_device": Model(
        "analysis",
        _REPORT,
        lambda w: analysis.transactions_by_device_type(
            w.table("fact_transactions"), w.table("dim_devices")
        ),
    ),
    "avg_amount_by_typology_country": Model(
        "analysis",
        _REPORT,
        lambda w: analysis.amount_by_typology_country(
            w.table("fact_transactions"), w.table("dim_stores")
        ),
    ),
    "avg_time_to_5_transactions": Model(
        "analysis",
        _REPORT,
        lambda w: analysis.time_to_fifth_transaction(
            w.table("fact_transactions"), w.table("dim_stores")
        ),
    ),
    "device_efficiency": Model(
        "analysis",
        _REPORT,
        lambda w: analysis.device_efficiency(
            w.table("fact_transactions"), w.table("dim_devices"), w.unique_keys
        ),
    ),
    "store_adoption": Model(
        "analysis",
        _REPORT,
        lambda w: analysis.store_adoption(
            w.table("fact_transactions"), w.table("dim_stores"), w.unique_keys
        ),
    ),
}


def select(models: Iterable[str] = (), tags: Iterable[str] = ()) -> list[str]:
    """Names of the tables to write: those named or tagged, all if nothing is asked for.

    Views may be named too; being computed when read, they need no writing.
    """
    names, wanted_tags = set(models), set(tags)
    known_tags = {tag for model in MODELS.values() for tag in model.tags}
    unknown = (names - MODELS.keys() - VIEWS.keys()) | (wanted_tags - known_tags)
    if unknown:
        raise ValueError(f"no such table or tag: {sorted(unknown)}")
    if not names and not wanted_tags:
        return list(MODELS)
    return [n for n, model in MODELS.items() if n in names or wanted_tags & set(model.tags)]


def run(
    warehouse: Warehouse, models: Iterable[str] = (), tags: Iterable[str] = (), at_once: int = 4
) -> list[str]:
    """Write the selected tables from the tables they read; returns their names.

    Tables of one layer do not read each other, so up to `at_once` are written at the same
    time: the last tasks of one leave most executors to the next.
    """
    selected = select(models, tags)
    for layer in LAYERS:
        names = [name for name in selected if MODELS[name].layer == layer]
        with ThreadPoolExecutor(at_once) as pool:
            # Inheritable: job group and scheduler pool of the caller apply to each write.
            write = inheritable_thread_target(warehouse.spark)(_write)
            list(pool.map(lambda name: write(warehouse, name), names))
    return selected


def _write(warehouse: Warehouse, name: str) -> None:
    model = MODELS[name]
    if model.query is None:
        target = transactions_table(warehouse.path)
        load_transactions(warehouse.raw("transactions"), target, warehouse.full_refresh)
    else:
        path = tables.table_path(warehouse.path, model.layer, name)
        tables.replace(model.query(warehouse), path)


def check(warehouse: Warehouse) -> DataFrame:
    """Run every check on the written tables; returns the results, one row per check.

    Of the merged table, only folders that changed since the last run are read for its own checks.
    """
    spark, merged = warehouse.spark, transactions_table(warehouse.path)
    checked = {name: warehouse.table(name) for name in quality.NOT_NULL}
    by_folder = [c for c in quality.CHECKS if served(merged, c)]
    others = [c for c in quality.CHECKS if c not in by_folder]
    counts_path = tables.table_path(warehouse.path, "quality", "counts_by_folder")
    results = run_folder_checks(spark, merged, by_folder, counts_path).unionByName(
        quality.run_checks(checked, others)
    )
    # Written once, so that looking at the results does not run the checks again.
    results_path = tables.table_path(warehouse.path, "quality", "check_results")
    tables.replace(results.coalesce(1), results_path)
    return tables.read(spark, results_path)


def refresh(warehouse: Warehouse, stop_on_error: bool = True) -> DataFrame:
    """Raw tables to reports: staging, marts, checks, analysis.

    Failed checks of severity error stop the run before the reports, unless told otherwise.
    Returns the check results, one row each.
    """
    run(warehouse, tags=["staging", "marts"])
    results = check(warehouse)
    if stop_on_error:
        quality.raise_on_error(results)
    run(replace(warehouse, unique_keys=quality.keys_are_unique(results)), tags=["analysis"])
    return results


def build(
    warehouse: Warehouse,
    raw_root: str | None = None,
    fmt: str = "parquet",
    stop_on_error: bool = True,
) -> DataFrame:
    """Raw files to reports: `ingest`, then `refresh`."""
    ingest(warehouse.spark, warehouse.path, raw_root, fmt)
    return refresh(warehouse, stop_on_error)

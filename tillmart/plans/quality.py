"""Which checks run on which table, and running them together."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillmart.functions import utc_now
from tillmart.operators import checks

ERROR, WARN = "error", "warn"
ROW_KINDS = ("not_null", "accepted_values", "accepted_range", "in_the_future")


@dataclass(frozen=True)
class Check:
    kind: str
    table: str
    column: str
    severity: str = ERROR
    args: tuple[Any, ...] = ()

    def needs(self) -> set[str]:
        """The tables it reads."""
        if self.kind == "relationships":
            return {self.table, self.args[0]}
        if self.kind == "created_after_first_transaction":
            return {self.table, "fact_transactions"}
        return {self.table}


# Columns that must not be NULL.
NOT_NULL = {
    "stg_stores": "store_id store_name store_country customer_id created_at dbt_loaded_at",
    "stg_devices": "device_id device_type store_id dbt_loaded_at",
    "stg_transactions": "transaction_id device_id amount_eur transaction_status transaction_at "
    "record_created_at dbt_loaded_at",
    "int_transactions_joined": "transaction_id",
    "dim_stores": "store_id store_name store_country customer_id dbt_updated_at",
    "dim_devices": "device_id device_type store_id dbt_updated_at",
    "fact_transactions": "transaction_id device_id store_id product_sku amount_eur "
    "record_created_at",
}

# Columns without repeated values.
UNIQUE = {
    "stg_stores": "store_id",
    "stg_devices": "device_id",
    "stg_transactions": "transaction_id",
    "int_transactions_joined": "transaction_id",
    "dim_stores": "store_id",
    "dim_devices": "device_id",
    "fact_transactions": "transaction_id",
}

# Allowed words, device types and amounts; parents; severities.
STATUSES = ("completed", "failed", "cancelled")
DEVICE_TYPES = (1, 2, 3, 4, 5)
SMALLEST_AMOUNT, LARGEST_AMOUNT = "0.01", "100000.00"
OTHER_CHECKS = [
    Check("accepted_values", "stg_devices", "device_type", args=DEVICE_TYPES),
    Check("accepted_values", "stg_transactions", "transaction_status", args=STATUSES),
    Check("accepted_values", "fact_transactions", "transaction_status", args=STATUSES),
    Check(
        "accepted_range",
        "fact_transactions",
        "amount_eur",
        args=(SMALLEST_AMOUNT, LARGEST_AMOUNT),
    ),
    Check("relationships", "dim_devices", "store_id", WARN, ("dim_stores", "store_id")),
    Check("relationships", "fact_transactions", "device_id", WARN, ("dim_devices", "device_id")),
    Check("relationships", "fact_transactions", "store_id", WARN, ("dim_stores", "store_id")),
    Check("created_after_first_transaction", "dim_stores", "created_at", WARN),
    Check("in_the_future", "fact_transactions", "transaction_at", WARN),
]

CHECKS = (
    [Check("not_null", table, c) for table, columns in NOT_NULL.items() for c in columns.split()]
    + [Check("unique", table, column) for table, column in UNIQUE.items()]
    + OTHER_CHECKS
)


class ChecksFailed(RuntimeError):
    """At least one check of severity error found failing rows."""


def violation(check: Check, now: Column) -> Column:
    """Whether a row fails a check that looks at single rows."""
    if check.kind == "in_the_future":
        return F.col(check.column) > now
    if check.kind == "not_null":
        return checks.violates_not_null(check.column)
    if check.kind == "accepted_values":
        return checks.violates_accepted_values(check.column, check.args)
    return checks.violates_accepted_range(check.column, *check.args)


def _result(check: Check, failures: Column) -> Column:
    return F.struct(
        F.lit(check.kind).alias("check"),
        F.lit(check.table).alias("table"),
        F.lit(check.column).alias("column"),
        F.lit(check.severity).alias("severity"),
        F.coalesce(failures, F.lit(0)).cast("bigint").alias("failures"),
    )


def _row_checks(df: DataFrame, row_checks: list[Check], now: Column) -> DataFrame:
    """All checks that look at single rows, in one pass over the table."""
    counts = df.agg(
        *[F.count_if(violation(check, now)).alias(f"n{i}") for i, check in enumerate(row_checks)]
    )
    return _results(counts, row_checks)


def _results(counts: DataFrame, of: list[Check]) -> DataFrame:
    """The one row of counts n0, n1, ... as a row per check."""
    results = [_result(check, F.col(f"n{i}")) for i, check in enumerate(of)]
    return counts.select(F.inline(F.array(*results)))


def _key_checks(df: DataFrame, key_checks: list[Check]) -> DataFrame:
    """Uniqueness of a column, and whether it is NULL, from its values and how often each occurs."""
    column = F.col(key_checks[0].column)
    values = df.groupBy(column.alias("value")).agg(F.count(F.lit(1)).alias("n_records"))
    known = F.col("value").isNotNull()
    counts = {
        "unique": F.count_if(known & (F.col("n_records") > 1)),
        "not_null": F.sum(F.when(~known, F.col("n_records"))),
    }
    found = values.agg(*[counts[check.kind].alias(f"n{i}") for i, check in enumerate(key_checks)])
    return _results(found, key_checks)


def _parent_checks(
    child: DataFrame, column: str, parent: DataFrame, parent_column: str, of: list[Check]
) -> DataFrame:
    """Whether each value has a parent, and whether that was there before the value's first
    transaction, from one row per value."""
    dated = any(check.kind == "created_after_first_transaction" for check in of)
    first = [F.min("transaction_at").alias("first_transaction_at")] if dated else []
    values = (
        child.filter(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("n_records"), *first)
    )
    created = ["created_at"] if dated else []
    parents = parent.select(F.col(parent_column).alias("parent"), *created)
    if not dated:
        parents = parents.distinct()
    joined = values.join(parents, F.col(column) == F.col("parent"), "left")
    counts = {"relationships": F.sum(F.when(F.col("parent").isNull(), F.col("n_records")))}
    if dated:
        late = F.col("created_at") > F.col("first_transaction_at")
        counts["created_after_first_transaction"] = F.count_if(late)
    found = joined.agg(*[counts[check.kind].alias(f"n{i}") for i, check in enumerate(of)])
    return _results(found, of)


def _passes(wanted: list[Check]) -> dict[tuple[str, ...], list[Check]]:
    """The checks by the pass over a table that serves them."""
    keys = {(check.table, check.column) for check in wanted if check.kind == "unique"}
    found: dict[tuple[str, ...], list[Check]] = {}
    for check in wanted:
        place = (check.table, check.column)
        if check.kind == "unique" or check.kind == "not_null" and place in keys:
            part = ("key", *place)
        elif check.kind == "relationships":
            part = ("parent", *place, *check.args)
        elif check.kind == "created_after_first_transaction":
            part = ("parent", "fact_transactions", "store_id", check.table, "store_id")
        else:
            part = ("row", check.table)
        found.setdefault(part, []).append(check)
    return found


def run_checks(
    tables: Mapping[str, DataFrame],
    selected: Iterable[Check] = tuple(CHECKS),
    now: Column | None = None,
) -> DataFrame:
    """One row per check: check, table, column, severity, failures.

    `failures` counts failing rows; for `unique`, the repeated values. Checks that need a
    table not given are left out. A table is read once for all its single-row checks, once for
    each unique column and once for each column with a parent.
    """
    wanted = [check for check in selected if check.needs() <= tables.keys()]
    moment = utc_now() if now is None else now
    parts = []
    for (kind, table, *more), served in _passes(wanted).items():
        if kind == "row":
            parts.append(_row_checks(tables[table], served, moment))
        elif kind == "key":
            parts.append(_key_checks(tables[table], served))
        else:
            column, parent, parent_column = more
            parts.append(
                _parent_checks(tables[table], column, tables[parent], parent_column, served)
            )
    return reduce(DataFrame.unionByName, parts)


def raise_on_error(results: DataFrame) -> None:
    """Stop where an error-level check failed; warnings pass."""
    failed = results.filter((F.col("severity") == ERROR) & (F.col("failures") > 0)).collect()
    if failed:
        lines = [f"{r['check']} {r['table']}.{r['column']}: {r['failures']}" for r in failed]
        raise ChecksFailed("; ".join(sorted(lines)))


# The key of each table the reports read.
REPORT_KEYS = {
    "fact_transactions": "transaction_id",
    "dim_stores": "store_id",
    "dim_devices": "device_id",
}


def keys_are_unique(results: DataFrame) -> bool:
    """Whether every table the reports read was found to have one row per key, none of them NULL."""
    on_a_key = reduce(
        lambda a, b: a | b,
        [(F.col("table") == t) & (F.col("column") == key) for t, key in REPORT_KEYS.items()],
    )
    key_checks = results.filter(on_a_key & F.col("check").isin("unique", "not_null"))
    failures = key_checks.agg(F.count(F.lit(1)), F.max("failures")).first()
    return tuple(failures) == (2 * len(REPORT_KEYS), 0)

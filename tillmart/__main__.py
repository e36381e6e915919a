"""Command line: ``spark-submit``-able steps of a warehouse run.

    python -m tillmart build --warehouse <folder> --raw <folder> [--format csv]
    python -m tillmart run --warehouse <folder> --tags analysis --top-stores-n 15
"""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from pyspark.sql import SparkSession

from tillmart.plans import build, quality
from tillmart.plans.incremental import transactions_table
from tillmart.session import tune
from tillmart.sources.raw import ingest, raw_root
from tillmart.streaming.incremental import load_new_files


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="tillmart")
    parser.add_argument("step", choices=["ingest", "load-files", "run", "check", "build"])
    parser.add_argument("--warehouse", required=True, help="folder of the tables")
    parser.add_argument("--raw", help="folder of the raw files (default: $RAW_DATA_PATH)")
    parser.add_argument("--format", choices=["csv", "parquet"], default="parquet")
    parser.add_argument("--full-refresh", action="store_true", help="reload all transactions")
    parser.add_argument("--models", nargs="*", default=[], help="tables to write")
    parser.add_argument("--tags", nargs="*", default=[], help="staging, marts, facts, ...")
    parser.add_argument("--top-stores-n", type=int, default=10)
    parser.add_argument("--top-products-n", type=int, default=10)
    parser.add_argument("--publish", metavar="DATABASE", help="catalog database for the tables")
    return parser


def main(words: Sequence[str] | None = None) -> None:
    args = _parser().parse_args(words)
    spark = tune(SparkSession.builder.appName("tillmart").getOrCreate())
    warehouse = build.Warehouse(
        spark, args.warehouse, args.top_stores_n, args.top_products_n, args.full_refresh
    )
    if args.step == "ingest":
        print(*ingest(spark, args.warehouse, args.raw, args.format), sep="\n")
    elif args.step == "load-files":
        folder = f"{raw_root(args.raw)}/transactions"
        load_new_files(spark, folder, transactions_table(args.warehouse))
    elif args.step == "run":
        print(*build.run(warehouse, args.models, args.tags), sep="\n")
    elif args.step == "check":
        results = build.check(warehouse)
        results.orderBy("check", "table", "column").show(len(quality.CHECKS), truncate=False)
        quality.raise_on_error(results)
    else:
        build.build(warehouse, args.raw, args.format)
    if args.publish:
        warehouse.publish(args.publish)


if __name__ == "__main__":
    main()

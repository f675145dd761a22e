"""Runs one job: ``spark-submit --py-files tidewell.zip tidewell/__main__.py <job> ...``.

Scheduling, retries and waiting for files are left to whatever starts it.
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from tidewell.operators.audit import AuditLog
from tidewell.plans import orders, pos, sales, taxi, warehouse
from tidewell.session import build_session, tune_for
from tidewell.sources import read_csv_strings


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="tidewell")
    parser.add_argument("--master", help="Spark master, unless spark-submit names it")
    parser.add_argument("--input-gb", type=float, help="data shuffled, to size shuffle partitions")
    jobs = parser.add_subparsers(dest="job", required=True)

    job = jobs.add_parser("taxi", help="ingest new trips, refresh the summary tables")
    job.add_argument("source", help="Parquet folder of trips that grows")
    job.add_argument("base", help="folder of the resulting tables")

    job = jobs.add_parser("sales", help="bronze, silver and gold")
    job.add_argument("source", help="CSV of sales")
    job.add_argument("stores", help="CSV of stores")
    job.add_argument("products", help="CSV of products")
    job.add_argument("base", help="folder of the resulting tables and the log")
    job.add_argument("--database", default="gold")

    job = jobs.add_parser("warehouse", help="one day's load")
    job.add_argument("landing", help="folder of the dated files")
    job.add_argument("base", help="folder of staging and warehouse tables")
    job.add_argument("day", help="yyyy-mm-dd")
    job.add_argument("--min-orders", type=int, default=10)

    job = jobs.add_parser("orders", help="a partitioned table, changed and laid out")
    job.add_argument("source", help="CSV of orders")
    job.add_argument("path", help="folder of the table")

    job = jobs.add_parser("pos", help="clean point-of-sale rows")
    job.add_argument("--schema", help="columns and types of the source, in order; saves the pass that finds them")
    job.add_argument("source", help="CSV of sales rows")
    job.add_argument("output", help="folder for JSON lines")

    job = jobs.add_parser("extend", help="add made-up rows to point-of-sale rows, shuffled")
    job.add_argument("source", help="CSV of sales rows")
    job.add_argument("output", help="folder for CSV files")
    job.add_argument("--rows", type=int, default=990)
    job.add_argument("--seed", type=int, default=42)
    return parser


def _run_sales(spark: SparkSession, args: argparse.Namespace) -> None:
    log = AuditLog(spark, f"{args.base}/logs")
    stores = read_csv_strings(spark, args.stores)
    products = read_csv_strings(spark, args.products)
    sales.run_bronze(spark, args.source, args.base, log)
    sales.run_increment(spark, stores.select("store_id"), args.base, log)
    silver = sales.read_merged(spark, f"{args.base}/silver/sales")
    sales.run_gold(spark, silver, stores, products, args.database, log)


def main(argv: list[str] | None = None) -> None:
    args = _parser().parse_args(argv)
    spark = build_session(f"tidewell-{args.job}", args.master)
    if args.input_gb:
        tune_for(spark, int(args.input_gb * 1024**3))
    if args.job == "taxi":
        schema = spark.read.parquet(args.source).schema
        print(taxi.run(spark, args.source, schema, args.base))
    elif args.job == "sales":
        _run_sales(spark, args)
    elif args.job == "warehouse":
        print(warehouse.run_daily(spark, args.landing, args.base, args.day, args.min_orders))
    elif args.job == "orders":
        orders.run(spark, args.source, args.path).groupBy("status").count().show()
    elif args.job == "extend":
        for name, found in pos.extend(
            spark, args.source, args.output, args.rows, args.seed
        ).items():
            print(name)
            found.show()
    else:
        n_rows, statistics = pos.run(spark, args.source, args.output, args.schema)
        statistics.show()
        print({"n_rows": n_rows})


if __name__ == "__main__":
    main()

"""Sales in three layers: as received, cleaned row by row, added up for reports."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewell.functions import EXACT, TOTAL, exact_number, month_number
from tidewell.operators.amounts import add_amount
from tidewell.operators.audit import AuditLog
from tidewell.operators.keys import latest_per_key
from tidewell.operators.rollups import sum_by, sum_by_attribute
from tidewell.operators.stored import merge_stored, read_stored
from tidewell.operators.validity import add_membership, add_verdict, keep_members
from tidewell.session import fresh_path, make_folder, materialized, path_exists, remove_path
from tidewell.sinks import (
    append,
    ensure_database,
    overwrite,
    overwrite_partitioned,
    read_split,
    save_managed,
    write_split,
)
from tidewell.sources import read_csv_strings
from tidewell.streaming import read_stream_table, run_batches

# Numbers are kept as received: a received text becomes a decimal that holds all its digits, or NULL.
NUMBERS = ("quantity", "unit_price", "discount", "total_amount")
KEY = "transaction_id"
#: The silver table is stored by month, as yyyy-MM.
MONTH = "sales_month"


# -- bronze ----------------------------------------------------------------


def bronze(received: DataFrame, source_system: str = "manual_csv") -> DataFrame:
    """Received rows, unchanged, with the time and place they came from."""
    return received.withColumn("ingestion_timestamp", F.current_timestamp()).withColumn(
        "source_system", F.lit(source_system)
    )


# -- silver ----------------------------------------------------------------


def conform(sales: DataFrame) -> DataFrame:
    """Text columns cast to their types; what does not cast is NULL (and later rejected)."""
    types = dict(sales.dtypes)

    def conformed(name: str) -> Column:
        if types[name] == "string" and name in NUMBERS:
            return exact_number(name, "string").alias(name)
        if types[name] == "string" and name == "transaction_date":
            return F.col(name).try_cast("date").alias(name)
        return F.col(name)

    return sales.select(*[conformed(name) for name in sales.columns])


def dedup(sales: DataFrame) -> DataFrame:
    """One row per transaction: the one received last, where that is known."""
    if "ingestion_timestamp" in sales.columns:
        order = {"ingestion_timestamp": F.desc_nulls_last("ingestion_timestamp")}
    else:
        names = ["transaction_date", "product_id", "store_id", "unit_price", "quantity"]
        order = {name: F.col(name) for name in names}
    rest = [c for c in sales.columns if c != KEY and c not in order]
    return latest_per_key(sales, [KEY], list(order.values()), rest)


def add_correct_total(sales: DataFrame) -> DataFrame:
    """Quantity times price less discount, with all its digits; NULL where these cannot be kept."""
    return add_amount(sales, ("quantity", "unit_price"), "discount", "correct_total")


def number_rules() -> dict[str, Column]:
    """Received numbers are judged as they are. An amount that cannot be held exactly is no valid one."""
    return {
        "quantity": F.col("quantity") > 0,
        "unit_price": F.col("unit_price") > 0,
        "correct_total": F.col("correct_total").isNotNull() | F.col("discount").isNull(),
    }


def cleaned(sales: DataFrame) -> DataFrame:
    """Typed rows with their amounts, one of each transaction.

    Amounts are computed below the window, so that filters on them do not repeat the computation.
    """
    return dedup(add_correct_total(conform(sales)))


def judged(sales: DataFrame, stores: DataFrame) -> DataFrame:
    """Silver rows, good and bad, with ``reject_reason`` and ``is_valid``.

    ``stores`` lists the valid store ids in its first column.
    """
    marked = add_membership(cleaned(sales), stores, "store_id", "_known_store")
    rules = {**number_rules(), "store_id": F.col("_known_store")}
    return add_verdict(marked, rules).drop("_known_store")


def silver_valid(sales: DataFrame, stores: DataFrame) -> DataFrame:
    """Only the good rows: the number rules first, so that fewer rows reach the join."""
    numbers_right = reduce(Column.__and__, number_rules().values())
    return keep_members(cleaned(sales).filter(numbers_right), stores, "store_id")


def silver_quarantine(sales: DataFrame, stores: DataFrame) -> DataFrame:
    return judged(sales, stores).filter("NOT is_valid").drop("is_valid")


# -- gold ------------------------------------------------------------------


def daily_sales(silver: DataFrame) -> DataFrame:
    return sum_by(silver, ["transaction_date"], "correct_total", "daily_revenue")


def monthly_region(silver: DataFrame, stores: DataFrame, with_year: bool = False) -> DataFrame:
    """Revenue by month and region.

    The month goes without its year, so all Januaries are one group; ``with_year``
    tells them apart.
    """
    when: list[Column] = [month_number("transaction_date").alias("month")]
    if with_year:
        when.insert(0, F.year("transaction_date").cast("bigint").alias("year"))
    return sum_by_attribute(
        silver, stores, "store_id", when, ["region"], "correct_total", "monthly_revenue"
    )


def product_performance(silver: DataFrame, products: DataFrame) -> DataFrame:
    return sum_by_attribute(
        silver,
        products,
        "product_id",
        [],
        ["product_name", "category"],
        "correct_total",
        "total_revenue",
    )


def presummed(silver: DataFrame) -> DataFrame:
    """Silver added up by day, store and product: all that the three gold tables need of it."""
    keys = ["transaction_date", "store_id", "product_id"]
    return sum_by(silver, keys, "correct_total", "correct_total")


def reconcile(silver: DataFrame, gold: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """Total of each gold table against silver's (its rows, or ``presummed``).

    ``gold`` maps a table's name to its rows and its revenue column. Sums and
    differences are decimals, so any difference is a real one.
    """
    silver_sum = F.sum("correct_total").cast(TOTAL).alias("silver_total")
    silver_total = silver.agg(silver_sum).scalar()
    lines = [
        table.agg(F.sum(column).cast(TOTAL).alias("gold_total")).select(
            F.lit(name).alias("table"), "gold_total"
        )
        for name, (table, column) in gold.items()
    ]
    return (
        reduce(DataFrame.unionByName, lines)
        .withColumn("silver_total", silver_total)
        .withColumn("diff", F.col("gold_total").cast(EXACT) - F.col("silver_total").cast(EXACT))
    )


# -- reports ---------------------------------------------------------------


def total_revenue(daily: DataFrame) -> DataFrame:
    return daily.agg(F.sum("daily_revenue").alias("total_revenue"))


def daily_trend(daily: DataFrame) -> DataFrame:
    return daily.orderBy("transaction_date")


def monthly_by_region(monthly: DataFrame, region: str | None = None) -> DataFrame:
    chosen = monthly.filter(F.col("region") == region) if region else monthly
    return chosen.orderBy("month", "region")


def top_products(products: DataFrame, n: int = 10) -> DataFrame:
    order = [F.desc_nulls_last("total_revenue"), "product_name", "category"]
    return products.orderBy(*order).limit(n)


def category_revenue(products: DataFrame) -> DataFrame:
    return sum_by(products, ["category"], "total_revenue", "revenue")


# -- jobs ------------------------------------------------------------------


def run_bronze(spark: SparkSession, source: str, base: str, log: AuditLog) -> dict[str, int]:
    def work() -> dict[str, int]:
        return {"n_rows": append(bronze(read_csv_strings(spark, source)), f"{base}/bronze/sales")}

    return log.step("bronze", "bronze_ingestion", work)


def run_silver(spark: SparkSession, stores: DataFrame, base: str, log: AuditLog) -> dict[str, int]:
    """Judge all of bronze in one job; good and bad rows go to folders of ``<base>/silver/judged``."""

    def work() -> dict[str, int]:
        received = spark.read.parquet(f"{base}/bronze/sales")
        checked = judged(received, stores)
        counts = write_split(checked, f"{base}/silver/judged", "is_valid")
        return {"n_rows": counts["n_good"], "n_rejected": counts["n_bad"]}

    return log.step("silver", "silver_processing", work)


def read_silver(spark: SparkSession, base: str, schema: T.StructType) -> tuple[DataFrame, DataFrame]:
    """Valid rows (without ``reject_reason``) and quarantined rows."""
    like = spark.createDataFrame([], schema)
    good, bad = read_split(like, f"{base}/silver/judged", "is_valid")
    return good.drop("reject_reason"), bad


def by_month(silver: DataFrame) -> DataFrame:
    """Silver rows with the column that their table is stored by."""
    return silver.withColumn(MONTH, F.date_format("transaction_date", "yyyy-MM"))


def read_merged(spark: SparkSession, path: str) -> DataFrame:
    """The silver table that merges keep."""
    return read_stored(spark, path).drop(MONTH)


def run_merge(spark: SparkSession, target: str, source: DataFrame, log: AuditLog) -> dict[str, int]:
    """Upsert valid rows into the silver table, which is made if it is not there.

    Only the months that hold a transaction of ``source``, or take one, are read and written. A row
    without a key is added unless an equal one is there.
    """

    def work() -> dict[str, int]:
        merged = merge_stored(by_month(source), target, [KEY], [MONTH])
        return {"n_rows": merged["n_rows"]}

    return log.step("silver", "silver_merge", work)


def run_increment(spark: SparkSession, stores: DataFrame, base: str, log: AuditLog) -> dict[str, int]:
    """Judge what bronze has received since the last run, and merge it into ``<base>/silver/sales``.

    Bronze is read as a stream, so each file is taken once. What a batch rejects goes to a folder of its
    own number, ``<base>/silver/quarantine/batch=<n>``, and a batch whose number is noted as merged is
    left out; a batch that is run again after a failure thus changes nothing. Of a transaction the row
    received last counts, unless it is invalid: then the valid one before it stays.
    """
    totals = {"n_rows": 0, "n_rejected": 0}
    target, notes = f"{base}/silver/sales", f"{base}/silver/_merged"

    def take(batch: DataFrame, number: int) -> None:
        done = f"{notes}/{number}"
        if path_exists(batch.sparkSession, done):
            return
        # Stored by verdict and month, the rows lie as the merge needs them.
        checked, kept = by_month(judged(batch, stores)), fresh_path(batch.sparkSession, "judged")
        try:
            overwrite_partitioned(checked, kept, ["is_valid", MONTH])
            good, bad = read_split(checked, kept, "is_valid")
            totals["n_rejected"] += overwrite(bad.drop(MONTH), f"{base}/silver/quarantine/batch={number}")
            valid = good.drop("reject_reason")
            accepted = f"{kept}/is_valid=true"
            make_folder(batch.sparkSession, accepted)  # there may be no such row
            totals["n_rows"] += merge_stored(valid, target, [KEY], [MONTH], stored_at=accepted)["n_rows"]
        finally:
            remove_path(batch.sparkSession, kept)
        make_folder(batch.sparkSession, done)

    def work() -> dict[str, int]:
        bronze_path = f"{base}/bronze/sales"
        received = read_stream_table(spark, bronze_path, spark.read.parquet(bronze_path).schema)
        run_batches(received, take, f"{base}/_checkpoints/silver")
        return dict(totals)

    return log.step("silver", "silver_processing", work)


def read_quarantine(spark: SparkSession, base: str) -> DataFrame:
    """All rejected rows, with the number of their batch."""
    return spark.read.option("basePath", f"{base}/silver/quarantine").parquet(f"{base}/silver/quarantine")


def run_gold(
    spark: SparkSession,
    silver: DataFrame,
    stores: DataFrame,
    products: DataFrame,
    database: str,
    log: AuditLog,
) -> dict[str, int]:
    """Replace the three managed gold tables; silver is read once for all of them."""

    def work() -> dict[str, int]:
        ensure_database(spark, database)
        with materialized(presummed(silver), "presummed") as sums:
            days = save_managed(daily_sales(sums), f"{database}.daily_sales")
            save_managed(monthly_region(sums, stores), f"{database}.monthly_region")
            save_managed(product_performance(sums, products), f"{database}.product_performance")
        return {"n_rows": days}

    return log.step("gold", "gold_aggregation", work)

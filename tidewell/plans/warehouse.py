"""The shop's daily load: files to staging, staging to dimensions and fact, checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewell.functions import MONEY, to_utc
from tidewell.operators import quality
from tidewell.operators.changes import unseen_rows, upsert_dimension
from tidewell.operators.keys import latest_per_key
from tidewell.session import materialized, path_exists, remove_path
from tidewell.sinks import (
    overwrite,
    overwrite_partitioned,
    publish,
    recover,
    replace_folder,
    staged_path,
    write_if_any,
)
from tidewell.sources import dated_path, read_csv_positional, read_json_lines

# Column names and types of the staging and warehouse tables are fixed values.
CUSTOMER_SCHEMA = (
    T.StructType()
    .add("customer_id", "integer")
    .add("first_name", "string")
    .add("last_name", "string")
    .add("email", "string")
    .add("signup_date", "date")
    .add("country", "string")
)
PRODUCT_SCHEMA = (
    T.StructType()
    .add("product_id", "integer")
    .add("product_name", "string")
    .add("category", "string")
    .add("unit_price", MONEY)
)
ORDER_SCHEMA = (
    T.StructType()
    .add("order_id", "string")
    .add("order_timestamp", "timestamp_ntz")
    .add("customer_id", "integer")
    .add("product_id", "integer")
    .add("quantity", "integer")
    .add("total_amount", MONEY)
    .add("currency", "string")
    .add("status", "string")
)


def latest_orders(orders: DataFrame) -> DataFrame:
    """The newest row of each order; a row without a time counts as newest."""
    rest = [c for c in orders.columns if c not in ("order_id", "order_timestamp")]
    return latest_per_key(orders, ["order_id"], [F.desc_nulls_first("order_timestamp")], rest)


def is_loadable() -> Column:
    return (
        (F.col("quantity") > 0)
        & F.col("customer_id").isNotNull()
        & F.col("product_id").isNotNull()
    )


def fact_rows(latest: DataFrame, zone: str = "UTC") -> DataFrame:
    """Fact rows from the newest row of each order.

    The validity filter comes after the newest row is known: an order whose
    newest row is invalid has no fact row, it does not fall back to an older one.
    """
    in_dollars = F.col("currency") == "USD"
    return latest.filter(is_loadable()).select(
        "order_id",
        to_utc("order_timestamp", zone).alias("order_timestamp_utc"),
        F.to_date("order_timestamp").alias("order_date"),
        "customer_id",
        "product_id",
        "quantity",
        F.when(in_dollars, F.col("total_amount").cast(MONEY)).alias("total_amount_usd"),
        "currency",
        F.coalesce(~in_dollars, F.lit(False)).alias("currency_mismatch_flag"),
        "status",
    )


def fact_orders(orders: DataFrame) -> DataFrame:
    return fact_rows(latest_orders(orders))


def key_rules(day: Column | None = None) -> dict[str, Column]:
    """Rules that are TRUE for a bad fact row, of one day or of all."""
    missing = F.col("customer_id").isNull() | F.col("product_id").isNull()
    return {"fact_orders_not_null_keys": missing if day is None else missing & day}


def rowcount_match(orders: DataFrame, fact: DataFrame) -> DataFrame:
    """Valid staged orders against fact rows, per day."""
    expected = latest_orders(orders).filter(is_loadable())
    return quality.count_match(
        expected.select(F.to_date("order_timestamp").alias("order_date")), fact, "order_date"
    )


# -- the daily job ---------------------------------------------------------


def load_staging(spark: SparkSession, landing: str, base: str, day: str) -> dict[str, int]:
    """Replace the three staging tables by the day's files; rows loaded."""
    customers = read_csv_positional(
        spark, dated_path(landing, "customers", day, "csv"), CUSTOMER_SCHEMA
    )
    products = read_csv_positional(
        spark, dated_path(landing, "products", day, "csv"), PRODUCT_SCHEMA
    )
    orders = read_json_lines(spark, dated_path(landing, "orders", day, "json"), ORDER_SCHEMA)
    return {
        "customers": overwrite(customers, f"{base}/stg_customers"),
        "products": overwrite(products, f"{base}/stg_products"),
        "orders": overwrite(orders, f"{base}/stg_orders"),
    }


def load_dimension(spark: SparkSession, base: str, name: str, key: str, incoming: DataFrame) -> int:
    """Upsert a dimension. The new content is complete before the old is touched."""
    path = f"{base}/{name}"
    recover(spark, path)
    if path_exists(spark, path):
        target = spark.read.schema(incoming.schema).parquet(path)
    else:
        target = spark.createDataFrame([], incoming.schema)
    return replace_folder(upsert_dimension(target, incoming, [key]), path)


def load_fact_slice(spark: SparkSession, path: str, rows: DataFrame, day: str) -> None:
    """Replace one day of the fact table, stored by ``order_date``.

    The day is exchanged when its new rows are complete beside the table, also for nothing if there
    are none; a failed write leaves the old day. Rows of other days are appended if their order is not
    there yet; no other day is overwritten.
    """
    on_day = F.col("order_date").eqNullSafe(F.lit(day).cast("date"))
    recover(spark, path)
    # The rows are needed twice, and the second write must not depend on the first.
    with materialized(rows, "fact-rows") as fresh:
        if path_exists(spark, path):
            stored = spark.read.schema(fresh.schema).parquet(path)
            unseen = unseen_rows(fresh.filter(~on_day), stored.filter(~on_day), "order_id")
            placed = unseen.select(*fresh.columns).hint("rebalance", "order_date")
            placed.write.mode("append").partitionBy("order_date").parquet(path)
            staged, today = staged_path(path), f"order_date={day}"
            try:
                # Written also where there are none: the folder then tells the columns.
                overwrite(fresh.filter(on_day).drop("order_date"), f"{staged}/{today}")
                publish(spark, staged, path, 1, [today])
            finally:
                remove_path(spark, staged)
        else:
            overwrite_partitioned(fresh, path, ["order_date"])


def run_daily(
    spark: SparkSession, landing: str, base: str, day: str, min_orders: int = 10
) -> dict[str, int | bool]:
    """The whole load of one day. Raises if a check fails; notes a day with few orders."""
    loaded = load_staging(spark, landing, base, day)
    customers = spark.read.schema(CUSTOMER_SCHEMA).parquet(f"{base}/stg_customers")
    products = spark.read.schema(PRODUCT_SCHEMA).parquet(f"{base}/stg_products")
    orders = spark.read.schema(ORDER_SCHEMA).parquet(f"{base}/stg_orders")

    load_dimension(spark, base, "dim_customers", "customer_id", customers)
    load_dimension(spark, base, "dim_products", "product_id", products)
    rows = fact_orders(orders)
    load_fact_slice(spark, f"{base}/fact_orders", rows, day)

    fact = spark.read.schema(rows.schema).parquet(f"{base}/fact_orders")
    on_day = F.col("order_date") == F.lit(day).cast("date")
    today = fact.filter(on_day)
    match = rowcount_match(orders, today).filter(on_day)
    quality.enforce(
        quality.report(
            quality.not_empty(spark.read.parquet(f"{base}/dim_customers"), "dim_customers_not_empty"),
            quality.bad_rows(today, key_rules()),
            quality.bad_rows(match, {"fact_orders_rowcount_match": ~F.col("passed")}),
        )
    )
    summary = quality.low_volume_on(fact, "order_date", day, min_orders)
    low = write_if_any(summary, f"{base}/anomalies/low_volume_orders_{day}")
    return {**loaded, "low_volume": low}

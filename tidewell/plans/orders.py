"""An order table that is partitioned, changed and laid out anew."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.operators.layout import cluster, compact_small
from tidewell.operators.stored import delete_stored, read_stored, update_stored
from tidewell.sinks import append, overwrite_partitioned, recover

PARTITIONS = ["country", "order_date"]
# Column names and types are fixed values.
ORDER_SCHEMA = (
    "order_id string, order_timestamp timestamp, customer_id string, country string, amount double, "
    "currency string, status string"
)


@dataclass(frozen=True)
class Rules:
    """What the job changes. The defaults are fixed values."""

    paid_country: str = "IN"
    cancelled_country: str = "US"
    cancelled_under: float = 100
    least_amount: float = 50


def with_order_date(orders: DataFrame) -> DataFrame:
    return orders.withColumn("order_date", F.to_date("order_timestamp"))


def pruned(orders: DataFrame, country: str, day: dt.date | str) -> DataFrame:
    """One country's orders of one day; on the stored table only that folder is read."""
    return orders.filter(
        (F.col("country") == country) & (F.col("order_date") == F.lit(day).cast("date"))
    )


def run(spark: SparkSession, csv: str, path: str, late: DataFrame | None = None, rules: Rules = Rules()) -> DataFrame:
    """Write the orders of a CSV by country and day, change them, lay them out; the table at the end.

    One country's open orders are paid, ``late`` ones (which may bring columns) added, small ones of
    another country cancelled, and those under the least amount deleted. Each change writes only the
    partitions it touches. Last, folders of small files are compacted, and ``<path>_clustered`` holds
    the rows laid out by customer.
    """
    received = spark.read.schema(ORDER_SCHEMA).option("header", True).csv(csv)
    recover(spark, path)
    overwrite_partitioned(with_order_date(received), path, PARTITIONS)
    country, status, amount = F.col("country"), F.col("status"), F.col("amount")
    paid = (country == rules.paid_country) & (status == "CREATED")
    update_stored(spark, path, PARTITIONS, paid, {"status": F.lit("PAID")})
    if late is not None:
        append(with_order_date(late), path, PARTITIONS)
    cancelled = (country == rules.cancelled_country) & (amount < rules.cancelled_under)
    update_stored(spark, path, PARTITIONS, cancelled, {"status": F.lit("CANCELLED")})
    delete_stored(spark, path, PARTITIONS, amount < rules.least_amount)
    compact_small(spark, path, PARTITIONS)
    cluster(spark, path, f"{path}_clustered", "customer_id", PARTITIONS)
    return read_stored(spark, path)

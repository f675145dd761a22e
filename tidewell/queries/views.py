
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.operators.sets import union_rows


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def trips_of(lineitem: DataFrame) -> DataFrame:
    """``lineitem`` may be a stream."""
    return lineitem.select(
        F.col("l_shipdate").alias("tpep_pickup_datetime"),
        (F.col("l_quantity") - 5).alias("trip_distance"),
        F.col("l_extendedprice").alias("fare_amount"),
        (F.col("l_suppkey") % 25).alias("pickup_zip"),
        (F.col("l_partkey") % 25).alias("dropoff_zip"),
    )


def trips(spark: SparkSession, folder: str) -> DataFrame:
    return trips_of(table(spark, folder, "lineitem"))


def sales_of(lineitem: DataFrame) -> DataFrame:
    return lineitem.select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("transaction_id"),
        F.to_date("l_shipdate").alias("transaction_date"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_suppkey").alias("store_id"),
        # Small and broken quantities and fractions of a cent, which must survive.
        F.when(F.col("l_linenumber") == 3, F.col("l_quantity") / 1000)
        .when(F.col("l_linenumber") == 5, F.col("l_quantity") + 0.125)
        .otherwise(F.col("l_quantity") - 2)
        .alias("quantity"),
        F.round(F.col("l_extendedprice") * 1.0001, 6).alias("unit_price"),
        F.round(F.col("l_discount") / 8, 6).alias("discount"),
    )


def sales(spark: SparkSession, folder: str) -> DataFrame:
    return sales_of(table(spark, folder, "lineitem"))


def valid_stores(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "supplier").filter("s_acctbal >= 0").select("s_suppkey")


def stores(spark: SparkSession, folder: str) -> DataFrame:
    supplier = table(spark, folder, "supplier")
    nation = table(spark, folder, "nation")
    region = table(spark, folder, "region")
    return (
        supplier.join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            F.col("s_suppkey").alias("store_id"),
            F.col("s_name").alias("store_name"),
            F.col("r_name").alias("region"),
        )
    )


def products(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "part").select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.col("p_type").alias("category"),
    )


def staged_orders(spark: SparkSession, folder: str) -> DataFrame:
    no_time = (F.col("l_linenumber") == 7) & (F.col("l_tax") == 0)
    currency = F.when(F.col("l_returnflag") == "N", "USD").when(F.col("l_returnflag") == "A", "EUR")
    return table(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("order_id"),
        F.when(~F.coalesce(no_time, F.lit(False)), F.col("l_shipdate")).alias("order_timestamp"),
        F.nullif(F.col("l_suppkey") % 50, F.lit(0)).alias("customer_id"),
        F.nullif(F.col("l_partkey") % 50, F.lit(0)).alias("product_id"),
        (F.col("l_quantity") - 5).cast("int").alias("quantity"),
        F.col("l_extendedprice").alias("total_amount"),
        currency.alias("currency"),
        F.col("l_linestatus").alias("status"),
    )


def customers(spark: SparkSession, folder: str) -> DataFrame:
    customer = table(spark, folder, "customer")
    nation = table(spark, folder, "nation")
    return customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.col("c_custkey").alias("customer_id"),
        F.col("c_name").alias("name"),
        F.col("n_name").alias("country"),
    )


def catalogue(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "part").select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.col("p_type").alias("category"),
        F.col("p_retailprice").alias("unit_price"),
    )


def dimension_pair(rows: DataFrame, key: str, attribute: str) -> tuple[DataFrame, DataFrame]:
    """An existing dimension with stale attributes, and incoming rows, each twice."""
    existing = rows.filter(F.col(key) % 2 == 0).withColumn(attribute, F.lit("OLD"))
    incoming = rows.filter(F.col(key) % 3 != 0)
    return existing, union_rows(incoming, incoming)


def order_book(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders")
    customer = table(spark, folder, "customer").select("c_custkey", "c_nationkey")
    nation = table(spark, folder, "nation").select("n_nationkey", "n_name")
    return (
        orders.join(customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            F.col("o_orderkey").alias("order_id"),
            F.col("o_orderdate").alias("order_timestamp"),
            F.col("o_custkey").alias("customer_id"),
            F.col("n_name").alias("country"),
            F.col("o_totalprice").alias("amount"),
            F.col("o_orderstatus").alias("status"),
            F.to_date("o_orderdate").alias("order_date"),
        )
    )


def pos_sales(spark: SparkSession, folder: str) -> DataFrame:
    lineitem = table(spark, folder, "lineitem")
    supplier = table(spark, folder, "supplier").select("s_suppkey", "s_name")
    # Totals of seven decimals.
    total = F.col("l_extendedprice").cast("decimal(18,2)") * F.lit("1.00001").cast("decimal(6,5)")
    return lineitem.join(supplier, F.col("l_suppkey") == F.col("s_suppkey")).select(
        F.col("s_name").alias("store_name"),
        F.to_date("l_shipdate").alias("date"),
        (F.col("l_quantity") - 1).cast("int").alias("quantity"),
        F.when(F.col("l_linenumber") != 7, total.cast("decimal(18,7)")).alias("total"),
        F.nullif(F.col("l_suppkey") % 20, F.lit(0)).alias("customer_id"),
        F.when(F.col("l_returnflag") != "R", F.col("l_returnflag")).alias("promo_code"),
    )

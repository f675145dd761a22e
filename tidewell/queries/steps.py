"""One query per step, over the test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidewell.functions import keep_domain, trimmed
from tidewell.operators import (
    changes,
    generate,
    keys,
    layout,
    preview,
    quality,
    sets,
    stats,
    validity,
)
from tidewell.operators.versions import VersionedTable
from tidewell.plans import orders as order_plan
from tidewell.plans import pos, taxi, warehouse
from tidewell.plans import sales as sales_plan
from tidewell.queries import views
from tidewell.queries.register import query
from tidewell.session import fresh_path, materialize
from tidewell.sources import inline_rows, row_position
from tidewell.streaming import ExpectationMeter, expect_or_drop, read_stream_table, run_available

FARE_OVER, DISTANCE_UNDER = 50000, 5
COUNTRY = "NATION_1"
ORDER_DAY = "1999-01-15"
SLICE_DAY, NEXT_DAY = "1996-07-06", "1996-07-07"
DOMAIN = ["view", "click", "purchase"]

# -- trips -----------------------------------------------------------------


def _kept_trips(spark: SparkSession, folder: str) -> DataFrame:
    return views.trips(spark, folder).filter(taxi.valid_distance())


def _stream(spark: SparkSession, folder: str) -> tuple[str, T.StructType, StreamingQuery]:
    """Stream the trips into a fresh table: its base folder, its columns, the run."""
    base = fresh_path(spark, "trips")
    schema = views.table(spark, folder, "lineitem").schema
    # A stream reads folders; as a pattern the path may also be that of one file.
    lines = read_stream_table(spark, f"{folder}/lineitem.parque[t]", schema)
    trips = views.trips_of(lines)
    kept = expect_or_drop(trips, taxi.valid_distance())
    return base, trips.schema, run_available(kept, f"{base}/raw", f"{base}/_checkpoints/raw")


def _ingested(spark: SparkSession, folder: str) -> tuple[str, DataFrame]:
    base, schema, _ = _stream(spark, folder)
    return base, spark.read.schema(schema).parquet(f"{base}/raw")


@query
def stream_expectation_counts(spark: SparkSession, folder: str) -> DataFrame:
    meter = ExpectationMeter()
    spark.streams.addListener(meter)
    try:
        counts = meter.counts(_stream(spark, folder)[2])
    finally:
        spark.streams.removeListener(meter)
    return inline_rows(spark, [tuple(counts.values())], "n_in bigint, n_dropped bigint")


@query
def stream_ingest_expect(spark: SparkSession, folder: str) -> DataFrame:
    return _ingested(spark, folder)[1]


@query
def stream_flagged_rides(spark: SparkSession, folder: str) -> DataFrame:
    base, raw = _ingested(spark, folder)
    taxi.flag_stream(spark, raw.schema, base, FARE_OVER, DISTANCE_UNDER)
    schema = taxi.flagged_rides(raw).schema
    return spark.read.schema(schema).parquet(f"{base}/flagged")


@query
def expectation_counts(spark: SparkSession, folder: str) -> DataFrame:
    return validity.expectation_counts(views.trips(spark, folder), taxi.valid_distance())


@query
def flagged_rides(spark: SparkSession, folder: str) -> DataFrame:
    return taxi.flagged_rides(_kept_trips(spark, folder), FARE_OVER, DISTANCE_UNDER)


@query
def weekly_stats(spark: SparkSession, folder: str) -> DataFrame:
    return taxi.weekly_stats(_kept_trips(spark, folder))


@query
def top_n_rides(spark: SparkSession, folder: str) -> DataFrame:
    return taxi.top_rides(flagged_rides(spark, folder), weekly_stats(spark, folder))


# -- sales layers ----------------------------------------------------------


@query
def bronze_enrich(spark: SparkSession, folder: str) -> DataFrame:
    return sales_plan.bronze(views.sales(spark, folder)).drop("ingestion_timestamp")


@query
def silver_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return sales_plan.dedup(views.sales(spark, folder))


@query
def silver_valid(spark: SparkSession, folder: str) -> DataFrame:
    return sales_plan.silver_valid(views.sales(spark, folder), views.valid_stores(spark, folder))


@query
def silver_quarantine(spark: SparkSession, folder: str) -> DataFrame:
    return sales_plan.silver_quarantine(
        views.sales(spark, folder), views.valid_stores(spark, folder)
    )


@query
def merge_upsert(spark: SparkSession, folder: str) -> DataFrame:
    silver = materialize(silver_valid(spark, folder), "silver")
    target = silver.filter(F.col("transaction_id") % 2 == 0)
    source = sales_plan.add_correct_total(
        silver.filter(F.col("transaction_id") % 3 != 0)
        .withColumn("discount", F.col("discount") * 2)
    )
    return changes.merge_upsert(target, source, [sales_plan.KEY])


@query
def gold_daily_sales(spark: SparkSession, folder: str) -> DataFrame:
    return sales_plan.daily_trend(sales_plan.daily_sales(silver_valid(spark, folder)))


@query
def gold_monthly_region(spark: SparkSession, folder: str) -> DataFrame:
    return sales_plan.monthly_region(silver_valid(spark, folder), views.stores(spark, folder))


@query
def gold_product_performance(spark: SparkSession, folder: str) -> DataFrame:
    return sales_plan.product_performance(silver_valid(spark, folder), views.products(spark, folder))


@query
def gold_reconcile(spark: SparkSession, folder: str) -> DataFrame:
    silver = materialize(sales_plan.presummed(silver_valid(spark, folder)), "presummed")
    gold = {
        "daily_sales": (sales_plan.daily_sales(silver), "daily_revenue"),
        "monthly_region": (
            sales_plan.monthly_region(silver, views.stores(spark, folder)),
            "monthly_revenue",
        ),
        "product_performance": (
            sales_plan.product_performance(silver, views.products(spark, folder)),
            "total_revenue",
        ),
    }
    return sales_plan.reconcile(silver, gold)


@query
def report_total_revenue(spark: SparkSession, folder: str) -> DataFrame:
    return sales_plan.total_revenue(sales_plan.daily_sales(silver_valid(spark, folder)))


@query
def report_top_products(spark: SparkSession, folder: str) -> DataFrame:
    return sales_plan.top_products(gold_product_performance(spark, folder))


@query
def report_category_revenue(spark: SparkSession, folder: str) -> DataFrame:
    return sales_plan.category_revenue(gold_product_performance(spark, folder))


# -- warehouse -------------------------------------------------------------


@query
def dim_customers_upsert(spark: SparkSession, folder: str) -> DataFrame:
    existing, incoming = views.dimension_pair(
        views.customers(spark, folder), "customer_id", "country"
    )
    return changes.upsert_dimension(existing, incoming, ["customer_id"])


@query
def dim_products_upsert(spark: SparkSession, folder: str) -> DataFrame:
    existing, incoming = views.dimension_pair(
        views.catalogue(spark, folder), "product_id", "category"
    )
    return changes.upsert_dimension(existing, incoming, ["product_id"])


@query
def latest_order(spark: SparkSession, folder: str) -> DataFrame:
    return warehouse.latest_orders(views.staged_orders(spark, folder))


@query
def fact_orders(spark: SparkSession, folder: str) -> DataFrame:
    return warehouse.fact_orders(views.staged_orders(spark, folder))


@query
def fact_orders_slice(spark: SparkSession, folder: str) -> DataFrame:
    fact = materialize(fact_orders(spark, folder), "fact")
    day, next_day = F.lit(SLICE_DAY).cast("date"), F.lit(NEXT_DAY).cast("date")
    doubled = fact.withColumn("quantity", F.col("quantity") * 2)
    again = doubled.filter(F.col("order_date").isin(day, next_day))
    unseen = doubled.filter(F.col("order_date") == next_day).withColumn(
        "order_id", -1 - F.col("order_id")
    )
    return changes.replace_slice(fact, again.union(unseen), "order_date", day, "order_id")


@query
def dq_report(spark: SparkSession, folder: str) -> DataFrame:
    fact = materialize(fact_orders(spark, folder), "fact")
    match = warehouse.rowcount_match(views.staged_orders(spark, folder), fact)
    return quality.report(
        quality.not_empty(dim_customers_upsert(spark, folder), "dim_customers_not_empty"),
        quality.bad_rows(fact, warehouse.key_rules()),
        quality.bad_rows(match, {"fact_orders_rowcount_match": ~F.col("passed")}),
    )


@query
def dq_rowcount_match(spark: SparkSession, folder: str) -> DataFrame:
    return warehouse.rowcount_match(views.staged_orders(spark, folder), fact_orders(spark, folder))


@query
def low_volume_days(spark: SparkSession, folder: str) -> DataFrame:
    dated = views.table(spark, folder, "orders").select(F.to_date("o_orderdate").alias("day"))
    return quality.low_volume_days(dated, "day", threshold=3)


# -- order table -----------------------------------------------------------


@query
def pruned_orders(spark: SparkSession, folder: str) -> DataFrame:
    return order_plan.pruned(views.order_book(spark, folder), COUNTRY, ORDER_DAY)


@query
def partition_inventory(spark: SparkSession, folder: str) -> DataFrame:
    return layout.partition_inventory(views.order_book(spark, folder), order_plan.PARTITIONS)


def _update(status: str = "P") -> tuple:
    hit = (F.col("country") == COUNTRY) & (F.col("status") == "O")
    return hit, {"status": F.lit(status)}


@query
def update_where(spark: SparkSession, folder: str) -> DataFrame:
    return changes.update_where(views.order_book(spark, folder), *_update())


@query
def delete_where(spark: SparkSession, folder: str) -> DataFrame:
    return changes.delete_where(views.order_book(spark, folder), F.col("amount") < 5000)


@query
def schema_evolve_append(spark: SparkSession, folder: str) -> DataFrame:
    rows = [
        (-1, "2024-05-17 16:45:10", -7, "Iceland", 42.75, "F", "voucher", "MAY"),
        (-2, "2024-06-02 08:05:00", -8, "Peru", 1310.0, "O", None, "JUNE"),
    ]
    schema = (
        "order_id bigint, order_timestamp string, customer_id bigint, country string, "
        "amount double, status string, payment_method string, coupon_code string"
    )
    new = inline_rows(spark, rows, schema).withColumn(
        "order_timestamp", F.col("order_timestamp").cast("timestamp_ntz")
    )
    return changes.append_evolved(
        views.order_book(spark, folder), order_plan.with_order_date(new)
    )


def _changed_table(spark: SparkSession, folder: str) -> VersionedTable:
    """The order book written, then updated, then cut down: versions 0, 1 and 2."""
    changed = VersionedTable(spark, fresh_path(spark, "orders"), ["country"])
    changed.create(views.order_book(spark, folder))
    changed.update(*_update())
    changed.delete(F.col("amount") < 5000)
    return changed


@query
def as_of_version(spark: SparkSession, folder: str) -> DataFrame:
    return _changed_table(spark, folder).as_of(1).select("order_id", "country", "status")


@query
def table_history(spark: SparkSession, folder: str) -> DataFrame:
    return _changed_table(spark, folder).history().select("version", "operation", "n_rows")


# -- point of sale ---------------------------------------------------------


@query
def filter_store(spark: SparkSession, folder: str) -> DataFrame:
    return pos.by_store(views.pos_sales(spark, folder), "Supplier#000000007")


@query
def filter_date_range(spark: SparkSession, folder: str) -> DataFrame:
    return pos.by_dates(views.pos_sales(spark, folder), "1997-02-01", "1997-03-15")


@query
def filter_high_value(spark: SparkSession, folder: str) -> DataFrame:
    return pos.high_value(views.pos_sales(spark, folder), 50000)


@query
def dedup_rows(spark: SparkSession, folder: str) -> DataFrame:
    rows = views.pos_sales(spark, folder)
    return keys.distinct_rows(sets.union_rows(rows, rows))


@query
def clean_sales(spark: SparkSession, folder: str) -> DataFrame:
    return pos.clean(views.pos_sales(spark, folder))


@query
def derive_fields(spark: SparkSession, folder: str) -> DataFrame:
    return pos.derive(clean_sales(spark, folder))


@query
def sales_stats(spark: SparkSession, folder: str) -> DataFrame:
    found = stats.amount_stats(clean_sales(spark, folder), "total")
    return found.select(*[F.round(c, 4).alias(c) for c in found.columns])


@query
def total_by_store(spark: SparkSession, folder: str) -> DataFrame:
    return stats.total_by(clean_sales(spark, folder), "store_name", "total")


@query
def null_counts(spark: SparkSession, folder: str) -> DataFrame:
    return stats.null_counts(views.pos_sales(spark, folder))


@query
def id_range(spark: SparkSession, folder: str) -> DataFrame:
    return stats.id_range(views.sales(spark, folder), "transaction_id")


@query
def table_shape(spark: SparkSession, folder: str) -> DataFrame:
    return stats.table_shape(views.pos_sales(spark, folder))


@query
def table_info(spark: SparkSession, folder: str) -> DataFrame:
    return stats.table_info(views.pos_sales(spark, folder))


@query
def describe_categorical(spark: SparkSession, folder: str) -> DataFrame:
    return stats.describe_categorical(views.table(spark, folder, "events"), "event_type")


@query
def closed_domain(spark: SparkSession, folder: str) -> DataFrame:
    return views.table(spark, folder, "events").select(
        "event_id", keep_domain("event_type", DOMAIN).alias("cat")
    )


@query
def trim_fields(spark: SparkSession, folder: str) -> DataFrame:
    padded = F.concat(F.lit("  "), F.col("c_name"), F.lit(" "))
    return views.table(spark, folder, "customer").select("c_custkey", trimmed(padded).alias("c_name"))


# -- sets, previews, made-up rows ------------------------------------------


def _part_keys(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    parts = views.table(spark, folder, "part").select(F.col("p_partkey").alias("key"))
    bulk = views.table(spark, folder, "lineitem").filter("l_quantity > 45")
    return parts, bulk.select(F.col("l_partkey").alias("key"))


@query
def except_rows(spark: SparkSession, folder: str) -> DataFrame:
    return sets.except_rows(*_part_keys(spark, folder))


@query
def union_all(spark: SparkSession, folder: str) -> DataFrame:
    return sets.union_rows(*_part_keys(spark, folder))


@query
def preview_first_n(spark: SparkSession, folder: str) -> DataFrame:
    return preview.first_n(views.table(spark, folder, "orders"), ["o_orderkey"])


@query
def preview_last_n(spark: SparkSession, folder: str) -> DataFrame:
    return preview.last_n(views.table(spark, folder, "orders"), ["o_orderkey"])


@query
def shuffled_sales(spark: SparkSession, folder: str) -> DataFrame:
    lines = views.table(spark, folder, "lineitem")
    rows = views.sales_of(lines)
    placed = lines.select("*", *row_position())
    shuffled = preview.shuffle_rows(placed, ["_file", "_row"], seed=42)
    return views.sales_of(shuffled).select(*rows.columns)


@query
def generate_sales(spark: SparkSession, folder: str) -> DataFrame:
    """The table's rows and as many made-up ones, with copies of some."""
    price = F.col("l_extendedprice").cast("decimal(18,2)")
    quantity = F.col("l_quantity").cast("int")
    known = views.table(spark, folder, "lineitem").select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("transaction_id"),
        F.col("l_suppkey").alias("store_id"),
        F.concat(F.lit("Store "), "l_suppkey").alias("store_name"),
        F.to_date("l_shipdate").alias("date"),
        F.col("l_partkey").alias("product_id"),
        F.concat(F.lit("Product "), "l_partkey").alias("product_name"),
        quantity.alias("quantity"),
        price.alias("unit_price"),
        (quantity * price).cast("decimal(18,2)").alias("total"),
        F.lit(None).cast("int").alias("customer_id"),
        F.lit(None).cast("string").alias("promo_code"),
    )
    size = known.agg(F.count(F.lit(1)).alias("n"), F.max("transaction_id").alias("last")).first()
    made = generate.generate_sales(spark, size["last"] or 0, size["n"])
    return sets.union_rows(known, made)

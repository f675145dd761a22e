"""Taxi trips: ingest with an expectation, suspicious rides, weekly averages, top rides."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewell.functions import exact_mean, week_start
from tidewell.sinks import overwrite
from tidewell.streaming import ExpectationMeter, expect_or_drop, read_stream_table, run_available

PICKUP = "tpep_pickup_datetime"


def valid_distance() -> Column:
    """The expectation on every trip."""
    return F.col("trip_distance") > 0.0


def flagged_rides(
    trips: DataFrame, fare_over: float = 50, distance_under: float = 5
) -> DataFrame:
    """Dear rides that end where they began, or are short. Works on a stream, too."""
    dear = F.col("fare_amount") > fare_over
    same_zip = F.col("pickup_zip") == F.col("dropoff_zip")
    short = F.col("trip_distance") < distance_under
    return trips.filter((same_zip & dear) | (short & dear)).select(
        week_start(PICKUP).alias("week"),
        F.col("pickup_zip").alias("zip"),
        "fare_amount",
        "trip_distance",
    )


def weekly_stats(trips: DataFrame) -> DataFrame:
    """Mean fare and distance per week, in order of the week."""
    return (
        trips.groupBy(week_start(PICKUP).alias("week"))
        .agg(
            exact_mean("fare_amount").alias("avg_amount"),
            exact_mean("trip_distance").alias("avg_distance"),
        )
        .orderBy("week")
    )


def top_rides(flagged: DataFrame, weekly: DataFrame, n: int = 3) -> DataFrame:
    """The ``n`` dearest flagged rides, each with its week's rounded averages.

    The best rides are found before the join: a left join keeps each of them and
    the order is by their own columns, so only ``n`` rows have to be joined.
    """
    order = [F.desc_nulls_last("fare_amount"), "week", "zip", "trip_distance"]
    best = flagged.orderBy(*order).limit(n)
    return (
        best.join(weekly, "week", "left")
        .select(
            "week",
            F.round("avg_amount", 2).alias("avg_amount"),
            F.round("avg_distance", 3).alias("avg_distance"),
            "fare_amount",
            "trip_distance",
            "zip",
        )
        .orderBy(*order)
        .limit(n)
    )


def ingest(
    spark: SparkSession, source: str, schema: T.StructType, base: str, files: str | None = None
) -> dict[str, int | None]:
    """Stream new trips into ``<base>/raw``; ``n_in`` and ``n_dropped`` of this run."""
    meter = ExpectationMeter()
    spark.streams.addListener(meter)
    try:
        trips = expect_or_drop(read_stream_table(spark, source, schema, files), valid_distance())
        query = run_available(trips, f"{base}/raw", f"{base}/_checkpoints/raw")
        return meter.counts(query)
    finally:
        spark.streams.removeListener(meter)


def flag_stream(
    spark: SparkSession, schema: T.StructType, base: str, fare_over: float = 50, distance_under: float = 5
) -> None:
    """Stream what is new in ``<base>/raw`` into ``<base>/flagged``."""
    raw = read_stream_table(spark, f"{base}/raw", schema)
    run_available(
        flagged_rides(raw, fare_over, distance_under), f"{base}/flagged", f"{base}/_checkpoints/flagged"
    )


def run(
    spark: SparkSession, source: str, schema: T.StructType, base: str, n: int = 3
) -> dict[str, int | None]:
    """One refresh: both streams, then both summary tables anew."""
    counts = ingest(spark, source, schema, base)
    flag_stream(spark, schema, base)
    weekly = weekly_stats(spark.read.schema(schema).parquet(f"{base}/raw"))
    overwrite(weekly, f"{base}/weekly")
    flagged_schema = flagged_rides(spark.createDataFrame([], schema)).schema
    best = top_rides(
        spark.read.schema(flagged_schema).parquet(f"{base}/flagged"),
        spark.read.parquet(f"{base}/weekly"),
        n,
    )
    counts["n_top"] = overwrite(best, f"{base}/top")
    return counts

"""Point-of-sale rows: filters, cleaning, statistics, derived columns, JSON output."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewell.functions import day_name, exact_mean, fill_text, month_number, ratio
from tidewell.operators.generate import generate_sales, sales_rows
from tidewell.operators.preview import first_n, last_n, shuffle_rows
from tidewell.operators.sets import union_rows
from tidewell.operators.stats import amount_stats, id_range, null_counts, table_shape
from tidewell.session import materialized
from tidewell.sinks import write_csv, write_json_records
from tidewell.sources import read_csv_with_date, row_position

def by_store(rows: DataFrame, store_name: str) -> DataFrame:
    return rows.filter(F.col("store_name") == store_name)


def by_dates(rows: DataFrame, first: dt.date | str, last: dt.date | str) -> DataFrame:
    """Rows from ``first`` to ``last``, both included."""
    return rows.filter(F.col("date").between(F.lit(first).cast("date"), F.lit(last).cast("date")))


def high_value(rows: DataFrame, threshold: float) -> DataFrame:
    return rows.filter(F.col("total") > threshold)


def clean(rows: DataFrame) -> DataFrame:
    """Distinct rows, missing values filled.

    A missing total becomes the mean over the distinct rows, in the type of the totals (rounded half up
    to a decimal's places; a DOUBLE for whole numbers). Totals that are there stay as they are. The mean
    is a scalar subquery on the same distinct rows, whose shuffle Spark does once for both.
    """
    distinct = rows.distinct()
    kind = dict(rows.dtypes)["total"]
    mean = exact_mean("total")
    if kind.startswith("decimal"):
        mean = F.round(mean, int(kind.rstrip(")").split(",")[1])).cast(kind)
    else:
        kind = kind if kind == "float" else "double"
    mean = distinct.agg(mean.cast(kind).alias("mean")).scalar()
    filled = {
        "total": F.coalesce(F.col("total").cast(kind), mean),
        "customer_id": fill_text("customer_id", "Unknown"),
        "promo_code": fill_text("promo_code", "No Code"),
    }
    return distinct.withColumns(filled)


def derive(cleaned: DataFrame) -> DataFrame:
    return cleaned.withColumns(
        {
            "revenue_per_item": ratio("total", "quantity"),
            "month": month_number("date"),
            "day_of_week": day_name("date"),
        }
    )


def run(
    spark: SparkSession, csv: str, output: str, schema: T.StructType | str | None = None
) -> tuple[int, DataFrame]:
    """Clean a CSV file and write it as JSON lines; rows written and the statistics.

    Give ``schema`` to save the pass over the file that finds the types.
    """
    received = read_csv_with_date(spark, csv, "date", schema)
    with materialized(clean(received), "pos-clean") as cleaned:
        statistics = amount_stats(cleaned, "total")
        return write_json_records(derive(cleaned), output), statistics


def extend(
    spark: SparkSession, csv: str, output: str, n: int = 990, seed: int = 42
) -> dict[str, DataFrame]:
    """Add ``n`` made-up rows (and their copies) to a file's rows, shuffle all, write CSV.

    Returns looks at the result: first and last rows, shape, missing values, id range.
    """
    types = sales_rows(spark.range(0), seed).schema
    existing = spark.read.schema(types).option("header", True).csv(csv)
    last = existing.agg(F.coalesce(F.max("transaction_id"), F.lit(0))).first()[0]
    combined = union_rows(existing, generate_sales(spark, last, n, seed))
    # Stored first: a row's place in the files tells copies apart in the shuffle.
    with materialized(combined, "pos-extended") as stored:
        placed = stored.select("*", *row_position())
        write_csv(shuffle_rows(placed, ["_file", "_row"], seed).drop("_file", "_row"), output)
    written = spark.read.schema(types).option("header", True).csv(output)
    return {
        "first": first_n(written, ["transaction_id"]),
        "last": last_n(written, ["transaction_id"]),
        "shape": table_shape(written),
        "missing": null_counts(written),
        "ids": id_range(written, "transaction_id"),
    }

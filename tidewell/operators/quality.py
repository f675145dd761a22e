"""Checks of finished tables."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

LOW_VOLUME_MESSAGE = "Low order volume detected in fact_orders"  # fixed value


class QualityError(ValueError):
    """A table failed a check."""


def bad_rows(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """``check``, ``bad_count``, ``passed``: rows for which each rule is TRUE, in one pass."""
    counts = df.agg(*[F.count_if(rule).alias(name) for name, rule in rules.items()])
    lines = F.array(
        *[F.struct(F.lit(n).alias("check"), F.col(n).alias("bad_count")) for n in rules]
    )
    return counts.select(F.inline(lines)).withColumn("passed", F.col("bad_count") == 0)


def not_empty(df: DataFrame, check: str) -> DataFrame:
    """One line of the report; ``bad_count`` is 1 when ``df`` has no row.

    One row per task is enough to tell, so a limit stands below the count.
    """
    return (
        df.select(F.lit(1).alias("one"))
        .limit(1)
        .agg((F.lit(1) - F.count("one")).cast("bigint").alias("bad_count"))
        .select(F.lit(check).alias("check"), "bad_count", (F.col("bad_count") == 0).alias("passed"))
    )


def report(*parts: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def enforce(checks: DataFrame) -> None:
    """Raise if a line of a report failed (a report has one line per rule)."""
    failed = checks.filter(~F.col("passed")).select("check", "bad_count").collect()
    if failed:
        told = ", ".join(f"{line['check']} ({line['bad_count']})" for line in failed)
        raise QualityError(f"checks failed: {told}")


def count_match(expected: DataFrame, actual: DataFrame, by: str) -> DataFrame:
    """``by``, ``valid_count``, ``fact_count``, ``passed``: row counts of two tables per value.

    Both are counted in one grouping, where NULL is a value like any other. A
    value that only one side has gets a 0 on the other.
    """
    sides = expected.select(by, F.lit(1).alias("v"), F.lit(0).alias("f")).union(
        actual.select(by, F.lit(0).alias("v"), F.lit(1).alias("f"))
    )
    return (
        sides.groupBy(by)
        .agg(F.sum("v").alias("valid_count"), F.sum("f").alias("fact_count"))
        .withColumn("passed", F.col("valid_count") == F.col("fact_count"))
    )


def daily_counts(df: DataFrame, date_column: str) -> DataFrame:
    return (
        df.filter(F.col(date_column).isNotNull())
        .groupBy(F.col(date_column).alias("order_date"))
        .agg(F.count(F.lit(1)).alias("order_count"))
    )


def _summary(counts: DataFrame, threshold: int) -> DataFrame:
    return counts.filter(F.col("order_count") < threshold).select(
        "order_date",
        "order_count",
        F.lit(threshold).cast("bigint").alias("threshold"),
        F.lit(LOW_VOLUME_MESSAGE).alias("message"),
    )


def low_volume_days(df: DataFrame, date_column: str, threshold: int = 10) -> DataFrame:
    """Days with fewer rows than ``threshold``; days between the first and last without any count 0."""
    counts = daily_counts(df, date_column)
    # One row a day and no more reaches the window; each also stands for the empty days up to the next.
    following = F.col("_next")
    counts = counts.withColumn("_next", F.lead("order_date").over(Window.orderBy("order_date")))
    gap = F.sequence(F.date_add("order_date", 1), F.date_sub(following, 1))
    empty = F.when(F.datediff(following, "order_date") > 1, gap).otherwise(F.array().cast("array<date>"))
    zero = F.lit(0).cast("bigint").alias("order_count")
    days = F.concat(
        F.array(F.struct("order_date", "order_count")),
        F.transform(empty, lambda d: F.struct(d.alias("order_date"), zero)),
    )
    return _summary(counts.select(F.inline(days)), threshold)


def low_volume_on(df: DataFrame, date_column: str, day: str, threshold: int = 10) -> DataFrame:
    """The summary of one day: one row if its volume is low, also with no row at all, else none."""
    count = df.filter(F.col(date_column) == F.lit(day).cast("date")).agg(
        F.count(F.lit(1)).alias("order_count")
    )
    return _summary(count.withColumn("order_date", F.lit(day).cast("date")), threshold)

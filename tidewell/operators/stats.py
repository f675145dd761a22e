"""Descriptions of tables and columns."""

from __future__ import annotations

import decimal

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from tidewell.functions import exact_number

#: Steps that a pass of the median search counts: what a task, and the one that adds them up, keeps at most.
SEARCH_STEPS = 65_536
#: Steps to each power of two in the first pass; over all powers that a DOUBLE has they are below SEARCH_STEPS.
OCTAVE_STEPS = 14


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Distinct non-NULL values with their frequency ``n``."""
    return df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n"))


def _magnitude(value: Column) -> Column:
    """A whole number that grows with the value, finer for smaller ones: its sign and logarithm."""
    size = F.abs(value.cast("double"))
    # From the smallest to the largest number; an infinite one is beyond.
    octaves = F.least(F.log2(size), F.lit(1030.0)) + 1076
    step = F.floor(octaves * OCTAVE_STEPS).cast("int") + 1
    return F.when(size == 0, F.lit(0)).when(value < 0, -step).otherwise(step)


def _steps(values: DataFrame, step: Column, *more: Column) -> DataFrame:
    """Count, least and greatest value of each step, added up in the tasks first."""
    return values.groupBy(step.alias("step")).agg(
        F.count(F.lit(1)).alias("n"), F.min("v").alias("low"), F.max("v").alias("high"), *more
    )


def _step_at(steps: DataFrame, position: Column) -> DataFrame:
    """The step that holds a position (from 0), the count before it, and the least value after it."""
    order = Window.orderBy("step")
    return (
        steps.withColumn("before", F.sum("n").over(order) - F.col("n"))
        .withColumn("next", F.lead("low").over(order))
        .filter((F.col("before") <= position) & (position < F.col("before") + F.col("n")))
    )


def amount_stats(df: DataFrame, column: str) -> DataFrame:
    """One row: ``mean``, ``median``, ``sum`` and ``average_basket`` of an amount, as DOUBLE.

    NULL and NaN are left out; all four are NULL where nothing else is there. Sums are of decimals, so
    exact, unless a value is not kept exactly as one (see ``exact_number``): then of doubles.

    A built-in exact median keeps every distinct value in one task. Here the column itself is searched:
    the first pass counts values by sign and magnitude, with the sums on the way; each further one cuts
    the range of the step that holds the middle into SEARCH_STEPS equal steps, until that step holds one
    value. Nothing but counts of at most SEARCH_STEPS steps leaves a task, and nothing is written.
    """
    kind = dict(df.dtypes)[column]
    value = F.col(column)
    if kind in ("tinyint", "smallint", "int", "bigint"):
        value, kind = value.cast("decimal(20,0)"), "decimal(20,0)"
    values = df.select(value.alias("v")).filter(F.col("v").isNotNull())
    if kind in ("float", "double"):
        values = values.filter(~F.isnan("v"))
    exact = exact_number("v", kind)
    sums = [F.try_sum(exact).alias("exact"), F.count(exact).alias("n_exact"), F.sum(F.col("v").cast("double")).alias("near")]
    steps = _steps(values, _magnitude(F.col("v")), *sums)
    whole = Window.partitionBy()
    totals = steps.select(
        "step", "n", "low", "high",
        F.sum("n").over(whole).alias("total"),
        F.when(F.sum("n_exact").over(whole) == F.sum("n").over(whole), F.try_sum("exact").over(whole)).alias("exact"),
        F.sum("near").over(whole).alias("near"),
    )
    middle = F.expr("(total - 1) div 2")
    found = _step_at(totals, middle).first()
    one_row = df.sparkSession.range(1, numPartitions=1)
    names = ["mean", "median", "sum", "average_basket"]
    if found is None:
        return one_row.select(*[F.lit(None).cast("double").alias(name) for name in names])
    n, total = found["total"], found["near"] if found["exact"] is None else found["exact"]
    lower, upper = _middle(values, found, (n - 1) // 2, n // 2)
    mean = float(total) / n
    results = [mean, float(lower) / 2 + float(upper) / 2 if n % 2 == 0 else float(lower), float(total), mean]
    return one_row.select(*[F.lit(r).alias(name) for r, name in zip(results, names, strict=True)])


def _middle(values: DataFrame, found: Row, position: int, upper: int) -> tuple:
    """The values at ``position`` and at ``upper``, the same or the next, given the step of the first."""
    before, after = 0, None
    while True:
        before += found["before"]
        after = after if found["next"] is None else found["next"]
        low, high = found["low"], found["high"]
        if low == high:
            return low, low if upper < before + found["n"] else after
        # Halves, so that the difference of any two doubles is one.
        half = lambda v: v.cast("double") / 2
        exact = isinstance(low, decimal.Decimal)
        offset = (F.col("v") - F.lit(low)).cast("double") if exact else half(F.col("v")) - low / 2
        width = float(high - low) if exact else high / 2 - low / 2
        step = F.least(F.floor(offset / F.lit(width) * SEARCH_STEPS).cast("int"), F.lit(SEARCH_STEPS - 1))
        within = values.filter(F.col("v").between(F.lit(low), F.lit(high)))
        found = _step_at(_steps(within, step), F.lit(position - before)).first()


def total_by(df: DataFrame, key: str, amount: str, name: str = "total") -> DataFrame:
    """Exact sum by key as DOUBLE; rows without a key are left out."""
    return (
        df.filter(F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.sum(amount).cast("double").alias(name))
    )


def describe_categorical(df: DataFrame, column: str) -> DataFrame:
    """One row: non-NULL ``count``, distinct ``unique``, most frequent ``top``, its ``freq``.

    Of equally frequent values the smallest is taken.
    """
    best = F.min(F.struct((-F.col("n")).alias("minus_n"), F.col(column).alias("value")))
    return (
        value_counts(df, column)
        .agg(
            F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("count"),
            F.count(F.lit(1)).alias("unique"),
            best.alias("best"),
        )
        .select(
            "count",
            "unique",
            F.col("best.value").alias("top"),
            (-F.col("best.minus_n")).alias("freq"),
        )
    )


def _per_column(df: DataFrame, measure: dict[str, Column], value: str) -> DataFrame:
    """One aggregate for all columns, turned into one row per column."""
    pairs = F.array(
        *[
            F.struct(F.lit(name).alias("column"), F.col(f"_{i}").alias(value))
            for i, name in enumerate(measure)
        ]
    )
    sums = df.agg(*[column.alias(f"_{i}") for i, column in enumerate(measure.values())])
    return sums.select(F.inline(pairs))


def null_counts(df: DataFrame) -> DataFrame:
    """``column``, ``n_null``: all columns in one pass."""
    return _per_column(df, {c: F.count_if(F.col(c).isNull()) for c in df.columns}, "n_null")


def table_info(df: DataFrame) -> DataFrame:
    """``column``, ``type``, ``n_non_null``: all columns in one pass."""
    types = dict(df.dtypes)
    named = F.create_map(*[F.lit(part) for pair in types.items() for part in pair])
    counts = _per_column(df, {c: F.count(c) for c in df.columns}, "n_non_null")
    return counts.select("column", named[F.col("column")].alias("type"), "n_non_null")


def table_shape(df: DataFrame) -> DataFrame:
    """One row: ``n_rows``, ``n_cols``."""
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"), F.lit(len(df.columns)).cast("bigint").alias("n_cols")
    )


def id_range(df: DataFrame, column: str) -> DataFrame:
    """One row: ``min_id``, ``max_id``."""
    return df.agg(F.min(column).alias("min_id"), F.max(column).alias("max_id"))

"""One row per key, and checks that keys are unique."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


class DuplicateKeyError(ValueError):
    """Several rows of a source claim the same target row."""


def latest_per_key(
    df: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[Column],
    tie_breakers: Sequence[str | Column] | None = None,
) -> DataFrame:
    """The first row of each key in the given order.

    Rows that tie are told apart by ``tie_breakers`` (default: every other
    column, ascending), so the survivor does not depend on how the data lies.
    The ``= 1`` filter makes Spark keep one row per key and task before the
    shuffle, so a key with very many copies does not land on one task whole.
    """
    if tie_breakers is None:
        tie_breakers = [name for name in df.columns if name not in keys]
    ordered = Window.partitionBy(*keys).orderBy(*order_by, *tie_breakers)
    rank = F.row_number().over(ordered)
    return df.withColumn("_rank", rank).filter(F.col("_rank") == 1).drop("_rank")


def distinct_rows(df: DataFrame) -> DataFrame:
    """Fully equal rows once; copies are merged in each task before the shuffle."""
    return df.distinct()


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with ``n_rows``. A NULL key equals no other."""
    present = df.select(*keys).dropna(subset=list(keys))
    return present.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).filter("n_rows > 1")


def require_unique(df: DataFrame, keys: Sequence[str], within: DataFrame | None = None) -> None:
    """Raise if a key occurs twice; with ``within``, only if that table has the key too."""
    repeated = duplicate_keys(df, keys)
    if within is not None:
        if repeated.isEmpty():
            return
        # Only a source that does repeat a key has the (far larger) target read.
        repeated = repeated.join(within.select(*keys), list(keys), "left_semi")
    # A sample for the message only: the check itself is whether there is any.
    found = repeated.orderBy(*keys).take(5)
    if found:
        named = [tuple(row[k] for k in keys) for row in found]
        raise DuplicateKeyError(f"several rows for one key {list(keys)}, for example {named}")

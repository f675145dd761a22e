"""First rows, last rows, best rows, shuffled rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def first_n(df: DataFrame, order_by: Sequence[Column | str], n: int = 10) -> DataFrame:
    """The first ``n`` rows in order. Each task keeps its own best ``n``; nothing is fully sorted."""
    return df.orderBy(*order_by).limit(n)


def last_n(df: DataFrame, order_by: Sequence[str], n: int = 10) -> DataFrame:
    """The last ``n`` rows, last one first."""
    return df.orderBy(*[F.col(c).desc_nulls_last() for c in order_by]).limit(n)


def shuffle_rows(df: DataFrame, row_id: Sequence[Column | str], seed: int) -> DataFrame:
    """All rows in an order that looks random and is the same for the same seed.

    ``row_id`` tells the rows apart; with rows that may be equal, use their
    place in the files (``row_position``), so that copies spread evenly.
    """
    return df.orderBy(F.xxhash64(*row_id, F.lit(seed)))

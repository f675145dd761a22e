"""Set operations."""

from __future__ import annotations

from pyspark.sql import DataFrame


def except_rows(left: DataFrame, right: DataFrame) -> DataFrame:
    """Distinct rows of ``left`` that are not in ``right``; NULLs count as equal.

    Copies are merged before the comparison moves any rows, so a row with very
    many copies is one row when it is shuffled.
    """
    return left.distinct().subtract(right.distinct())


def union_rows(left: DataFrame, right: DataFrame) -> DataFrame:
    """All rows of both, matched by column name, copies kept."""
    return left.unionByName(right)

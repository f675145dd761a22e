"""Row rules: accept, reject, and say why."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewell.operators.changes import is_true


def add_membership(df: DataFrame, members: DataFrame, column: str, flag: str) -> DataFrame:
    """Add boolean ``flag``: whether ``column`` occurs in the one-column frame ``members``.

    For a list of any length. Spark broadcasts ``members`` when it is small and
    otherwise joins by shuffle, where a value that holds much of ``df`` is split
    by adaptive execution.
    """
    wanted = members.select(F.col(members.columns[0]).alias(column)).dropna().distinct()
    marked = df.join(wanted.withColumn(flag, F.lit(True)), column, "left")
    return marked.withColumn(flag, is_true(F.col(flag))).select(*df.columns, flag)


def keep_members(df: DataFrame, members: DataFrame, column: str) -> DataFrame:
    """The rows whose ``column`` occurs in the one-column frame ``members``."""
    wanted = members.select(F.col(members.columns[0]).alias(column))
    return df.join(wanted, column, "left_semi").select(*df.columns)


def add_verdict(
    df: DataFrame, rules: Mapping[str, Column], flag: str = "is_valid", reason: str = "reject_reason"
) -> DataFrame:
    """Add ``flag`` and ``reason`` (the first rule, in order, that is not TRUE).

    A rule that comes out NULL counts as broken, so each row gets one verdict.
    """
    first_broken = F.coalesce(*[F.when(~is_true(rule), F.lit(name)) for name, rule in rules.items()])
    return df.withColumn(reason, first_broken).withColumn(flag, F.col(reason).isNull())


def expectation_counts(df: DataFrame, rule: Column) -> DataFrame:
    """One row: ``n_in``, ``n_dropped``, ``n_kept``."""
    kept = F.count_if(is_true(rule))
    total = F.count(F.lit(1))
    return df.agg(
        total.alias("n_in"), (total - kept).alias("n_dropped"), kept.alias("n_kept")
    )

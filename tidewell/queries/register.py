"""The table of named queries. Each takes a session and the folder of the test tables.

Decimals are shown as DOUBLE, so that results compare across engines.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]

REGISTERED: dict[str, Query] = {}


def _shown(df: DataFrame) -> DataFrame:
    return df.select(
        *[
            F.col(name).cast("double").alias(name) if kind.startswith("decimal") else F.col(name)
            for name, kind in df.dtypes
        ]
    )


def query(build: Query) -> Query:
    """Register a query under its function's name; the function itself stays as it is."""
    REGISTERED[build.__name__] = lambda spark, folder: _shown(build(spark, folder))
    return build

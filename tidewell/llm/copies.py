"""Rows that are given more than once, set apart before anything is done for each row."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewell.session import materialize


def once(rows: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, DataFrame | None]:
    """One row for each value of `keys` (nulls are values), and all rows of those given several times.

    The second is None where there are none; `rows` are then handed on as they are. Otherwise only
    repeated rows are brought together, merged in the tasks first, so their number does no harm.
    """
    hashed = rows.withColumn("_copy", F.xxhash64(*keys))
    seen = hashed.groupBy("_copy").agg(F.count("*").alias("n")).filter("n > 1").select("_copy")
    seen = materialize(seen, "given-again")
    if seen.isEmpty():
        return rows, None
    alone = hashed.join(seen, "_copy", "left_anti").drop("_copy")
    again = hashed.join(seen, "_copy", "left_semi").drop("_copy")
    rest = [c for c in rows.columns if c not in keys]
    first = again.groupBy(*keys).agg(*[F.first(c).alias(c) for c in rest]) if rest else again.distinct()
    return alone.unionByName(first.select(*rows.columns)), again


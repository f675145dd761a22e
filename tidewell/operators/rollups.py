"""Sums over a fact table by attributes of a dimension."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewell.functions import EXACT, TOTAL


def _exact(df: DataFrame, amount: str) -> Column:
    """The amount as a decimal; one that already is a sum stays as wide as it is."""
    wide = dict(df.dtypes)[amount].startswith("decimal(38")
    return F.col(amount) if wide else F.col(amount).cast(EXACT)


def sum_by(df: DataFrame, keys: Sequence[Column | str], amount: str, name: str) -> DataFrame:
    """Exact sum of ``amount`` by ``keys``, a decimal of eighteen places."""
    return df.groupBy(*keys).agg(F.sum(_exact(df, amount)).cast(TOTAL).alias(name))


def sum_by_attribute(
    fact: DataFrame,
    dimension: DataFrame,
    join_key: str,
    fact_keys: Sequence[Column],
    attributes: Sequence[str],
    amount: str,
    name: str,
) -> DataFrame:
    """Sum ``amount`` by ``fact_keys`` and by attributes of the joined dimension.

    The fact is first added up by join key, so the join sees one row per key
    and group however often the key occurs. Fact rows without a partner are
    lost (inner join), as they would be in the join before the sum; a sum goes
    through the join unchanged.
    """
    per_key = fact.groupBy(join_key, *fact_keys).agg(
        F.sum(_exact(fact, amount)).alias("_part")
    )
    joined = per_key.join(dimension.select(join_key, *attributes), join_key)
    group = [c for c in per_key.columns if c not in (join_key, "_part")]
    return joined.groupBy(*group, *attributes).agg(
        F.sum("_part").cast(TOTAL).alias(name)
    )

"""Amounts that keep all the digits of what they are computed from."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewell.functions import EXACT, exact_number

_WHOLE, _FRACTION, _SMALL = "decimal(18,0)", "decimal(18,18)", "decimal(37,36)"


def add_amount(df: DataFrame, factors: tuple[str, str], less: str, name: str) -> DataFrame:
    """Add ``name``: the product of two columns less a third, as EXACT.

    The columns may be numbers or texts. NULL where one is, or where EXACT cannot hold one of them, or
    the result, as it is: nothing is rounded. The factors' whole parts (of up to eighteen digits) and
    fractions are multiplied apart, so that each product and sum is of a type that Spark does not cut.
    Each step is a projection of its own, which keeps the expressions small.
    """
    types = dict(df.dtypes)

    def truncated(number: str) -> Column:
        return F.when(F.col(number) < 0, F.ceil(number)).otherwise(F.floor(number)).try_cast(_WHOLE)

    left, right = (exact_number(c, types[c]).try_cast("decimal(36,18)") for c in factors)
    stepped = df.withColumns({"_a": left, "_b": right, "_c": exact_number(less, types[less])})
    stepped = stepped.withColumns({"_a0": truncated("_a"), "_b0": truncated("_b")})
    stepped = stepped.withColumns(
        {f"_{x}1": (F.col(f"_{x}") - F.col(f"_{x}0")).try_cast(_FRACTION) for x in "ab"}
    )
    a0, b0, a1, b1 = (F.col(c) for c in ("_a0", "_b0", "_a1", "_b1"))
    stepped = stepped.withColumn("_small", a1 * b1)
    kept = F.col("_small").cast(EXACT)
    total = F.when(kept.cast(_SMALL) == F.col("_small"), kept)
    for part in (a0 * b0, a0 * b1, a1 * b0):
        total = (total + part.try_cast(EXACT)).try_cast(EXACT)
    amount = (total - F.col("_c")).try_cast(EXACT)
    return stepped.select(*[F.col(c) for c in df.columns if c != name], amount.alias(name))

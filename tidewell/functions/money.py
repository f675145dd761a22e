"""Arithmetic that gives the same result whatever order the rows arrive in.

Binary floating-point sums depend on the order of addition, so on a cluster they
change from run to run. Amounts are therefore turned into decimals before they
are summed.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(18,2)"
#: Holds nineteen digits before the point and eighteen after it, so that two can be added without a
#: cut. What needs more is never cut to it: see ``exact_number``. Sums of it are TOTAL.
EXACT, TOTAL = "decimal(37,18)", "decimal(38,18)"


def _column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def as_money(value: Column | str) -> Column:
    return _column(value).cast(MONEY)


def money_total(value: Column | str) -> Column:
    """Exact sum, returned as DOUBLE."""
    return F.sum(as_money(value)).cast("double")


def exact_number(value: Column | str, kind: str) -> Column:
    """A number of type ``kind`` (its name in Spark), or a text, as EXACT; NULL where that would change it.

    A text counts with all its digits, a DOUBLE as the shortest decimal that stands for it.
    """
    given = _column(value)
    number = given.try_cast(EXACT)
    if kind.startswith("decimal"):
        scale = int(kind.rstrip(")").split(",")[1])
        return number if scale <= 18 else F.when(number.try_cast(kind) == given, number)
    if kind in ("float", "double", "string"):
        near = F.when(number.cast("double") == given.try_cast("double"), number)
        if kind != "string":
            return near
        digits = F.rtrim(F.trim(given), F.lit("0"))
        few = ~given.contains(".") | (F.length(F.substring_index(digits, ".", -1)) <= 18)
        return F.when(F.lower(given).contains("e"), near).when(few, number)
    return number


def exact_mean(value: Column | str, number_type: str = EXACT) -> Column:
    """Mean of the non-NULL values from an exact sum; NULL when there are none."""
    exact = _column(value).cast(number_type)
    return F.try_divide(F.sum(exact).cast("double"), F.count(exact).cast("double"))


def ratio(numerator: Column | str, denominator: Column | str) -> Column:
    """Quotient as DOUBLE; NULL on division by zero."""
    return F.try_divide(_column(numerator).cast("double"), _column(denominator).cast("double"))

"""Expressions on text columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def trimmed(value: Column | str) -> Column:
    """The text without white space (blanks, tabs, line ends) at either end."""
    return F.btrim(value, F.lit(" \t\r\n\f\v"))


def fill_text(value: Column | str, default: str) -> Column:
    """NULL becomes ``default``; the column becomes text."""
    column = F.col(value) if isinstance(value, str) else value
    return F.coalesce(column.cast("string"), F.lit(default))


def keep_domain(value: Column | str, domain: Sequence[str]) -> Column:
    """Values outside the closed ``domain`` become NULL."""
    column = F.col(value) if isinstance(value, str) else value
    return F.when(column.isin(list(domain)), column)

"""Column expressions. All are built-in Spark expressions, so they stay in codegen."""

from tidewell.functions.dates import day_name, month_number, to_utc, week_start
from tidewell.functions.money import (
    EXACT,
    MONEY,
    TOTAL,
    as_money,
    exact_mean,
    exact_number,
    money_total,
    ratio,
)
from tidewell.functions.text import fill_text, keep_domain, trimmed

__all__ = [
    "EXACT",
    "MONEY",
    "TOTAL",
    "as_money",
    "day_name",
    "exact_mean",
    "exact_number",
    "fill_text",
    "keep_domain",
    "money_total",
    "month_number",
    "ratio",
    "to_utc",
    "trimmed",
    "week_start",
]

"""Date and time expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def week_start(moment: Column | str) -> Column:
    """Monday of the week of ``moment``, as DATE (so the session zone plays no part)."""
    return F.trunc(F.to_date(moment), "week")


def month_number(moment: Column | str) -> Column:
    """Month 1-12 as BIGINT. The year is not part of it."""
    return F.month(moment).cast("bigint")


def day_name(moment: Column | str) -> Column:
    """English name of the weekday."""
    return F.date_format(moment, "EEEE")


def to_utc(moment: Column | str, zone: str = "UTC") -> Column:
    """A zone-less local time of ``zone`` as zone-less UTC; the identity for UTC."""
    column = F.col(moment) if isinstance(moment, str) else moment
    if zone == "UTC":
        return column
    return F.convert_timezone(F.lit(zone), F.lit("UTC"), column.cast("timestamp_ntz"))

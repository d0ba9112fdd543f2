"""Periods in UTC, whatever the session's time zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

HOUR_US, DAY_US = 3_600_000_000, 86_400_000_000


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def hour_us(c: Column | str) -> Column:
    """The start of the UTC hour, in microseconds."""
    us = F.unix_micros(_col(c))
    return us - F.pmod(us, F.lit(HOUR_US))


def utc_hour(c: Column | str) -> Column:
    return F.timestamp_micros(hour_us(c))


def utc_day(c: Column | str) -> Column:
    """The UTC day as yyyy-MM-dd."""
    us = F.unix_micros(_col(c))
    days = ((us - F.pmod(us, F.lit(DAY_US))) / DAY_US).cast("int")
    return F.date_add(F.lit("1970-01-01").cast("date"), days).cast("string")

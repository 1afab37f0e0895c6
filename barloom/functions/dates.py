"""Date and time columns. All of them are independent of the session time zone except the two shifts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def trading_day(text: Column | str) -> Column:
    """Day of an ISO instant: its first ten characters; null where they are no date."""
    return F.substring(_c(text), 1, 10).try_cast("date")


def shift_to_utc(ts: Column | str, zone: str = "GMT+7") -> Column:
    """Read a wall-clock time of ``zone`` as UTC."""
    return F.to_utc_timestamp(_c(ts), zone)


def midnight(ts: Column | str) -> Column:
    """Start of the day."""
    return F.date_trunc("day", _c(ts))


def epoch_seconds(day: Column | str) -> Column:
    """Seconds from 1970-01-01 to the start of the day (UTC)."""
    return F.unix_date(_c(day)).cast("bigint") * 86400


def day_text(day: Column | str) -> Column:
    return F.date_format(_c(day), "yyyy-MM-dd")

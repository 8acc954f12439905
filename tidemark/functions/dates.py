"""Dates and times that do not depend on the session time zone."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

ISO_DAY = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"


def utc_day(epoch_seconds: Column) -> Column:
    """UTC calendar day of a unix time."""
    days = F.floor(epoch_seconds / F.lit(86400)).cast("int")
    return F.date_add(F.lit("1970-01-01").cast("date"), days)


def instant(value: Column | dt.datetime | str | None) -> Column:
    """An as-of time as a column; None means now (UTC)."""
    if isinstance(value, Column):
        return value
    if value is None:
        value = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    if isinstance(value, dt.datetime):
        value = value.isoformat(sep=" ")
    return F.lit(str(value)).cast("timestamp_ntz")


def day_text(value: Column) -> Column:
    return F.date_format(value, "yyyy-MM-dd")


def try_day(value: Column) -> Column:
    """Text to date; NULL instead of an error on bad text."""
    return value.try_cast("date")


def at_least(value: Column, now: Column, days: int) -> Column:
    """True where ``value`` is no older than ``days`` before ``now``."""
    return value >= now - F.expr(f"interval {int(days)} days")

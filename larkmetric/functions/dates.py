"""Calendar functions (DATE-1 … DATE-3, PRJ-13). All are free of time zones."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..config import EVENT_DATE_SHIFT_HOURS


def as_date(value: str | dt.date) -> dt.date:
    return dt.date.fromisoformat(value) if isinstance(value, str) else value


def local_today(utc_offset_hours: int = 9) -> dt.date:
    """Today's date where the business is; the usual ``as_of`` is the day before."""
    return dt.datetime.now(dt.timezone(dt.timedelta(hours=utc_offset_hours))).date()


def days_before(as_of: str | dt.date, n: int) -> dt.date:
    return as_date(as_of) - dt.timedelta(days=n)


def day_difference(start: Column, end: Column) -> Column:
    return F.datediff(end, start)


def text_to_date(c: Column, fmt: str = "yyyy-MM-dd HH:mm:ss") -> Column:
    return F.to_date(F.try_to_timestamp(c, F.lit(fmt)))


def local_event_date(epoch: Column, shift_hours: int = EVENT_DATE_SHIFT_HOURS) -> Column:
    """Date of ``epoch`` seconds less the shift, counted from 1970-01-01."""
    days = F.floor((epoch - shift_hours * 3600) / 86400).cast("int")
    return F.date_add(F.lit(dt.date(1970, 1, 1)), days)

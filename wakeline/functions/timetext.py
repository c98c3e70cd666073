"""ISO-8601 text with milliseconds and a Z suffix, independent of the session zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ISO_MS = "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"
ISO_TEXT = r"^\d{4}-\d\d-\d\dT\d\d:\d\d:\d\d(\.\d{1,9})?Z$"
CLOCK_MS = "HH:mm:ss.SSS'Z'"


def _utc(ts: Column) -> Column:
    return F.to_utc_timestamp(ts, F.current_timezone())


def iso_ms(ts: Column) -> Column:
    return F.date_format(_utc(ts), ISO_MS)


def clock_ms(ts: Column) -> Column:
    return F.date_format(_utc(ts), CLOCK_MS)


def parse_iso(text: Column) -> Column:
    """Timestamp of an ISO text in UTC; NULL when it is none. Kept to milliseconds."""
    return F.when(text.rlike(ISO_TEXT), F.date_trunc("millisecond", F.try_to_timestamp(text)))

"""Local clocks and instants, without help from the session zone.

Instants are TIMESTAMP values. A local clock read from the source is a TIMESTAMP too, holding the clock
as if it were UTC; it only serves to be converted or to give its calendar day. Both are handled through
their microseconds, so no result depends on ``spark.sql.session.timeZone``. Spark resolves the zone of
``to_utc_timestamp`` once per task, which makes it several times faster than ``convert_timezone``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EPOCH = "timestamp_ntz'1970-01-01 00:00:00'"
HOUR = 3_600_000_000
DAY_SECONDS = 86_400


def read_clock(text: Column) -> Column:
    """ISO text without zone (a time, or a day alone) to a local clock; unreadable text is an error."""
    suffix = F.when(F.length(text) > 10, "Z").otherwise("T00:00:00Z")
    return F.concat(F.trim(text), suffix).cast("timestamp")


def try_clock(text: Column) -> Column:
    """The zone-less time of a text; unreadable text is NULL."""
    return text.try_cast("timestamp_ntz")


def clock_to_instant(clock: Column, zone: str) -> Column:
    """Instant of a local clock.

    The hour repeated in autumn is read as its second pass (winter time): if the instant one hour later
    shows the same local clock, that later one is taken.
    """
    first = F.to_utc_timestamp(clock, zone)
    second = F.timestamp_micros(F.unix_micros(first) + HOUR)
    return F.when(F.from_utc_timestamp(second, zone) == clock, second).otherwise(first)


def instant_to_clock(instant: Column, zone: str) -> Column:
    return F.from_utc_timestamp(instant, zone)


def clock_day(clock: Column) -> Column:
    """Calendar day of a local clock, or the UTC day of an instant."""
    return F.date_from_unix_date(F.floor(F.unix_seconds(clock) / DAY_SECONDS).cast("int"))


def utc_clock(instant: Column) -> Column:
    """UTC reading of an instant as a zone-less time, for text output."""
    return F.timestamp_add("MICROSECOND", F.unix_micros(instant), F.expr(EPOCH))


def _utc_text(instant: Column, length: int) -> Column:
    text = F.left(utc_clock(instant).cast("string"), F.lit(length))
    return F.concat(F.translate(text, " ", "T"), F.lit("Z"))


def utc_minute_text(instant: Column) -> Column:
    """``2026-09-24T22:42Z``"""
    return _utc_text(instant, 16)


def utc_second_text(instant: Column) -> Column:
    """``2026-09-24T22:42:05Z``"""
    return _utc_text(instant, 19)


def days_between(start: Column, end: Column) -> Column:
    return F.datediff(end, start).cast("bigint")


def iso_year(day: Column) -> Column:
    return F.extract(F.lit("YEAROFWEEK"), day)

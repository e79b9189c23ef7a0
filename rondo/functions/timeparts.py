"""Epoch numbers to zone-free timestamps, and the calendar parts of a timestamp.

Everything is TIMESTAMP_NTZ arithmetic, so the result never depends on the session time zone, and every
expression is a built-in that stays inside code generation.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EPOCH = "timestamp_ntz'1970-01-01 00:00:00'"


def ms_to_timestamp(name: str) -> Column:
    """Epoch milliseconds to timestamp, milliseconds kept."""
    return F.expr(f"timestampadd(MILLISECOND, `{name}`, {EPOCH})")


def ms_to_second(name: str) -> Column:
    """Epoch milliseconds to timestamp, cut to the whole second."""
    return F.expr(f"timestampadd(SECOND, `{name}` div 1000, {EPOCH})")


def timestamp_to_ms(name: str) -> Column:
    """Zone-free timestamp to epoch milliseconds, microseconds floored.

    Built from date and clock fields: ``timestampdiff`` and ``date_trunc`` would first read the value in the
    session zone and move clock times that its summer-time gap skips.
    """
    return F.expr(
        f"unix_date(cast(`{name}` AS DATE)) * 86400000L + hour(`{name}`) * 3600000L + minute(`{name}`) * 60000L"
        f" + cast(floor(extract(SECOND FROM `{name}`) * 1000) AS BIGINT)"
    )


def minute_number(name: str) -> Column:
    """Whole minutes since the epoch of a zone-free timestamp."""
    return F.expr(f"unix_date(cast(`{name}` AS DATE)) * 1440L + hour(`{name}`) * 60 + minute(`{name}`)")


def weekday(ts: Column, style: str = "full") -> Column:
    """Day of week as ``full`` (Monday), ``short`` (Mon), ``padded`` (to nine) or ``number`` (Sunday is 0)."""
    day = ts.cast("date")
    if style == "full":
        return F.date_format(day, "EEEE")
    if style == "short":
        return F.date_format(day, "E")
    if style == "padded":
        return F.rpad(F.date_format(day, "EEEE"), 9, " ")
    if style == "number":
        return F.dayofweek(day) - F.lit(1)
    raise ValueError(f"unknown weekday style {style!r}")


def calendar_parts(ts: Column, weekday_style: str = "full") -> list[Column]:
    """The six derived columns of the time dimension."""
    return [
        F.hour(ts).alias("hour"),
        F.dayofmonth(ts).alias("day"),
        F.weekofyear(ts).alias("week"),
        F.month(ts).alias("month"),
        F.year(ts).alias("year"),
        weekday(ts, weekday_style).alias("weekday"),
    ]


def date_path(ts: Column, pattern: str = "yyyy/MM/dd") -> Column:
    """Folder path of a timestamp's day."""
    return F.date_format(ts.cast("date"), pattern)

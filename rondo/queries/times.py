"""Epoch conversions and calendar parts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rondo.functions.timeparts import ms_to_second, ms_to_timestamp, weekday
from rondo.queries.base import query
from rondo.sources.views import staging_events


def _timed(spark: SparkSession, sf: str) -> DataFrame:
    events = staging_events(spark, sf, ["event_id", "ts"])
    return events.withColumn("start_time", ms_to_timestamp("ts"))


@query("epoch_ms_to_ts", "SELECT event_id, make_timestamp_ms(ts) AS start_time FROM staging_events")
def epoch_ms_to_ts(spark: SparkSession, sf: str) -> DataFrame:
    return _timed(spark, sf).select("event_id", "start_time")


@query(
    "epoch_s_to_ts",
    "SELECT event_id, make_timestamp_ms((ts // 1000) * 1000) AS start_time FROM staging_events",
)
def epoch_s_to_ts(spark: SparkSession, sf: str) -> DataFrame:
    return _timed(spark, sf).select("event_id", ms_to_second("ts").alias("start_time"))


@query("udf_timestamp", "SELECT event_id, ts, make_timestamp_ms(ts) AS start_time FROM staging_events")
def udf_timestamp(spark: SparkSession, sf: str) -> DataFrame:
    """What a row-at-a-time conversion function would give, as a built-in expression."""
    return _timed(spark, sf)


def _part(name: str, part: Callable[[Column], Column], sql: str) -> None:
    column = name.split("_", 1)[0] if name.startswith("weekday") else name.split("_", 1)[1]

    @query(
        name,
        f"""SELECT event_id, {sql} AS {column}
            FROM (SELECT event_id, make_timestamp_ms(ts) AS t FROM staging_events)""",
    )
    def run(spark: SparkSession, sf: str) -> DataFrame:
        return _timed(spark, sf).select("event_id", part(F.col("start_time")).alias(column))


_part("part_hour", F.hour, "CAST(hour(t) AS INTEGER)")
_part("part_day", F.dayofmonth, "CAST(day(t) AS INTEGER)")
_part("part_week", F.weekofyear, "CAST(week(t) AS INTEGER)")
_part("part_month", F.month, "CAST(month(t) AS INTEGER)")
_part("part_year", F.year, "CAST(year(t) AS INTEGER)")
_part("weekday_full", lambda t: weekday(t, "full"), "dayname(t)")
_part("weekday_short", lambda t: weekday(t, "short"), "strftime(t, '%a')")
_part("weekday_padded", lambda t: weekday(t, "padded"), "rpad(dayname(t), 9, ' ')")
_part("weekday_number", lambda t: weekday(t, "number"), "CAST(dayofweek(t) AS INTEGER)")

from __future__ import annotations

from datetime import datetime, timedelta
from decimal import Decimal

from pyspark.sql import functions as F

from rondo.functions.clean import blank_to_null, count_rejects, to_double, to_int, to_whole_decimal, truncate_text
from rondo.functions.keys import concat_text, natural_key, session_second_key
from rondo.functions.timeparts import (
    calendar_parts,
    date_path,
    minute_number,
    ms_to_second,
    ms_to_timestamp,
    timestamp_to_ms,
    weekday,
)

EPOCH = datetime(1970, 1, 1)


def moments(spark, *stamps):
    text = ", ".join(f"(timestamp_ntz'{s}')" for s in stamps)
    return spark.sql(f"SELECT * FROM VALUES {text} AS t(at)")


def test_blank_text_becomes_null_and_other_text_is_not_trimmed(spark):
    df = spark.createDataFrame([("",), ("  ",), (None,), (" a ",)], "t string")
    assert [r.t for r in blank_to_null(df).collect()] == [None, None, None, " a "]


def test_long_text_is_cut_by_characters(spark):
    df = spark.createDataFrame([("é" * 300,), ("short",), (None,)], "t string")
    assert [r.t for r in truncate_text(df).collect()] == ["é" * 256, "short", None]


def test_bad_numbers_are_null_and_counted(spark):
    df = spark.createDataFrame([("",), ("abc",), ("1.54111E+12",), ("42",)], "t string")
    assert [r[0] for r in df.select(to_int("t")).collect()] == [None, None, None, 42]
    assert [r[0] for r in df.select(to_double("t")).collect()] == [None, None, 1.54111e12, 42.0]
    assert count_rejects(df, {"t": to_int("t")}).first().t_rejects == 2


def test_whole_decimal_cuts_towards_zero(spark):
    df = spark.createDataFrame([(12.7,), (-12.7,), (0.4,), (None,)], "x double")
    got = [r[0] for r in df.select(to_whole_decimal("x")).collect()]
    assert got == [Decimal(12), Decimal(-12), Decimal(0), None]


def test_milliseconds_are_kept_or_cut(spark):
    df = spark.createDataFrame([(0,), (1541105830999,)], "ts long")
    got = df.select(ms_to_timestamp("ts"), ms_to_second("ts")).collect()
    assert tuple(got[0]) == (EPOCH, EPOCH)
    assert tuple(got[1]) == (datetime(2018, 11, 1, 20, 57, 10, 999000), datetime(2018, 11, 1, 20, 57, 10))


def test_clock_times_skipped_by_summer_time_are_kept(spark):
    stamps = ["2024-03-10 01:59:59.999999", "2024-03-10 02:30:00.123456", "2024-03-10 03:10:00", "1969-12-31 23:59:59.5"]
    df = moments(spark, *stamps).withColumn("ms", timestamp_to_ms("at")).withColumn("minute", minute_number("at"))
    for row in df.collect():
        since = row["at"] - EPOCH
        assert row.ms == since // timedelta(milliseconds=1)
        assert row.minute == since // timedelta(minutes=1)
    back = df.select(ms_to_timestamp("ms").alias("t"), session_second_key(F.lit(7), ms_to_second("ms")).alias("k"))
    assert back.collect()[1].t == datetime(2024, 3, 10, 2, 30, 0, 123000)
    import hashlib

    assert back.collect()[1].k == hashlib.md5(b"72024-03-10 02:30:00").hexdigest()


def test_calendar_edges(spark):
    df = moments(spark, "2018-12-31 23:00:00", "2018-12-30 00:00:00", "2021-01-03 12:00:00")
    got = [tuple(r) for r in df.select(*calendar_parts(F.col("at"))).collect()]
    assert got == [
        (23, 31, 1, 12, 2018, "Monday"),
        (0, 30, 52, 12, 2018, "Sunday"),
        (12, 3, 53, 1, 2021, "Sunday"),
    ]
    styles = df.select(*[weekday(F.col("at"), s) for s in ("short", "padded", "number")]).collect()
    assert [tuple(r) for r in styles] == [("Mon", "Monday   ", 1), ("Sun", "Sunday   ", 0), ("Sun", "Sunday   ", 0)]
    assert df.select(date_path(F.col("at"))).first()[0] == "2018/12/31"


def test_keys(spark):
    df = spark.createDataFrame([("a", None), (None, "a"), ("a", "b")], "x string, y string")
    joined = [r[0] for r in df.select(concat_text(F.col("x"), F.col("y"))).collect()]
    assert joined == [None, None, "ab"]
    keys = [r[0] for r in df.select(natural_key(F.col("x"), F.col("y"))).collect()]
    assert len(set(keys)) == 3

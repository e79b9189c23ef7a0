"""Reading and shuffling little: lookups by value, pruned months, repeated keys by bits, numbers across loads."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from rondo.operators.published import Parts, Published
from rondo.operators.quality import check_unique_key
from rondo.operators.sinks import write_lookup, write_partitioned, write_plain
from rondo.operators.unique import crowded_words, repeated_keys
from rondo.plans import star
from rondo.sources.files import read_partitioned


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def scanned(df, metric="numOutputRows"):
    """The rows a plan's only scan gave after its filters on row groups and pages."""
    executed = df._jdf.queryExecution().executedPlan()
    df._jdf.queryExecution().toRdd().count()
    return executed.collectLeaves().apply(0).metrics().apply(metric).value()


def test_an_absent_value_reads_no_row_group(spark, tmp_path):
    # Even numbers only: an odd one lies within the value range of a row group and is in none.
    titles = spark.range(0, 400_000, 2).select(F.format_string("title %08d", "id").alias("title"), F.col("id"))
    write_lookup(titles, str(tmp_path / "lookup"), ["title"], ["id"])
    write_plain(titles.coalesce(1).sortWithinPartitions("title"), str(tmp_path / "plain"))

    def rows_read(folder, title):
        return scanned(spark.read.parquet(str(tmp_path / folder)).where(F.col("title") == title))

    assert rows_read("plain", "title 00200001") > 0
    assert rows_read("lookup", "title 00200001") == 0
    assert 0 < rows_read("lookup", "title 00200000") <= 4000
    found = spark.read.parquet(str(tmp_path / "lookup")).where("title = 'title 00200000'")
    assert [tuple(r) for r in found.collect()] == [("title 00200000", 200_000)]


def test_lookups_share_one_stored_table(spark):
    from rondo.queries import QUERIES

    files = [QUERIES["q_listeners_of_song"](spark, "/root/testdata/sf0.001").inputFiles() for _ in range(2)]
    assert files[0] and files[0] == files[1]


@pytest.fixture(scope="module")
def by_month(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("months"))
    start = F.timestamp_add("HOUR", F.col("id") * 5, F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")).alias("start_time")
    plays = spark.range(1700).select("id", start)
    months = {"year": F.year("start_time"), "month": F.month("start_time")}
    write_partitioned(plays.withColumns(months), f"{root}/songplays", ["year", "month"])
    write_plain(star.time_from_songplays(plays, distinct=True, weekday_style="full"), f"{root}/time")
    return read_partitioned(spark, f"{root}/songplays"), spark.read.parquet(f"{root}/time"), plays


def test_months_without_a_moment_are_not_read(by_month, rows):
    stored, time, plays = by_month
    found = star.plays_at(stored, time, "week = 20 AND hour < 6")
    want = plays.where("weekofyear(start_time) = 20 AND hour(start_time) < 6")
    assert rows(found, "id") == rows(want, "id") and found.count() > 0
    assert "dynamicpruning" in plan(found)
    assert star.plays_at(stored, time, "hour > 99").count() == 0


def test_repeated_keys_equal_the_plain_check(spark, rows):
    draw = random.Random(2)
    pairs = [(draw.choice([None, "a", "b" * 500]), draw.randrange(700)) for _ in range(1500)]
    df = spark.createDataFrame(pairs, "s string, n int")
    for key in (["s", "n"], ["n"], ["s"]):
        assert rows(repeated_keys(df, key)) == rows(check_unique_key(df, key))
    assert repeated_keys(df.limit(0), ["n"]).count() == 0
    hot = spark.range(5000).selectExpr("IF(id < 2000, -1, id) AS k")
    assert rows(repeated_keys(hot, ["k"])) == [(-1, 2000)]


def test_a_table_without_repeats_shuffles_bits_only(spark):
    df = spark.range(20_000).select(F.repeat(F.col("id").cast("string"), 50).alias("wide"))
    words = crowded_words(df, F.xxhash64("wide"), 15)
    exchanged = [line for line in plan(words).splitlines() if "Exchange" in line]
    assert len(exchanged) == 1 and "hashpartitioning(_word" in exchanged[0] and "wide" not in exchanged[0]
    # Hardly a row is left for the second pass.
    crowded = {r[0] for r in words.collect()}
    left = df.where(F.shiftrightunsigned(F.xxhash64("wide"), 64 - 15).isin(crowded)).count() if crowded else 0
    assert left < 500 and repeated_keys(df, ["wide"]).count() == 0


def test_numbers_go_on_from_load_to_load(spark, tmp_path, rows):
    shape = StructType.fromDDL("id long, v int, at timestamp_ntz")
    store = Published(spark, str(tmp_path / "n"), {"t": (shape, Parts(("at",)))})

    def load(values, publish=True):
        own = store.begin()
        day = F.expr("timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(v % 2)")
        own.append_numbered("t", spark.createDataFrame([(v,) for v in values], "v int").withColumn("at", day), ["v"], "id")
        if publish:
            own.publish()

    load([5, 3, 4])
    load([9, 8], publish=False)  # dies before it is published
    load([2, 1])
    load([])
    load([7])
    assert rows(store.read("t"), "id", "v") == [(0, 3), (1, 4), (2, 5), (3, 1), (4, 2), (5, 7)]

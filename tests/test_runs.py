"""Checks, the batch run and the incremental run."""

from __future__ import annotations

import json
from datetime import date

import pytest
from pyspark.sql import functions as F

from rondo.operators.layout import create_namespace, drop_namespace
from rondo.operators.quality import (
    check_foreign_key,
    check_not_null,
    check_row_counts,
    check_unique_key,
    require,
    require_non_empty,
)
from rondo.plans import star
from rondo.plans.pipeline import apply_to_all, run_keyed, run_pipeline
from rondo.schemas import FOREIGN_KEYS, PRIMARY_KEYS, STAR
from rondo.session import scratch_path, scratch_root
from rondo.streaming.incremental import IncrementalLoad


def test_null_unique_and_orphan_reports(spark, rows):
    df = spark.createDataFrame([(1, "a"), (1, None), (None, "b"), (9, "b")], "k int, v string")
    assert rows(check_not_null(df, "t", ["k", "v"])) == [("t", "k", 1), ("t", "v", 1)]
    assert rows(check_unique_key(df, ["k"])) == [(1, 2)]
    parent = spark.createDataFrame([(1,), (2,)], "id int")
    assert rows(check_foreign_key(df, "k", parent, "id")) == [(9, 1)]


def test_empty_table_is_an_error(spark, rows):
    full, empty = spark.range(3), spark.range(0)
    assert rows(check_row_counts({"full": full, "empty": empty})) == [("empty", 0, False), ("full", 3, True)]
    with pytest.raises(ValueError, match="empty"):
        require_non_empty({"full": full, "empty": empty})
    with pytest.raises(ValueError, match="nulls"):
        require(check_not_null(spark.sql("SELECT null AS a"), "t", ["a"]), F.col("null_rows") > 0, "nulls")


def test_steps_apply_in_order(spark):
    df = apply_to_all(spark.range(3), lambda d: d.filter("id > 0"), lambda d: d.selectExpr("id * 2 AS x"))
    assert [r.x for r in df.collect()] == [2, 4]


def event(i, **changes):
    base = dict(
        event_id=i, artist="Ann", song="Sun", length=200.5, page="NextSong", ts=1_541_105_830_000 + 1000 * i,
        userId=str(i % 3), firstName="Bo", lastName="Li", gender="F", level="free", sessionId=i % 3,
        itemInSession=i, location="Rome", userAgent="x",
    )
    return {**base, **changes}


def deliver(folder, name, events):
    folder.mkdir(exist_ok=True)
    (folder / f"{name}.json").write_text("".join(json.dumps(e) + "\n" for e in events))


SONG_ROW = dict(
    song_id="SO1", title="Sun", artist_id="AR1", artist_name="Ann", duration=200.5, year=0, num_songs=1,
    artist_location="",
)


def test_batch_run_fills_and_checks_every_table(spark, tmp_path, rows):
    deliver(tmp_path / "log", "a", [event(i) for i in range(9)] + [event(99, page="Home")])
    deliver(tmp_path / "songs", "s", [SONG_ROW, SONG_ROW])
    create_namespace(spark, "run", str(tmp_path / "db"))
    for expected_plays in (18, 36):  # the fact table is appended to, dimensions are reloaded
        report = run_pipeline(spark, str(tmp_path / "log"), str(tmp_path / "songs"), "run", str(tmp_path / "t"))
        assert rows(report, "table_name", "n_rows") == [
            ("artists", 1), ("songplays", expected_plays), ("songs", 1), ("time", expected_plays), ("users", 3),
        ]
    tables = {name: spark.table(f"run.{name}") for name in STAR}
    for child, column, parent, key in FOREIGN_KEYS:
        assert check_foreign_key(tables[child], column, tables[parent], key).count() == 0
    for name in ("users", "songs", "artists"):
        assert check_unique_key(tables[name], PRIMARY_KEYS[name]).count() == 0
    drop_namespace(spark, "run")


def test_batch_run_fails_without_songs(spark, tmp_path):
    deliver(tmp_path / "log", "a", [event(0)])
    deliver(tmp_path / "songs", "s", [])
    create_namespace(spark, "run_empty", str(tmp_path / "db"))
    with pytest.raises(ValueError, match="empty table"):
        run_pipeline(spark, str(tmp_path / "log"), str(tmp_path / "songs"), "run_empty", str(tmp_path / "t"))
    drop_namespace(spark, "run_empty")


def test_incremental_run_equals_batch(spark, tmp_path, rows):
    first = [event(i, level="paid") for i in range(10, 20)]
    earlier = [event(i, lastName="First") for i in range(10)]
    load = IncrementalLoad(spark, str(tmp_path / "target"))
    folder = tmp_path / "in"
    deliver(folder, "a", first)
    load.run(str(folder))
    deliver(folder, "b", earlier)
    deliver(folder, "c", first[:4])  # delivered a second time
    load.run(str(folder), files_per_batch=1)
    load.run(str(folder))  # nothing new

    everything = spark.read.schema("event_id long, artist string, song string, length double, page string, ts long,"
                                   "userId string, firstName string, lastName string, gender string, level string,"
                                   "sessionId long, itemInSession long, location string, userAgent string").json(
        [str(folder / "a.json"), str(folder / "b.json")]
    )
    assert rows(load.users()) == rows(star.users_upsert(everything))
    assert {r.last_name for r in load.users().collect()} == {"First"}
    assert load.songplays().count() == 20
    assert load.songplays().select("songplay_id").distinct().count() == 20


def test_a_repeated_batch_writes_the_same(spark, tmp_path, rows):
    load = IncrementalLoad(spark, str(tmp_path / "target"))
    from rondo.schemas import LOG_WITH_ID

    def batch(numbers, **changes):
        deliver(tmp_path / "b", "x", [event(i, **changes) for i in numbers])
        return spark.createDataFrame(
            spark.read.schema(LOG_WITH_ID).json(str(tmp_path / "b" / "x.json")).collect(), LOG_WITH_ID
        )

    zero, one = batch(range(5)), batch(range(3, 9), level="paid")
    load.apply(zero, 0)
    load.apply(one, 1)
    users, plays = rows(load.users()), rows(load.songplays())
    load.apply(one, 1)
    assert rows(load.users()) == users and rows(load.songplays()) == plays
    assert load.songplays().count() == 9


def test_scratch_comes_from_the_session(spark):
    assert scratch_root(spark) == spark.conf.get("spark.checkpoint.dir")
    assert scratch_path(spark, "x") != scratch_path(spark, "x")


def test_keyed_runs_by_day_repeat_without_change(spark, tmp_path):
    play = dict(
        artist="Ann", auth="Logged In", firstName="Jo", gender="F", itemInSession=0, lastName="Roe", length=200.5, level="free",
        location="X", method="PUT", page="NextSong", registration=1.0, sessionId=1, song="Sun", status=200, ts=1541030400000,
        userAgent="a", userId="7", event_id=1,
    )
    song = dict(num_songs=1, artist_id="AR1", artist_name="Ann", song_id="SO1", title="Sun", duration=200.5, year=2000)
    days = {"2018/11/01": [{}, {"userId": "8", "sessionId": 2, "event_id": 2}], "2018/11/02": [{"ts": 1541120000000, "level": "paid", "event_id": 3}]}
    for day, plays in days.items():
        folder = tmp_path / "log" / day
        folder.mkdir(parents=True)
        (folder / "a.json").write_text("\n".join(json.dumps({**play, **p}) for p in plays))
    (tmp_path / "songs").mkdir()
    (tmp_path / "songs" / "s.json").write_text(json.dumps(song))
    spark.sql("CREATE DATABASE keyed")
    seen = []
    try:
        for day in (1, 2, 1, 2, 2):
            when = date(2018, 11, day)
            report = run_keyed(spark, str(tmp_path / "log"), str(tmp_path / "songs"), "keyed", str(tmp_path / "tables"), day=when)
            assert report.where("failures > 0").count() == 0
            tables = {t: sorted(map(str, spark.table(f"keyed.{t}").collect())) for t in ("songplays", "songs", "artists", "time")}
            seen.append(tables)
        assert len(seen[0]["songplays"]) == 2 and len(seen[1]["songplays"]) == 3
        assert seen[1] == seen[2] == seen[3] == seen[4]
        assert spark.table("keyed.users").count() == 2
    finally:
        spark.sql("DROP DATABASE keyed CASCADE")

"""Nothing is lost without a word: readers, staging, keyed loads, the incremental load."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from rondo.functions.clean import count_cut
from rondo.functions.keys import natural_key
from rondo.operators import published
from rondo.plans import star
from rondo.plans.pipeline import run_lake
from rondo.schemas import LOG, LOG_WITH_ID, SONG
from rondo.sources import files
from rondo.streaming.incremental import IncrementalLoad

SONG_TITLE = StructType().add("song_id", StringType()).add("title", StringType())

PLAY = dict(
    artist="Ann", auth="Logged In", firstName="Jo", gender="F", itemInSession=0, lastName="Roe", length=200.5, level="free",
    location="X", method="PUT", page="NextSong", registration=1.0, sessionId=1, song="Sun", status=200, ts=1541100000000,
    userAgent="a", userId="7", event_id=1,
)
SONG_ROW = dict(num_songs=1, artist_id="AR1", artist_latitude=None, artist_longitude=None, artist_location="", artist_name="Ann",
                song_id="SO1", title="Sun", duration=200.5, year=2000)


def deliver(folder, name, *plays):
    folder.mkdir(exist_ok=True)
    lines = [p if isinstance(p, str) else json.dumps({**PLAY, **p}) for p in plays]
    (folder / f"{name}.json").write_text("\n".join(lines))


def test_readers_stop_at_broken_json(spark, tmp_path):
    deliver(tmp_path / "log", "a", {}, '{"artist": ')
    for read in (files.read_log, lambda s, p: files.read_tree(s, p, LOG), lambda s, p: files.stage(s, p, LOG)):
        with pytest.raises(Exception, match="(?i)malformed"):
            read(spark, str(tmp_path / "log")).collect()
    lenient = files.read_log(spark, str(tmp_path / "log"), options={"mode": "PERMISSIVE"})
    assert lenient.count() == 2


def test_csv_is_bound_by_name(spark, tmp_path):
    (tmp_path / "a").mkdir()
    (tmp_path / "a" / "x.csv").write_text("title,song_id\nSun,SO1\n")
    rows = files.read_csv(spark, str(tmp_path / "a"), SONG_TITLE).collect()
    assert [(r.song_id, r.title) for r in rows] == [("SO1", "Sun")]
    staged = files.stage(spark, str(tmp_path / "a"), SONG_TITLE, fmt="csv").collect()
    assert [(r.song_id, r.title) for r in staged] == [("SO1", "Sun")]
    (tmp_path / "b").mkdir()
    (tmp_path / "b" / "x.csv").write_text("title,id\nSun,SO1\n")
    with pytest.raises(ValueError, match="header"):
        files.read_csv(spark, str(tmp_path / "b"), SONG_TITLE)
    (tmp_path / "a" / "y.csv").write_text("song_id,title\nSO2,Moon\n")
    with pytest.raises(Exception):  # noqa: B017  one of the two files differs from the header taken
        files.read_csv(spark, str(tmp_path / "a"), SONG_TITLE).collect()


def test_text_is_kept_whole_unless_asked(spark, tmp_path):
    long = "x" * 300
    (tmp_path / "s.json").write_text("\n".join(json.dumps({**SONG_ROW, "song_id": long + c, "title": long}) for c in "ab"))
    whole = files.stage(spark, str(tmp_path), SONG)
    assert whole.select("song_id").distinct().count() == 2
    cut = files.stage(spark, str(tmp_path), SONG, cut={"title": 256})
    assert {(len(r.song_id), len(r.title)) for r in cut.collect()} == {(301, 256)}
    assert tuple(count_cut(whole, {"title": 256, "artist_name": 256}).first()) == (2, 0)


def test_ids_of_different_parts_differ(spark):
    df = spark.createDataFrame([("a|b", "c"), ("a", "b|c"), ("a\\", "b|c"), ("a", None), ("a", "\\N"), (None, "a")], "x string, y string")
    ids = [r.k for r in df.select(natural_key(F.col("x"), F.col("y")).alias("k")).collect()]
    assert len(set(ids)) == len(ids)


def test_a_play_logged_twice_is_kept_once_on_request(spark):
    rows = [tuple({**PLAY, **c}[f] for f in LOG_WITH_ID.names) for c in ({}, {"event_id": 2, "level": "paid"}, {"sessionId": 2})]
    events = spark.createDataFrame(rows, LOG_WITH_ID)
    songs = spark.createDataFrame([tuple(SONG_ROW[f] for f in SONG.names)], SONG)
    assert star.songplays_lookup(events, songs).count() == 3
    kept = star.songplays_lookup(events, songs, keep_first=["event_id"])
    assert sorted((r.session_id, r.level) for r in kept.collect()) == [(1, "free"), (2, "free")]


def loaded(spark, tmp_path, *deliveries):
    load = IncrementalLoad(spark, str(tmp_path / "out"))
    for n, plays in enumerate(deliveries):
        deliver(tmp_path / "log", f"d{n}", *plays)
        load.run(str(tmp_path / "log"))
    return load


def test_rejects_are_kept_and_counted(spark, tmp_path):
    load = loaded(spark, tmp_path, [{}, '{"artist": ', {"ts": None, "event_id": 3}], [{"ts": None, "event_id": 3}])
    assert load.songplays().count() == 1
    assert sorted(r._reason for r in load.rejects().collect()) == ["malformed line", "no time of play", "no time of play"]


def test_a_lost_users_state_stops_the_load(spark, tmp_path):
    load = loaded(spark, tmp_path, [{"userId": str(u), "event_id": u} for u in range(3)])
    assert load.users().count() == 3
    moved = tmp_path / "out" / "users"
    moved.rename(tmp_path / "elsewhere")
    deliver(tmp_path / "log", "later", {"userId": "9", "event_id": 9})
    with pytest.raises(Exception, match="restore"):
        load.run(str(tmp_path / "log"))


def test_restarted_numbers_over_stored_tables_stop_the_load(spark, tmp_path):
    load = loaded(spark, tmp_path, [{}], [{"event_id": 2, "itemInSession": 1}])
    (tmp_path / "out" / "_progress").rename(tmp_path / "progress")
    with pytest.raises(Exception, match="restore"):
        load.run(str(tmp_path / "log"))


def test_lake_checks_its_targets_first_and_can_be_rerun(spark, tmp_path):
    deliver(tmp_path / "log", "a", {}, {"song": "Moon", "event_id": 2})
    (tmp_path / "songs").mkdir()
    (tmp_path / "songs" / "s.json").write_text("\n".join(json.dumps({**SONG_ROW, **c}) for c in ({}, {"song_id": "SO2", "artist_id": "AR2", "artist_name": "Bob"})))
    where = str(tmp_path / "log"), str(tmp_path / "songs"), str(tmp_path / "lake")
    paths = run_lake(spark, *where)
    assert spark.read.parquet(paths["songplays"]).count() == 2
    with pytest.raises(FileExistsError):
        run_lake(spark, *where)
    run_lake(spark, *where, mode="overwrite", match="artist")
    assert spark.read.parquet(paths["songplays"]).count() == 1


def written(folder, before=()):
    return sum(f.stat().st_size for f in folder.rglob("*.parquet") if f not in before)


def test_a_small_batch_writes_little_whatever_is_stored(spark, tmp_path):
    sizes = []
    for name, stored in (("few", 50), ("many", 5000)):
        load = IncrementalLoad(spark, str(tmp_path / name))
        log = tmp_path / f"{name}-log"
        deliver(log, "first", *[{"userId": str(u), "event_id": u, "sessionId": u} for u in range(stored)])
        load.run(str(log))
        out = tmp_path / name
        before = set(out.rglob("*.parquet"))
        deliver(log, "second", {"userId": "3", "level": "paid", "event_id": 10_000, "ts": PLAY["ts"] + 86_400_000})
        load.run(str(log))
        sizes.append(sum(written(out / t, before) for t in ("users", "songplays")))
        assert load.users().count() == stored and load.users().where("level = 'paid'").count() == 1
    assert sizes[1] < 1.1 * sizes[0]


def test_late_plays_are_loaded_and_counted(spark, tmp_path):
    day = 86_400_000
    load = loaded(spark, tmp_path, [{}], [{"event_id": 2, "ts": PLAY["ts"] - 3 * day}, {"event_id": 3, "ts": PLAY["ts"] - day // 2}])
    assert load.songplays().count() == 3 and load.late() == 1


def test_states_are_folded_and_stay_the_same(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(published, "MOST_FOLDERS", 2)
    levels = ["free", "paid", "free", "paid"]
    load = loaded(spark, tmp_path, *[[{"event_id": n, "itemInSession": n, "ts": PLAY["ts"] + n, "level": x}] for n, x in enumerate(levels)])
    stored = load.store.manifest()["tables"]["users"]
    assert [len(f) for f in stored.values()] == [2] and load.users().collect()[0].level == "paid"
    assert load.store.read("users").count() == 2


def test_rejects_of_a_repeated_batch_are_stored_once(spark, tmp_path):
    load = loaded(spark, tmp_path, ['{"artist": ', {"ts": None, "event_id": 3}])
    batch = spark.read.schema(load.schema).json(str(tmp_path / "log"), mode="PERMISSIVE", columnNameOfCorruptRecord="_corrupt_record")
    load.apply(batch, 0)
    assert load.rejects().count() == 2 and load.store.manifest()["version"] == 2

from __future__ import annotations

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from rondo.plans import star
from rondo.schemas import LOG_WITH_ID, SONG, STAR

BASE = dict(
    artist="Ann", auth="Logged In", firstName="Bo", gender="F", itemInSession=0, lastName="Li", length=200.5,
    level="free", location="Rome", method="PUT", page="NextSong", registration=1.0, sessionId=7, song="Sun",
    status=200, ts=1_541_105_830_999, userAgent="agent", userId="5",
)


def log(spark, *changes):
    data = [{**BASE, "event_id": i, "itemInSession": i, **c} for i, c in enumerate(changes)]
    return spark.createDataFrame([tuple(d[f] for f in LOG_WITH_ID.names) for d in data], LOG_WITH_ID)


def catalogue(spark, *changes):
    base = dict(
        artist_id="AR1", artist_latitude=None, artist_location="", artist_longitude=None, artist_name="Ann",
        duration=200.5, num_songs=1, song_id="SO1", title="Sun", year=0,
    )
    data = [{**base, **c} for c in changes]
    return spark.createDataFrame([tuple(d[f] for f in SONG.names) for d in data], SONG)


@pytest.fixture(params=[False, True], ids=["broadcast", "salted"])
def skew(request):
    return {"salt": True, "rows": 1 / 256} if request.param else {}


def test_left_join_multiplies_and_lookup_does_not(spark, rows, skew):
    events = log(spark, {}, {"song": "Moon"}, {"page": "Home", "song": None}, {"userId": ""})
    songs = catalogue(spark, {"song_id": "SO2"}, {}, {"song_id": "SO3", "duration": 9.0})
    left = star.songplays_left_md5(events, songs, **skew)
    assert rows(left, "user_id", "song_id") == [
        (5, "SO1"), (5, "SO2"), (5, None), (None, "SO1"), (None, "SO2"),
    ]
    assert {r.start_time for r in left.collect()} == {datetime(2018, 11, 1, 20, 57, 10)}
    assert left.select("songplay_id").distinct().count() == 1
    looked = star.songplays_lookup(events, songs, **skew)
    assert rows(looked, "user_id", "song_id") == [(5, "SO1"), (5, None), (None, "SO1")]
    assert looked.select("songplay_id").distinct().count() == 3
    assert looked.schema.names == STAR["songplays"].names


def test_lookup_needs_the_stored_artist_name(spark, rows, skew):
    songs = catalogue(spark, {"artist_name": "Ann", "song_id": "SO9"}, {"artist_name": "Aaron"})
    found = star.songplays_lookup(log(spark, {}, {"artist": "Aaron"}), songs, **skew)
    assert rows(found, "song_id") == [("SO1",), (None,)]


def test_whole_second_lengths(spark, rows):
    songs = catalogue(spark, {"duration": 200.1})
    assert rows(star.songplays_left_md5(log(spark, {}), songs), "song_id") == [(None,)]
    assert rows(star.songplays_left_md5(log(spark, {}), songs, whole_seconds=True), "song_id") == [("SO1",)]


def test_inner_joins_give_distinct_rows(spark, rows, skew):
    events = log(spark, {}, {}, {"artist": "Other"}, {"song": "Moon"})
    songs = catalogue(spark, {}, {}, {"song_id": "SO2", "duration": 1.0})
    assert rows(star.songplays_inner(events, songs, **skew), "song_id") == [("SO1",), ("SO2",)]
    titled = star.songplays_title_join(events, songs, **skew)
    assert rows(titled, "song_id", "year", "month") == [("SO1", 2018, 11), ("SO2", 2018, 11)]
    assert titled.select("songplay_id").distinct().count() == 2


def test_day_grain(spark):
    got = star.songplays_lookup(log(spark, {}), catalogue(spark, {}), grain="day").first()
    assert got.start_time == date(2018, 11, 1)


def test_users_variants(spark, rows):
    events = log(
        spark,
        {"level": "paid", "ts": 50, "lastName": "New"},
        {"level": "free", "ts": 10},
        {"userId": "", "firstName": None},
        {"userId": "6", "page": "Home"},
    )
    assert rows(star.users_upsert(events)) == [(5, "Bo", "Li", "F", "paid")]
    assert star.users_distinct(events).count() == 2
    assert star.users_distinct(events, drop_blank=False).count() == 3


def test_song_and_artist_variants(spark, rows):
    songs = catalogue(
        spark, {}, {}, {"song_id": "SO2", "artist_location": "Rome"}, {"song_id": None}, {"song_id": "SO1", "year": 3}
    )
    assert rows(star.songs_dim(songs), "song_id", "year") == [("SO1", 0), ("SO2", 0)]
    assert star.songs_distinct(songs).count() == 3
    assert star.songs_distinct(songs, drop_null=False).count() == 4
    generated = star.songs_generated_id(songs)
    assert generated.count() == 2
    assert rows(generated) == rows(star.songs_generated_id(songs.repartition(5)))
    assert star.songs_generated_id(songs, stable=False).select("song_id").distinct().count() == 2
    assert rows(star.artists_dim(songs), "artist_id", "location") == [("AR1", "")]
    assert star.artists_distinct(songs).count() == 2


def test_time_variants(spark, rows):
    morning, later, next_day = 1_541_030_400_000, 1_541_030_400_700, 1_541_116_800_000
    events = log(spark, {"ts": later}, {"ts": morning}, {"ts": morning}, {"ts": next_day}, {"ts": 5, "page": "Home"})
    assert star.time_nextsong(events).count() == 3
    assert rows(star.time_nextsong(events, grain="day"), "start_time", "weekday") == [
        (date(2018, 11, 1), "Thursday"), (date(2018, 11, 2), "Friday"),
    ]
    whole = star.time_all_events(events)
    assert whole.count() == 3 and {len(r.weekday) for r in whole.collect()} == {9}
    plays = star.songplays_left_md5(events, catalogue(spark, {}))
    assert star.time_from_songplays(plays).count() == 4
    assert rows(star.time_from_songplays(plays, distinct=True), "weekday") == [(4,), (5,)]


def test_joining_time_equals_deriving_it(spark, rows):
    events = log(spark, {}, {"ts": 1}, {"ts": 1_600_000_000_000})
    plays = star.songplays_title_join(events, catalogue(spark, {}))
    joined = star.join_time(plays.drop("year", "month"), star.time_nextsong(events))
    assert rows(joined) == rows(plays)


def test_builders_do_not_depend_on_partitioning(spark, rows):
    events = log(spark, *[{"ts": 1000 * (i % 5), "userId": str(i % 3), "level": "ab"[i % 2]} for i in range(40)])
    songs = catalogue(spark, *[{"song_id": f"SO{i % 4}", "year": i} for i in range(12)])
    for n in (1, 13):
        e, s = events.repartition(n), songs.repartition(n)
        assert rows(star.users_upsert(e)) == rows(star.users_upsert(events))
        assert rows(star.songs_dim(s)) == rows(star.songs_dim(songs))
        assert rows(star.songplays_lookup(e, s)) == rows(star.songplays_lookup(events, songs))


def test_matches_are_distinct_where_ids_have_several_titles(spark, rows, skew):
    events = log(
        spark, {}, {"itemInSession": 9}, {"song": "Sun (live)"}, {"song": "Moon"}, {"song": None}, {"userId": "a|b\\", "level": None}, {"ts": None}
    )
    songs = catalogue(
        spark, {}, {"title": "Sun (live)"}, {"title": "Sun (live)", "song_id": "SO2"}, {"title": None, "song_id": "SO3"},
        {"song_id": None}, {"song_id": None, "title": "Moon"}, {"title": "Moon", "artist_name": "Bo", "song_id": "SO4"},
    )
    for build, on in ((star.songplays_inner, (star.TITLE, star.ARTIST)), (star.songplays_title_join, (star.TITLE,))):
        plain = star.match_catalogue(star.next_song(events), songs, on, "inner").select(*star._LOGGED, *star.IDS).distinct()
        key = star.natural_key(*[F.col(c) for c in [*star._LOGGED[:3], *star.IDS, *star._LOGGED[3:]]])
        want = plain.select(*star._play_columns(star.ms_to_timestamp("ts"), key))
        got = build(events, songs, **skew)
        assert got.columns[:9] == STAR["songplays"].names
        assert rows(got, *want.columns) == rows(want)


def test_nothing_is_shuffled_after_the_rows_are_multiplied(spark):
    """A title of 200 plays and 300 songs: the 60,000 matches go through no exchange and no aggregate."""
    events = log(spark, *[{"ts": 1_541_105_830_000 + i} for i in range(200)])
    songs = catalogue(spark, *[{"song_id": f"SO{i}", "artist_id": f"AR{i}"} for i in range(300)])
    for build in (star.songplays_inner, star.songplays_title_join):
        plays = build(events, songs)
        assert plays.count() == 60_000
        plays.collect()
        assert 0 < max(shuffled(plays)) <= 300


def test_title_plays_of_a_title_follow_each_other(spark):
    """Also where the catalogue is small: each play of a title is followed by the next one, with the title's songs in one order."""
    events = log(spark, *[{"ts": 1_541_105_830_000 + i, "song": f"T{i % 20}"} for i in range(400)])
    songs = catalogue(spark, *[{"title": f"T{i % 20}", "song_id": f"SO{i}"} for i in range(200)])
    tasks = star.songplays_title_join(events, songs).rdd.glom().map(lambda part: [int(r.song_id[2:]) for r in part]).collect()
    assert sum(map(len, tasks)) == 4000
    for ids in tasks:
        plays = [ids[i : i + 10] for i in range(0, len(ids), 10)]
        new = [play for last, play in zip([None, *plays], plays) if play != last]
        assert len(new) == len({i % 20 for i in ids}) and all(len({i % 20 for i in play}) == 1 for play in new)


def shuffled(df):
    """Rows written by each shuffle of a frame's last run."""
    found, todo = [], [df._jdf.queryExecution().executedPlan()]
    while todo:
        plan = todo.pop()
        if plan.getClass().getSimpleName() == "AdaptiveSparkPlanExec":
            todo.append(plan.executedPlan())
        elif plan.getClass().getSimpleName().endswith("QueryStageExec"):
            todo.append(plan.plan())
        elif plan.getClass().getSimpleName() == "ShuffleExchangeExec":
            found.append(plan.metrics().apply("shuffleRecordsWritten").value())
        kids = plan.children()
        todo += [kids.apply(i) for i in range(kids.size())]
    return found


def test_title_plays_are_written_where_they_are_made(spark, rows, tmp_path, monkeypatch):
    december = 1_543_700_000_000
    titles = ["Sun", "Moon", "Sun (live)", "Rain"]
    events = log(
        spark, *[{"ts": ts + i, "song": titles[i % 4]} for ts in (1_541_105_830_000, december) for i in range(200)], {"ts": None}, {"ts": None, "song": "Moon"}
    )
    songs = catalogue(spark, *[{"title": titles[i % 4], "song_id": f"SO{i}"} for i in range(400)], {"song_id": "SO4", "title": "Moon"}, {"title": None})
    placed, write = [], star.write_in_place
    monkeypatch.setattr(star, "write_in_place", lambda df, *rest: (placed.append(df), write(df, *rest)))
    path = str(tmp_path / "plays")
    star.write_title_plays(events, songs, path)
    want = star.songplays_title_join(events, songs)
    assert sorted(spark.read.parquet(path).columns) == sorted(want.columns)
    assert rows(spark.read.parquet(path), *want.columns) == rows(want)
    assert placed[0].count() > 39_000
    tasks = placed[0].rdd.glom().map(lambda part: [(r.year, r.month) for r in part]).collect()
    assert all(t == sorted(t) for t in tasks) and any(len(set(t)) == 2 for t in tasks)
    placed[0].collect()
    assert 0 < max(shuffled(placed[0])) <= 1000

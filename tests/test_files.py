from __future__ import annotations

from datetime import date

import pytest
from pyspark.sql import functions as F

from rondo.operators.layout import cluster_rows, create_namespace, create_tables, drop_namespace, drop_tables
from rondo.operators.sinks import append_rows, load_rows, reload_rows, write_csv, write_in_place, write_partitioned, write_plain
from rondo.plans.query_tables import (
    events_denormalised,
    listeners_of_song,
    music_log,
    session_songs,
    song_in_session,
    user_session_playlist,
    user_songs,
)
from rondo.schemas import EVENT_CSV, LOG, SONG, STAR
from rondo.sources import files

HEADER = ",".join(EVENT_CSV.names)


def line(artist, first, item, session, song, user, ts="1.54E+12", last="Li", length="200.5"):
    return f"{artist},Logged In,{first},F,{item},{last},{length},free,\"Rome, IT\",PUT,NextSong,1.5E+12,{session},{song},200,{ts},{user}"


@pytest.fixture
def event_csv(tmp_path):
    (tmp_path / "day1").mkdir()
    (tmp_path / "day2").mkdir()
    (tmp_path / "day1" / "a.csv").write_text(
        "\n".join(
            [
                HEADER,
                line("Ann", "Bo", 4, 338, '"The ""Best"", really"', 10),
                line("Änn", "Bo", 5, 338, "Sun", 10),
                ",Logged Out,,,0,,,free,,PUT,Login,,339,,307,1.54E+12,",
            ]
        )
        + "\n",
        encoding="utf8",
    )
    (tmp_path / "day2" / "b.csv").write_text(
        "\n".join([HEADER, line("Ann", "Cy", 0, 400, "Sun", 11), line("Ann", "Bo", 1, 401, "Sun", 10, last="New")])
        + "\n",
        encoding="utf8",
    )
    return str(tmp_path)


def test_event_csv_to_question_tables(spark, rows, event_csv, tmp_path_factory):
    raw = files.read_event_csv(spark, event_csv)
    assert raw.count() == 5
    kept = events_denormalised(raw)
    assert kept.count() == 4
    path = str(tmp_path_factory.mktemp("out") / "csv")
    write_csv(kept, path)
    back = files.read_denormalised(spark, path)
    assert rows(back) == rows(kept)
    ordered = back.withColumns({"s": F.col("sessionId"), "i": F.col("itemInSession")})
    sessions, users, listeners = (f(ordered, ["s", "i"]) for f in (session_songs, user_songs, music_log))
    assert rows(song_in_session(sessions, 338, 4)) == [("Ann", 'The "Best", really', 200.5)]
    assert [tuple(r) for r in user_session_playlist(users, 10, 338).collect()] == [
        (4, "Ann", 'The "Best", really', "Bo", "Li"), (5, "Änn", "Sun", "Bo", "Li"),
    ]
    assert rows(listeners_of_song(listeners, "Sun")) == [("Bo", "New"), ("Cy", "Li")]


def test_quoted_fields_everywhere(spark, tmp_path):
    one = spark.createDataFrame([(1, None, 'a "b"')], "n int, e string, t string").coalesce(1)
    write_csv(one, str(tmp_path / "q"))
    text = next((tmp_path / "q").glob("part-*")).read_text()
    assert text.splitlines() == ['"n","e","t"', '"1","","a ""b"""']


def test_a_line_break_in_a_field_stops_the_read_unless_allowed(spark, tmp_path):
    (tmp_path / "x.csv").write_text('a,b\n1,"two\nlines"\n2,z\n')
    schema = "a string, b string"
    with pytest.raises(Exception, match="(?i)malformed"):
        files.read_csv(spark, str(tmp_path), schema).collect()
    assert files.read_csv(spark, str(tmp_path), schema, multi_line=True).count() == 2


@pytest.fixture
def log_tree(tmp_path):
    for day, name in (("2018/11/01", "a"), ("2018/11/02", "b"), ("2018/12/01", "c")):
        folder = tmp_path / day
        folder.mkdir(parents=True)
        (folder / f"{name}.json").write_text(
            f'{{"artist":null,"userId":" ","song":"{name}","page":"Home","ts":1541105830796}}\n'
        )
        (folder / "notes.txt").write_text("not a record")
    return str(tmp_path)


def test_json_by_glob_tree_and_day(spark, rows, log_tree):
    assert rows(files.read_log(spark, log_tree + "/*/11/*/*.json"), "song") == [("a",), ("b",)]
    assert rows(files.read_tree(spark, log_tree, LOG), "song") == [("a",), ("b",), ("c",)]
    staged = files.stage(spark, log_tree, LOG, day=date(2018, 11, 2), options={"pathGlobFilter": "*.json"})
    assert rows(staged, "song", "userId") == [("b", None)]
    assert files.read_log(spark, [log_tree + "/2018/11/01/*.json", log_tree + "/2018/12/*/*.json"]).count() == 2
    assert files.read_log(spark, log_tree + "/2018/11/01/a.json", infer=True).first().ts == 1541105830796


def test_staging_stops_on_a_broken_record(spark, tmp_path):
    (tmp_path / "x.json").write_text('{"artist": "a"}\n{"artist": \n')
    with pytest.raises(Exception, match="(?i)malformed"):
        files.stage(spark, str(tmp_path), LOG).collect()
    with pytest.raises(ValueError, match="fmt"):
        files.stage(spark, str(tmp_path), LOG, fmt="xml")


def test_partitioned_write_modes(spark, rows, tmp_path):
    data = [(f"SO{i}", f"t{i}", None if i % 3 == 0 else f"AR{i % 4}", 1990 + i % 2, 1.0) for i in range(200)]
    songs = spark.createDataFrame(data, STAR["songs"])
    for tasks in (None, 5):
        path = str(tmp_path / f"songs{tasks}")
        write_partitioned(songs, path, ["year", "artist_id"], tasks=tasks)
        back = files.read_partitioned(spark, path, schema=STAR["songs"]).select(*STAR["songs"].names)
        assert rows(back) == rows(songs)
        one = files.read_partitioned(spark, path, "year=1990/*", STAR["songs"])
        assert one.select("year").distinct().collect()[0].year == 1990
    write_plain(songs, str(tmp_path / "plain"))
    with pytest.raises(Exception, match="(?i)already exists"):
        write_plain(songs, str(tmp_path / "plain"))


def test_hashes_written_in_place_take_little_more_than_their_bits(spark, tmp_path):
    """32 hex digits hold 16 bytes; numbers, nulls, empty and long texts come back as they were, by either of Spark's readers."""
    path, n = str(tmp_path / "hashes"), 200_000
    df = spark.range(n).selectExpr("md5(cast(id AS string)) AS hash", "2018 + id div 100000 AS year")
    write_in_place(df, path, ["year"])
    assert sum(f.stat().st_size for f in (tmp_path / "hashes").rglob("*.parquet")) < 17 * n
    assert spark.read.parquet(path).select("hash", "year").exceptAll(df.selectExpr("hash", "cast(year AS int)")).count() == 0
    text = "CASE WHEN id % 7 = 0 THEN NULL WHEN id % 5 = 0 THEN '' WHEN id % 999 = 1 THEN repeat(md5(cast(id AS string)), 300) ELSE md5(cast(id AS string)) END"
    odd = spark.range(n).selectExpr(
        "if(id % 3 = 0, NULL, id * 7919 - 500) AS n", "cast(hash(id) AS int) AS i", "id / 3 AS d", "id % 2 = 0 AS b",
        f"{text} AS t", "timestampadd(MILLISECOND, id * 77777, timestamp_ntz'2018-01-01 00:00:00') AS at", "if(id % 50 = 0, NULL, 1) AS part",
    )
    write_in_place(odd, str(tmp_path / "odd"), ["part"])
    want = odd.agg(F.count("*"), F.sum(F.xxhash64(*odd.columns).cast("decimal(38,0)"))).collect()
    for vectorized in ("true", "false"):
        spark.conf.set("spark.sql.parquet.enableVectorizedReader", vectorized)
        try:
            back = spark.read.parquet(str(tmp_path / "odd"))
            assert back.agg(F.count("*"), F.sum(F.xxhash64(*odd.columns).cast("decimal(38,0)"))).collect() == want
        finally:
            spark.conf.unset("spark.sql.parquet.enableVectorizedReader")


def test_tables_by_name(spark, rows, tmp_path):
    create_namespace(spark, "t_names", str(tmp_path / "db"))
    create_tables(spark, "t_names", {"users": STAR["users"], "songs": STAR["songs"]})
    create_tables(spark, "t_names", {"users": STAR["users"]})
    users = spark.createDataFrame([("paid", 1, "Bo", "Li", "F")], "level string, user_id int, first_name string, last_name string, gender string")
    append_rows(users, "t_names.users")
    load_rows(users, "t_names.users")
    assert rows(spark.table("t_names.users")) == [(1, "Bo", "Li", "F", "paid")] * 2
    reload_rows(users, "t_names.users")
    load_rows(users, "t_names.users", delete_load=True)
    assert files.read_table(spark, "t_names.users").count() == 1
    drop_tables(spark, "t_names", ["songs"])
    assert [t.name for t in spark.catalog.listTables("t_names")] == ["users"]
    drop_namespace(spark, "t_names")
    assert not spark.catalog.databaseExists("t_names")


def test_clustered_rows_keep_a_hot_key_in_several_tasks(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = spark.range(4000).selectExpr("if(id % 3 < 2, 1, id) AS k", "id AS i")
        placed = cluster_rows(df, ["k"], ["i"]).withColumn("p", F.spark_partition_id())
        by_task = placed.groupBy("p").agg(F.min(F.struct("k", "i")).alias("lo"), F.max(F.struct("k", "i")).alias("hi"))
        bounds = sorted((tuple(r.lo), tuple(r.hi)) for r in by_task.collect())
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sum(low[0] == 1 for low, _ in bounds) > 1
    assert all(a[1] < b[0] for a, b in zip(bounds, bounds[1:]))


def test_songs_read_with_their_own_id(spark, tmp_path):
    (tmp_path / "s.json").write_text('{"song_id":"SO1","title":"Sun","year":0,"duration":1.5,"num_songs":1}')
    assert files.read_songs(spark, str(tmp_path)).first().song_id == "SO1"
    staged = files.stage(spark, str(tmp_path), SONG, fields={"id": "song_id", "name": "title"})
    assert tuple(staged.first()) == ("SO1", "Sun")

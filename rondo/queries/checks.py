"""Data-quality checks, loads, the batch run and the incremental run."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rondo.operators.layout import create_namespace, drop_namespace
from rondo.operators.quality import WriteChecks, check_foreign_key, check_not_null, check_row_counts, check_unique_key
from rondo.operators.unique import repeated_keys as find_repeated
from rondo.plans import star
from rondo.plans.pipeline import keyed_store, load_dimension, load_fact, run_keyed, run_lake, run_pipeline
from rondo.queries.base import query
from rondo.queries.columns import LOOKUP_SQL
from rondo.queries.sinks import NOT_BLANK, SONGS_SQL, STAR_COUNTS_SQL, _database, _read_and_drop
from rondo.queries.tables import (
    LEFT_MD5_SQL,
    PLAY,
    SONGPLAYS_LOOKUP_SQL,
    USER,
    USERS_DISTINCT_SQL,
    USERS_SQL,
    distinct_join,
)
from rondo.schemas import LOG, NOT_NULL, TABLE_ORDER
from rondo.session import scratch_path
from rondo.sources.files import read_partitioned
from rondo.sources.views import staging_events, staging_songs
from rondo.streaming.incremental import IncrementalLoad

PLAIN_PLAY = [c for c in PLAY if c != "itemInSession"]


@query(
    "check_not_null",
    "".join(
        f"""{'UNION ALL ' if i else ''}SELECT 'artists' AS table_name, '{shown}' AS column_name,
        count(*) FILTER (WHERE {source} IS NULL) AS null_rows FROM staging_songs """
        for i, (shown, source) in enumerate(
            [("artist_id", "artist_id"), ("name", "artist_name"), ("latitude", "artist_latitude")]
        )
    )
    + "".join(
        f"""UNION ALL SELECT 'songplays', '{shown}', count(*) FILTER (WHERE {source} IS NULL)
        FROM staging_events WHERE page = 'NextSong' """
        for shown, source in [("start_time", "ts"), ("user_id", "TRY_CAST(\"userId\" AS INTEGER)")]
    ),
)
def null_counts(spark: SparkSession, sf: str) -> DataFrame:
    songs = staging_songs(spark, sf).select(
        "artist_id", F.col("artist_name").alias("name"), F.col("artist_latitude").alias("latitude")
    )
    plays = star.next_song(staging_events(spark, sf, ["page", "ts", "userId"])).select(
        F.col("ts").alias("start_time"), F.expr("try_cast(userId AS INT)").alias("user_id")
    )
    return check_not_null(songs, "artists", [*NOT_NULL["artists"], "latitude"]).unionByName(
        check_not_null(plays, "songplays", ["start_time", "user_id"])
    )


@query(
    "check_unique_key",
    f"SELECT songplay_id, count(*) AS n_rows FROM ({LEFT_MD5_SQL}) GROUP BY songplay_id HAVING count(*) > 1",
)
def repeated_keys(spark: SparkSession, sf: str) -> DataFrame:
    """Play ids that two matching songs or two plays in a second repeat."""
    songplays = star.songplays_left_md5(staging_events(spark, sf, PLAIN_PLAY), staging_songs(spark, sf))
    return check_unique_key(songplays, ["songplay_id"])


@query(
    "check_unique_key_wide",
    """SELECT song, artist, "userAgent", level, count(*) AS n_rows FROM staging_events WHERE page = 'NextSong'
       GROUP BY ALL HAVING count(*) > 1""",
)
def repeated_wide_keys(spark: SparkSession, sf: str) -> DataFrame:
    """A key of four texts: only rows whose key may be repeated are shuffled with it."""
    key = ["song", "artist", "userAgent", "level"]
    return find_repeated(star.next_song(staging_events(spark, sf, ["page", *key])), key)


@query(
    "check_foreign_key",
    """SELECT song AS key, count(*) AS n_rows FROM staging_events
       WHERE page = 'NextSong' AND song NOT IN (SELECT title FROM staging_songs WHERE song_id LIKE 'SR%')
       GROUP BY song""",
)
def orphan_titles(spark: SparkSession, sf: str) -> DataFrame:
    """Played titles that were never re-released."""
    plays = star.next_song(staging_events(spark, sf, ["page", "song"]))
    again = staging_songs(spark, sf).filter(F.col("song_id").startswith("SR"))
    return check_foreign_key(plays, "song", again, "title")


@query(
    "check_foreign_key_star",
    """SELECT p.song_id AS key, count(*) AS n_rows
       FROM (SELECT l.song_id FROM staging_events e LEFT JOIN lookup l
             ON e.song = l.title AND e.artist = l.artist_name AND e.length = l.duration
             WHERE e.page = 'NextSong') p
       WHERE p.song_id IS NOT NULL AND p.song_id NOT IN (SELECT song_id FROM staging_songs WHERE year > 0)
       GROUP BY p.song_id""",
    LOOKUP_SQL,
)
def orphan_songs(spark: SparkSession, sf: str) -> DataFrame:
    """Plays whose song has no known year; plays without a song pass."""
    plays = star.next_song(staging_events(spark, sf, ["page", "song", "artist", "length"]))
    songs = staging_songs(spark, sf)
    return check_foreign_key(
        star.lookup_first_match(plays, songs), "song_id", songs.filter("year > 0"), "song_id"
    )


@query("quality_row_counts", f"SELECT table_name, n_rows, n_rows > 0 AS passed FROM ({STAR_COUNTS_SQL})")
def quality_row_counts(spark: SparkSession, sf: str) -> DataFrame:
    events, songs = staging_events(spark, sf, sorted({*PLAIN_PLAY, *USER})), staging_songs(spark, sf)
    return check_row_counts(
        {
            "songplays": star.songplays_inner(events, songs),
            "users": star.users_distinct(events),
            "songs": star.songs_distinct(songs),
            "artists": star.artists_distinct(songs),
            "time": star.time_nextsong(events),
        }
    )


def _written(spark: SparkSession, checks: list[WriteChecks]) -> list[WriteChecks]:
    """Store the tables; their checks are taken on the way."""
    for check in checks:
        check.rows.write.parquet(scratch_path(spark, check.table))
    return checks


@query("quality_row_counts_written", f"SELECT table_name, n_rows, n_rows > 0 AS passed FROM ({STAR_COUNTS_SQL})")
def quality_row_counts_written(spark: SparkSession, sf: str) -> DataFrame:
    """Row counts of the five tables, taken while they are written."""
    events, songs = staging_events(spark, sf, sorted({*PLAIN_PLAY, *USER})), staging_songs(spark, sf)
    tables = {
        "songplays": star.songplays_inner(events, songs),
        "users": star.users_distinct(events),
        "songs": star.songs_distinct(songs),
        "artists": star.artists_distinct(songs),
        "time": star.time_nextsong(events),
    }
    checks = _written(spark, [WriteChecks(df, name) for name, df in tables.items()])
    return reduce(DataFrame.unionByName, [c.counts() for c in checks])


@query(
    "check_not_null_written",
    "".join(
        f"""{'UNION ALL ' if i else ''}SELECT 'songplays' AS table_name, '{c}' AS column_name,
        count(*) FILTER (WHERE {c} IS NULL) AS null_rows FROM ({LEFT_MD5_SQL}) """
        for i, c in enumerate([*NOT_NULL["songplays"], "song_id", "artist_id"])
    ),
)
def null_counts_written(spark: SparkSession, sf: str) -> DataFrame:
    """Nulls in the fact table's columns, counted while it is written."""
    plays = star.songplays_left_md5(staging_events(spark, sf, PLAIN_PLAY), staging_songs(spark, sf))
    return _written(spark, [WriteChecks(plays, "songplays", [*NOT_NULL["songplays"], "song_id", "artist_id"])])[0].nulls()


@query("load_fact", LEFT_MD5_SQL)
def loaded_fact(spark: SparkSession, sf: str) -> DataFrame:
    namespace, location = _database(spark)
    events, songs = staging_events(spark, sf, PLAIN_PLAY), staging_songs(spark, sf)
    load_fact(lambda: star.songplays_left_md5(events, songs), f"{namespace}.songplays")
    return _read_and_drop(spark, namespace, location, "songplays")


@query("load_dimension", USERS_DISTINCT_SQL + NOT_BLANK)
def loaded_dimension(spark: SparkSession, sf: str) -> DataFrame:
    """An append followed by a load that deletes first."""
    namespace, location = _database(spark)
    events = staging_events(spark, sf, USER)
    load_dimension(lambda: star.users_distinct(events), f"{namespace}.users")
    load_dimension(lambda: star.users_distinct(events), f"{namespace}.users", delete_load=True)
    return _read_and_drop(spark, namespace, location, "users")


@query(
    "run_pipeline",
    f"""SELECT table_name, n_rows, n_rows > 0 AS passed FROM (
        SELECT 'songs' AS table_name, count(*) AS n_rows FROM ({SONGS_SQL})
        UNION ALL SELECT 'artists', count(*) FROM (SELECT DISTINCT artist_id, artist_name,
          nullif(artist_location, ''), artist_latitude, artist_longitude FROM staging_songs)
        UNION ALL SELECT 'users', count(*) FROM ({USERS_DISTINCT_SQL}{NOT_BLANK})
        UNION ALL SELECT 'time', count(*) FROM ({LEFT_MD5_SQL})
        UNION ALL SELECT 'songplays', count(*) FROM ({LEFT_MD5_SQL}))""",
)
def pipeline(spark: SparkSession, sf: str) -> DataFrame:
    """From raw JSON files to checked tables."""
    return _run(spark, sf)[0]


@query("run_pipeline_songplays", LEFT_MD5_SQL)
def pipeline_songplays(spark: SparkSession, sf: str) -> DataFrame:
    """The fact rows that the run stored."""
    return _run(spark, sf)[1]("songplays")


@query("run_pipeline_users", USERS_DISTINCT_SQL + NOT_BLANK)
def pipeline_users(spark: SparkSession, sf: str) -> DataFrame:
    """The users that the run stored."""
    return _run(spark, sf)[1]("users")


def _keyed(spark: SparkSession, sf: str) -> tuple[DataFrame, Callable[[str], DataFrame]]:
    """The tables after two keyed runs over the same files, and the last report."""
    raw, location = scratch_path(spark, "raw"), scratch_path(spark, "run")
    staging_events(spark, sf).write.json(f"{raw}/log")
    staging_songs(spark, sf).write.json(f"{raw}/songs")
    namespace = f"plays_{uuid.uuid4().hex[:12]}"
    create_namespace(spark, namespace, f"{location}/_default")
    for _ in range(2):
        report = run_keyed(spark, f"{raw}/log", f"{raw}/songs", namespace, location)
    path = scratch_path(spark, "report")
    report.write.parquet(path)
    drop_namespace(spark, namespace)
    return spark.read.parquet(path), keyed_store(spark, location).read


@query("run_keyed_songplays", SONGPLAYS_LOOKUP_SQL, LOOKUP_SQL)
def keyed_songplays(spark: SparkSession, sf: str) -> DataFrame:
    """Plays after loading the same log twice by key."""
    return _keyed(spark, sf)[1]("songplays")


@query("run_keyed_users", USERS_SQL)
def keyed_users(spark: SparkSession, sf: str) -> DataFrame:
    """Users after loading the same log twice by key."""
    return _keyed(spark, sf)[1]("users")


@query(
    "check_registry",
    """SELECT 'songplays' AS table_name, 'null user_id' AS check_name, count(*) AS failures
       FROM staging_events WHERE page = 'NextSong' AND "userId" = ''""",
)
def keyed_checks(spark: SparkSession, sf: str) -> DataFrame:
    """Of all checks of the registry after two keyed runs, those that fail: plays of logged-out listeners have no user."""
    return _keyed(spark, sf)[0].where("failures > 0")


def _run(spark: SparkSession, sf: str) -> tuple[DataFrame, Callable[[str], DataFrame]]:
    raw, location = scratch_path(spark, "raw"), scratch_path(spark, "run")
    staging_events(spark, sf).write.json(f"{raw}/log")
    staging_songs(spark, sf).write.json(f"{raw}/songs")
    namespace = f"plays_{uuid.uuid4().hex[:12]}"
    create_namespace(spark, namespace, f"{location}/_default")
    report = run_pipeline(spark, f"{raw}/log", f"{raw}/songs", namespace, location)
    schemas = {name: spark.table(f"{namespace}.{name}").schema for name in TABLE_ORDER}
    drop_namespace(spark, namespace)
    return report, lambda name: spark.read.schema(schemas[name]).parquet(f"{location}/{name}")


@query(
    "run_lake",
    f"""SELECT 'songs' AS table_name, count(*) AS n_rows FROM ({SONGS_SQL})
        UNION ALL SELECT 'artists', count(*) FROM (SELECT DISTINCT artist_id, artist_name, artist_location,
          artist_latitude, artist_longitude FROM staging_songs)
        UNION ALL SELECT 'users', count(*) FROM ({USERS_DISTINCT_SQL}{NOT_BLANK})
        UNION ALL SELECT 'time', count(DISTINCT ts) FROM staging_events WHERE page = 'NextSong'
        UNION ALL SELECT 'songplays', count(*) FROM ({distinct_join('e.song = s.title')})""",
)
def lake(spark: SparkSession, sf: str) -> DataFrame:
    """From raw JSON files to partitioned parquet folders, counted after reading back."""
    paths = _lake(spark, sf)
    return check_row_counts({name: read_partitioned(spark, path) for name, path in paths.items()}).drop("passed")


def _lake(spark: SparkSession, sf: str) -> dict[str, str]:
    raw = scratch_path(spark, "raw")
    staging_events(spark, sf, LOG.names).write.json(f"{raw}/log")
    staging_songs(spark, sf).write.json(f"{raw}/songs")
    return run_lake(spark, f"{raw}/log", f"{raw}/songs", scratch_path(spark, "lake"))


@query("run_lake_songs", f"SELECT song_id, title, artist_id, year, duration FROM ({SONGS_SQL})")
def lake_songs(spark: SparkSession, sf: str) -> DataFrame:
    """The songs folder of the run, with the partitioning it chooses."""
    return read_partitioned(spark, _lake(spark, sf)["songs"]).select("song_id", "title", "artist_id", "year", "duration")


@query("run_lake_songplays", f"SELECT * FROM ({distinct_join('e.song = s.title')})")
def lake_songplays(spark: SparkSession, sf: str) -> DataFrame:
    """The songplays folder of the run."""
    return read_partitioned(spark, _lake(spark, sf)["songplays"]).drop("year", "month")


def _streamed(spark: SparkSession, sf: str, songs: DataFrame | None = None) -> IncrementalLoad:
    """The log in two deliveries: even days first, then the whole log, so earlier plays come late and some twice."""
    root = scratch_path(spark, "arriving")
    load = IncrementalLoad(spark, scratch_path(spark, "loaded"), songs)
    events = staging_events(spark, sf)
    events.filter("level = 'paid'").write.json(f"{root}/first")
    load.run(f"{root}/*")
    events.write.json(f"{root}/everything")
    load.run(f"{root}/*")
    return load


@query("incremental_load", USERS_SQL)
def incremental_users(spark: SparkSession, sf: str) -> DataFrame:
    """The users table after two incremental runs equals the batch table."""
    return _streamed(spark, sf).users()


@query("incremental_load_rejects", """SELECT CAST(ts AS BIGINT) AS ts, event_id, reason FROM (
       SELECT NULL AS ts, event_id, 'no time of play' AS reason FROM staging_events
       WHERE page = 'NextSong' AND event_id % 50 = 0
       UNION ALL SELECT NULL, NULL, 'malformed line' FROM staging_events WHERE event_id % 100 = 1)""")
def incremental_rejects(spark: SparkSession, sf: str) -> DataFrame:
    """Plays without a time and broken lines of a delivery, kept with their reasons."""
    root = scratch_path(spark, "arriving")
    events = staging_events(spark, sf)
    untimed = (F.col("page") == "NextSong") & (F.col("event_id") % 50 == 0)
    events.withColumn("ts", F.when(~untimed, F.col("ts"))).write.json(f"{root}/log")
    broken = events.where("event_id % 100 = 1").select(F.concat(F.lit('{"ts": '), F.col("event_id").cast("string")))
    broken.write.text(f"{root}/broken")
    load = IncrementalLoad(spark, scratch_path(spark, "loaded"))
    load.run(f"{root}/*")
    return load.rejects().select("ts", "event_id", F.col("_reason").alias("reason"))


@query("incremental_load_songplays", SONGPLAYS_LOOKUP_SQL, LOOKUP_SQL)
def incremental_songplays(spark: SparkSession, sf: str) -> DataFrame:
    """The fact table after two incremental runs equals the batch table."""
    return _streamed(spark, sf, staging_songs(spark, sf)).songplays()

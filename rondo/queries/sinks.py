"""Sinks and stored tables. Each query writes to a fresh place and returns what is read back."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rondo.operators.joins import hot_keys
from rondo.operators.layout import (
    cluster_rows,
    co_located_join,
    create_namespace,
    create_tables,
    drop_namespace,
    drop_tables,
    write_bucketed,
)
from rondo.operators.quality import check_row_counts
from rondo.operators.sinks import append_rows, load_rows, reload_rows, write_partitioned, write_plain
from rondo.plans import star
from rondo.plans.query_tables import events_denormalised, user_songs
from rondo.queries.base import query
from rondo.queries.scans import denormalised_as_csv
from rondo.queries.tables import LEFT_MD5_SQL, PLAY, QUESTION_SQL, USER, USERS_DISTINCT_SQL, distinct_join
from rondo.schemas import STAR, TABLE_ORDER
from rondo.session import scratch_path, shuffle_tasks
from rondo.sources.files import read_denormalised, read_partitioned, read_table
from rondo.sources.views import staging_events, staging_songs

NOT_BLANK = " AND nullif(\"userId\", '') IS NOT NULL"
SONGS_SQL = "SELECT DISTINCT song_id, title, artist_id, year, duration FROM staging_songs"


@query(
    "sink_parquet_partitioned",
    distinct_join(
        "e.song = s.title",
        """, CAST(year(make_timestamp_ms(ts)) AS INTEGER) AS year,
             CAST(month(make_timestamp_ms(ts)) AS INTEGER) AS month""",
    ),
)
def sink_parquet_partitioned(spark: SparkSession, sf: str) -> DataFrame:
    """The fact table by year and month."""
    path = scratch_path(spark, "songplays")
    events = staging_events(spark, sf, [c for c in PLAY if c != "itemInSession"])
    star.write_title_plays(events, staging_songs(spark, sf), path)
    return read_partitioned(spark, path)


@query("sink_songs_partitioned", SONGS_SQL)
def sink_songs_partitioned(spark: SparkSession, sf: str) -> DataFrame:
    """Songs by year and artist."""
    path = scratch_path(spark, "songs")
    write_partitioned(star.songs_distinct(staging_songs(spark, sf)), path, ["year", "artist_id"], tasks=shuffle_tasks(spark))
    return read_partitioned(spark, path).select(*STAR["songs"].names)


@query("sink_parquet_plain", USERS_DISTINCT_SQL + NOT_BLANK)
def sink_parquet_plain(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "users")
    write_plain(star.users_distinct(staging_events(spark, sf, USER)), path)
    return read_table(spark, path)


@query(
    "sink_csv_quote_all",
    """SELECT artist, "firstName", gender, CAST("itemInSession" AS INTEGER) AS "itemInSession", "lastName", length,
              level, location, CAST("sessionId" AS INTEGER) AS "sessionId", song,
              TRY_CAST("userId" AS INTEGER) AS "userId"
       FROM staging_events WHERE artist <> ''""",
)
def sink_csv_quote_all(spark: SparkSession, sf: str) -> DataFrame:
    return read_denormalised(spark, denormalised_as_csv(spark, sf))


def _database(spark: SparkSession, tables: dict | None = None) -> tuple[str, str]:
    """A namespace of its own with empty external tables: dropping it leaves the files."""
    name, location = f"plays_{uuid.uuid4().hex[:12]}", scratch_path(spark, "database")
    create_namespace(spark, name, f"{location}/_default")
    create_tables(spark, name, tables, location)
    return name, location


def _read_and_drop(spark: SparkSession, namespace: str, location: str, table: str) -> DataFrame:
    """The files of an external table, after its entry is gone from the catalogue."""
    schema = spark.table(f"{namespace}.{table}").schema
    drop_namespace(spark, namespace)
    return spark.read.schema(schema).parquet(f"{location}/{table}")


@query("insert_select_append", f"{USERS_DISTINCT_SQL}{NOT_BLANK} UNION ALL ({USERS_DISTINCT_SQL}{NOT_BLANK})")
def insert_select_append(spark: SparkSession, sf: str) -> DataFrame:
    """Two inserts of the same rows: an append keeps both. Column order is put right by name."""
    namespace, location = _database(spark)
    rows = star.users_distinct(staging_events(spark, sf, USER))
    shuffled = rows.select("level", "user_id", "gender", "first_name", "last_name")
    append_rows(rows, f"{namespace}.users")
    append_rows(shuffled, f"{namespace}.users")
    return _read_and_drop(spark, namespace, location, "users")


@query("reload_table", f"{SONGS_SQL}")
def reload_table(spark: SparkSession, sf: str) -> DataFrame:
    """Two reloads of the same rows leave them once."""
    namespace, location = _database(spark)
    rows = star.songs_distinct(staging_songs(spark, sf))
    reload_rows(rows, f"{namespace}.songs")
    reload_rows(rows, f"{namespace}.songs")
    return _read_and_drop(spark, namespace, location, "songs")


@query("append_table", f"{SONGS_SQL} UNION ALL ({SONGS_SQL})")
def append_table(spark: SparkSession, sf: str) -> DataFrame:
    """The dimension load's default adds to what is there."""
    namespace, location = _database(spark)
    rows = star.songs_distinct(staging_songs(spark, sf))
    load_rows(rows, f"{namespace}.songs")
    load_rows(rows, f"{namespace}.songs")
    return _read_and_drop(spark, namespace, location, "songs")


STAR_COUNTS_SQL = f"""
  SELECT 'songs' AS table_name, count(*) AS n_rows FROM ({SONGS_SQL})
  UNION ALL SELECT 'artists', count(*) FROM (SELECT DISTINCT artist_id, artist_name, artist_location,
    artist_latitude, artist_longitude FROM staging_songs)
  UNION ALL SELECT 'users', count(*) FROM ({USERS_DISTINCT_SQL}{NOT_BLANK})
  UNION ALL SELECT 'time', count(DISTINCT ts) FROM staging_events WHERE page = 'NextSong'
  UNION ALL SELECT 'songplays', count(*) FROM ({distinct_join('e.song = s.title AND e.artist = s.artist_name')})"""


def _load_star(spark: SparkSession, sf: str, namespace: str) -> None:
    events, songs = staging_events(spark, sf, sorted({*PLAY, *USER} - {"itemInSession"})), staging_songs(spark, sf)
    builds = {
        "users": star.users_distinct(events),
        "artists": star.artists_distinct(songs),
        "songs": star.songs_distinct(songs),
        "time": star.time_nextsong(events),
        "songplays": star.songplays_inner(events, songs),
    }
    for name, rows in builds.items():
        append_rows(rows, f"{namespace}.{name}")


@query("create_tables", f"SELECT table_name, n_rows, n_rows > 0 AS passed FROM ({STAR_COUNTS_SQL})")
def created_tables(spark: SparkSession, sf: str) -> DataFrame:
    """All five tables created from the registry and filled, with their row counts."""
    namespace, _ = _database(spark)
    _load_star(spark, sf, namespace)
    counts = check_row_counts({name: spark.table(f"{namespace}.{name}") for name in TABLE_ORDER})
    drop_namespace(spark, namespace)
    return counts


@query(
    "drop_tables",
    f"""SELECT table_name, n_rows, table_name IN ('users', 'artists') AS still_there FROM ({STAR_COUNTS_SQL})""",
)
def dropped_tables(spark: SparkSession, sf: str) -> DataFrame:
    """Row counts of the five tables, and which are still in the catalogue after three are dropped."""
    namespace, _ = _database(spark)
    _load_star(spark, sf, namespace)
    counts = check_row_counts({name: spark.table(f"{namespace}.{name}") for name in TABLE_ORDER})
    drop_tables(spark, namespace, ["songplays", "time", "songs"])
    left = [t.name for t in spark.catalog.listTables(namespace)]
    drop_namespace(spark, namespace)
    return counts.select("table_name", "n_rows", F.col("table_name").isin(left).alias("still_there"))


@query("create_namespace", SONGS_SQL)
def created_namespace(spark: SparkSession, sf: str) -> DataFrame:
    """A table made and filled under the current namespace is found by its qualified name."""
    before = spark.catalog.currentDatabase()
    namespace, location = _database(spark, {"songs": STAR["songs"]})
    create_namespace(spark, namespace, use=True)
    try:
        append_rows(star.songs_distinct(staging_songs(spark, sf)), "songs")
    finally:
        spark.sql(f"USE `{before}`")
    return _read_and_drop(spark, namespace, location, "songs")


@query("cluster_layout", "SELECT * FROM user_songs", QUESTION_SQL)
def cluster_layout(spark: SparkSession, sf: str) -> DataFrame:
    """The playlist table stored by its partition and clustering keys."""
    path = scratch_path(spark, "user-songs")
    rows = user_songs(events_denormalised(staging_events(spark, sf), "ts", "event_id"))
    write_plain(cluster_rows(rows, ["userid", "sessionid"], ["itemInSession"]), path)
    return read_table(spark, path)



#: Buckets of the co-located tables: as many tasks join them.
BUCKETS = 16
#: Plays of one song or moment beyond which its rows are spread.
PLAYS_PER_KEY = 100_000


def _bucketed(spark: SparkSession, name: str, table: str, df: DataFrame, key: str, hot: DataFrame | None = None) -> DataFrame:
    """A table of a namespace, stored in buckets of one column."""
    write_bucketed(df, f"{name}.{table}", [key], BUCKETS, [key], scratch_path(spark, "buckets"), hot)
    return spark.table(f"{name}.{table}")


def _joined(spark: SparkSession, plays: DataFrame, other: Callable[[DataFrame], DataFrame], key: str, how: str) -> DataFrame:
    """Plays joined with a dimension, both stored in buckets of the key; the result is stored before the tables go.

    Plays are built twice: for the list of hot keys, which is stored, and for their table, from which ``other`` makes the dimension.
    """
    write_plain(hot_keys(plays, [key], PLAYS_PER_KEY, nulls=True), listed := scratch_path(spark, "hot"))
    hot = read_table(spark, listed)
    name = f"plays_{uuid.uuid4().hex[:12]}"
    create_namespace(spark, name, scratch_path(spark, "database"))
    stored = _bucketed(spark, name, "songplays", plays, key, hot)
    dimension = _bucketed(spark, name, "dimension", other(stored), f"_{key}")
    joined = co_located_join(stored, dimension, [(key, f"_{key}")], how, hot.na.drop(), right_unique=True)
    path = scratch_path(spark, "joined")
    write_plain(joined.drop(f"_{key}"), path)
    drop_namespace(spark, name)
    return read_table(spark, path)


@query("cluster_bucketed_songs", f"SELECT p.*, title, duration FROM ({LEFT_MD5_SQL}) p LEFT JOIN ({SONGS_SQL}) s ON s.song_id = p.song_id")
def cluster_bucketed_songs(spark: SparkSession, sf: str) -> DataFrame:
    """Plays and songs stored in buckets of the song, joined where they lie; plays of no known song stay."""
    plays = star.songplays_left_md5(staging_events(spark, sf, [c for c in PLAY if c != "itemInSession"]), staging_songs(spark, sf))
    songs = star.songs_distinct(staging_songs(spark, sf)).selectExpr("song_id AS _song_id", "title", "duration")
    return _joined(spark, plays, lambda stored: songs, "song_id", "left")


@query(
    "cluster_bucketed_time",
    f"""SELECT p.*, CAST(hour(start_time) AS INTEGER) AS hour, CAST(weekofyear(start_time) AS INTEGER) AS week,
               strftime(start_time, '%A') AS weekday
        FROM ({LEFT_MD5_SQL}) p""",
)
def cluster_bucketed_time(spark: SparkSession, sf: str) -> DataFrame:
    """Plays and the calendar stored in buckets of the start time, joined where they lie."""
    plays = star.songplays_left_md5(staging_events(spark, sf, [c for c in PLAY if c != "itemInSession"]), staging_songs(spark, sf))

    def calendar(stored: DataFrame) -> DataFrame:
        time = star.time_from_songplays(stored, distinct=True, weekday_style="full")
        return time.selectExpr("start_time AS _start_time", "hour", "week", "weekday")

    return _joined(spark, plays, calendar, "start_time", "inner")

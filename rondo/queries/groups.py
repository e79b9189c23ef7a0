"""Distinct, counts, per-key reduction, sort, limit and keyed loads."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rondo.operators.quality import count_rows
from rondo.operators.reduce import distinct_rows, first_per_key, last_per_key
from rondo.operators.upsert import upsert_ignore, upsert_last_write, upsert_update
from rondo.plans.query_tables import events_denormalised, user_songs
from rondo.plans.star import ARTIST, TITLE, distinct_matches, next_song
from rondo.queries.base import query
from rondo.sources.views import staging_events, staging_songs

ORDER = ["ts", "event_id"]


@query(
    "distinct_rows",
    """SELECT DISTINCT "userId", "firstName", "lastName", gender, level FROM staging_events
       WHERE page = 'NextSong'""",
)
def distinct_users(spark: SparkSession, sf: str) -> DataFrame:
    columns = ["userId", "firstName", "lastName", "gender", "level"]
    return distinct_rows(next_song(staging_events(spark, sf, ["page", *columns])), columns)


@query(
    "distinct_after_join",
    """SELECT DISTINCT e.ts, e."userId", e.level, s.song_id, s.artist_id, e."sessionId"
       FROM staging_events e JOIN staging_songs s
       ON e.song = s.title AND e.artist = s.artist_name AND e.page = 'NextSong'""",
)
def distinct_after_join(spark: SparkSession, sf: str) -> DataFrame:
    kept = ["ts", "userId", "level", "sessionId"]
    plays = next_song(staging_events(spark, sf, [*kept, "page", "song", "artist"]))
    return distinct_matches(plays.drop("page"), staging_songs(spark, sf), (TITLE, ARTIST))


@query("count_rows", "SELECT count(*) AS n_rows FROM staging_events")
def count_events(spark: SparkSession, sf: str) -> DataFrame:
    return count_rows(staging_events(spark, sf, ["event_id"]))


PER_SESSION = ["sessionId", "event_id", "page", "song", "level", "ts"]


@query(
    "first_per_key",
    """SELECT "sessionId", event_id, page, song, level, ts FROM staging_events
       QUALIFY row_number() OVER (PARTITION BY "sessionId" ORDER BY ts, event_id) = 1""",
)
def first_of_session(spark: SparkSession, sf: str) -> DataFrame:
    return first_per_key(staging_events(spark, sf, PER_SESSION), ["sessionId"], ORDER)


@query(
    "last_per_key",
    """SELECT "sessionId", event_id, page, song, level, ts FROM staging_events
       QUALIFY row_number() OVER (PARTITION BY "sessionId" ORDER BY ts DESC, event_id DESC) = 1""",
)
def last_of_session(spark: SparkSession, sf: str) -> DataFrame:
    return last_per_key(staging_events(spark, sf, PER_SESSION), ["sessionId"], ORDER)


@query(
    "sort_by_clustering_key",
    """SELECT TRY_CAST("userId" AS INTEGER) AS userid, CAST("sessionId" AS INTEGER) AS sessionid,
              CAST("itemInSession" AS INTEGER) AS "itemInSession", artist, song AS song_title,
              length AS song_length, "firstName" AS first_name, "lastName" AS last_name
       FROM staging_events WHERE artist <> '' ORDER BY userid, sessionid, "itemInSession" """,
)
def sort_by_clustering_key(spark: SparkSession, sf: str) -> DataFrame:
    rows = events_denormalised(staging_events(spark, sf), *ORDER)
    return user_songs(rows).orderBy("userid", "sessionid", "itemInSession")


@query(
    "limit_rows",
    """SELECT event_id, ts, page, "userId" FROM staging_events ORDER BY ts DESC, event_id DESC LIMIT 5""",
)
def limit_rows(spark: SparkSession, sf: str) -> DataFrame:
    """The five latest events; sort and limit together make a top-k plan with no full sort."""
    events = staging_events(spark, sf, ["event_id", "ts", "page", "userId"])
    return events.orderBy(F.desc("ts"), F.desc("event_id")).limit(5)


# Keyed loads: plays of the free level are the stored table, plays of the paid level the new rows.
STORED_SQL = """
played AS (SELECT * FROM staging_events WHERE page = 'NextSong'),
stored AS (SELECT "userId", song, level, ts, event_id FROM played WHERE level = 'free'
  QUALIFY row_number() OVER (PARTITION BY "userId" ORDER BY ts, event_id) = 1),
fresh_first AS (SELECT "userId", song, level, ts, event_id FROM played WHERE level = 'paid'
  QUALIFY row_number() OVER (PARTITION BY "userId" ORDER BY ts, event_id) = 1),
fresh_last AS (SELECT "userId", song, level, ts, event_id FROM played WHERE level = 'paid'
  QUALIFY row_number() OVER (PARTITION BY "userId" ORDER BY ts DESC, event_id DESC) = 1)"""

LOADED = ["userId", "song", "level", "ts", "event_id"]


def _stored_and_new(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    plays = next_song(staging_events(spark, sf, [*LOADED, "page"])).select(*LOADED)
    stored = first_per_key(plays.filter("level = 'free'"), ["userId"], ORDER)
    return stored, plays.filter("level = 'paid'")


@query(
    "upsert_ignore",
    """SELECT * FROM stored
       UNION ALL SELECT * FROM fresh_first f WHERE f."userId" NOT IN (SELECT "userId" FROM stored)""",
    STORED_SQL,
)
def keep_first(spark: SparkSession, sf: str) -> DataFrame:
    stored, new = _stored_and_new(spark, sf)
    return upsert_ignore(new, ["userId"], ORDER, stored)


@query(
    "upsert_update_column",
    """SELECT coalesce(s."userId", f."userId") AS "userId", coalesce(s.song, f.song) AS song,
              coalesce(l.level, s.level) AS level
       FROM stored s FULL JOIN fresh_first f ON s."userId" = f."userId"
       LEFT JOIN fresh_last l ON l."userId" = f."userId" """,
    STORED_SQL,
)
def update_column(spark: SparkSession, sf: str) -> DataFrame:
    """New keys bring their first song; every seen key takes the last new level."""
    stored, new = _stored_and_new(spark, sf)
    return upsert_update(new, ["userId"], ORDER, ["level"], stored.drop(*ORDER))


@query(
    "upsert_last_write",
    """SELECT * FROM fresh_last
       UNION ALL SELECT * FROM stored s WHERE s."userId" NOT IN (SELECT "userId" FROM fresh_last)""",
    STORED_SQL,
)
def last_write(spark: SparkSession, sf: str) -> DataFrame:
    stored, new = _stored_and_new(spark, sf)
    return upsert_last_write(new, ["userId"], ORDER, stored)


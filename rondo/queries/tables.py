"""Star-schema tables in all their variants, and the three question tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from rondo.operators.numbering import identity_ids
from rondo.operators.quality import unique_ids
from rondo.operators.sinks import write_lookup
from rondo.plans import query_tables, star
from rondo.queries.base import query
from rondo.queries.columns import LOOKUP_SQL
from rondo.session import scratch_path
from rondo.sources.files import read_table
from rondo.sources.views import staging_events, staging_songs

PLAY = [
    "event_id", "page", "ts", "userId", "level", "song", "artist", "length", "sessionId", "itemInSession",
    "location", "userAgent",
]
USER = ["page", "userId", "firstName", "lastName", "gender", "level"]

KEY_COLUMNS = "ts, userId, level, song_id, artist_id, sessionId, location, userAgent".split(", ")
ESCAPED = "coalesce(replace(replace({}::VARCHAR, '\\', '\\\\'), '|', '\\|'), '\\N')"
ROW_KEY = "md5(concat_ws('|', " + ", ".join(ESCAPED.format(f'"{c}"') for c in KEY_COLUMNS) + "))"


def _plays(spark: SparkSession, sf: str, numbered: bool = False) -> DataFrame:
    columns = PLAY if numbered else [c for c in PLAY if c != "itemInSession"]
    return staging_events(spark, sf, columns)


SONGPLAYS_LOOKUP_SQL = """SELECT md5(concat_ws('|', e."sessionId"::VARCHAR, e."itemInSession"::VARCHAR, e.ts::VARCHAR)) AS songplay_id,
              make_timestamp_ms(e.ts) AS start_time, TRY_CAST(e."userId" AS INTEGER) AS user_id, e.level,
              l.song_id, l.artist_id, e."sessionId" AS session_id, e.location, e."userAgent" AS user_agent
       FROM staging_events e LEFT JOIN lookup l
       ON e.song = l.title AND e.artist = l.artist_name AND e.length = l.duration
       WHERE e.page = 'NextSong'"""


@query("songplays_lookup", SONGPLAYS_LOOKUP_SQL, LOOKUP_SQL)
def songplays_lookup(spark: SparkSession, sf: str) -> DataFrame:
    return star.songplays_lookup(_plays(spark, sf, numbered=True), staging_songs(spark, sf))


@query("songplays_lookup_repeats", SONGPLAYS_LOOKUP_SQL, LOOKUP_SQL)
def songplays_lookup_repeats(spark: SparkSession, sf: str) -> DataFrame:
    """A log delivered twice gives each play once."""
    events = staging_events(spark, sf, sorted({*PLAY, "event_id"}))
    return star.songplays_lookup(events.unionByName(events), staging_songs(spark, sf), keep_first=["event_id"])


@query(
    "songplays_lookup_day",
    """SELECT md5(concat_ws('|', e."sessionId"::VARCHAR, e."itemInSession"::VARCHAR, e.ts::VARCHAR)) AS songplay_id,
              CAST(make_timestamp_ms(e.ts) AS DATE) AS start_time,
              TRY_CAST(e."userId" AS INTEGER) AS user_id, e.level,
              l.song_id, l.artist_id, e."sessionId" AS session_id, e.location, e."userAgent" AS user_agent
       FROM staging_events e LEFT JOIN lookup l
       ON e.song = l.title AND e.artist = l.artist_name AND e.length = l.duration
       WHERE e.page = 'NextSong'""",
    LOOKUP_SQL,
)
def songplays_lookup_day(spark: SparkSession, sf: str) -> DataFrame:
    """Start time kept as a date."""
    return star.songplays_lookup(_plays(spark, sf, numbered=True), staging_songs(spark, sf), grain="day")


def distinct_join(condition: str, more: str = "") -> str:
    return f"""SELECT {ROW_KEY} AS songplay_id, make_timestamp_ms(ts) AS start_time,
              TRY_CAST("userId" AS INTEGER) AS user_id, level, song_id, artist_id, "sessionId" AS session_id,
              location, "userAgent" AS user_agent{more}
       FROM (SELECT DISTINCT e.ts, e."userId", e.level, s.song_id, s.artist_id, e."sessionId", e.location,
                    e."userAgent"
             FROM staging_events e JOIN staging_songs s ON {condition} AND e.page = 'NextSong')"""


@query("songplays_inner", distinct_join("e.song = s.title AND e.artist = s.artist_name"))
def songplays_inner(spark: SparkSession, sf: str) -> DataFrame:
    return star.songplays_inner(_plays(spark, sf), staging_songs(spark, sf))


@query(
    "songplays_inner_identity",
    """SELECT row_number() OVER (ORDER BY start_time, session_id, song_id, user_id, level, artist_id, location,
                user_agent) - 1 AS songplay_id, * EXCLUDE (songplay_id)
       FROM ("""
    + distinct_join("e.song = s.title AND e.artist = s.artist_name")
    + ") t",
)
def songplays_inner_identity(spark: SparkSession, sf: str) -> DataFrame:
    """The same rows numbered from zero."""
    rows = star.songplays_inner(_plays(spark, sf), staging_songs(spark, sf)).drop("songplay_id")
    order = ["start_time", "session_id", "song_id", "user_id", "level", "artist_id", "location", "user_agent"]
    return identity_ids(rows, order, "songplay_id")


@query(
    "songplays_title_join",
    distinct_join(
        "e.song = s.title",
        """, CAST(year(make_timestamp_ms(ts)) AS INTEGER) AS year,
             CAST(month(make_timestamp_ms(ts)) AS INTEGER) AS month""",
    ),
)
def songplays_title_join(spark: SparkSession, sf: str) -> DataFrame:
    return star.songplays_title_join(_plays(spark, sf), staging_songs(spark, sf))


LEFT_MD5_SQL = """SELECT md5(concat(CAST(e."sessionId" AS VARCHAR), strftime(e.start_time, '%Y-%m-%d %H:%M:%S')))
                AS songplay_id, e.start_time, TRY_CAST(e."userId" AS INTEGER) AS user_id, e.level, s.song_id,
              s.artist_id, e."sessionId" AS session_id, e.location, e."userAgent" AS user_agent
       FROM (SELECT make_timestamp_ms((ts // 1000) * 1000) AS start_time, * FROM staging_events
             WHERE page = 'NextSong') e
       LEFT JOIN staging_songs s
       ON e.song = s.title AND e.artist = s.artist_name AND e.length = s.duration"""


@query("songplays_left_md5", LEFT_MD5_SQL)
def songplays_left_md5(spark: SparkSession, sf: str) -> DataFrame:
    return star.songplays_left_md5(_plays(spark, sf), staging_songs(spark, sf))


USERS_SQL = """SELECT TRY_CAST("userId" AS INTEGER) AS user_id, arg_min("firstName", (ts, event_id)) AS first_name,
              arg_min("lastName", (ts, event_id)) AS last_name, arg_min(gender, (ts, event_id)) AS gender,
              arg_max(level, (ts, event_id)) AS level
       FROM staging_events WHERE page = 'NextSong' AND TRY_CAST("userId" AS INTEGER) IS NOT NULL
       GROUP BY ALL"""


@query("users_upsert", USERS_SQL)
def users_upsert(spark: SparkSession, sf: str) -> DataFrame:
    return star.users_upsert(staging_events(spark, sf, [*USER, "ts", "event_id"]))


USERS_DISTINCT_SQL = """SELECT DISTINCT TRY_CAST("userId" AS INTEGER) AS user_id, "firstName" AS first_name,
              "lastName" AS last_name, gender, level
       FROM staging_events WHERE page = 'NextSong'"""


@query("users_distinct", USERS_DISTINCT_SQL + " AND nullif(\"userId\", '') IS NOT NULL")
def users_distinct(spark: SparkSession, sf: str) -> DataFrame:
    return star.users_distinct(staging_events(spark, sf, USER))


@query("users_distinct_keep_blank", USERS_DISTINCT_SQL)
def users_distinct_keep_blank(spark: SparkSession, sf: str) -> DataFrame:
    """Plays of logged-out users count as rows without an id."""
    return star.users_distinct(staging_events(spark, sf, USER), drop_blank=False)


@query("songs_dim", "SELECT * FROM known AS k", """known AS (
  SELECT song_id, title, artist_id, year, duration FROM staging_songs WHERE song_id IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY song_id ORDER BY title, artist_id, year, duration) = 1)""")
def songs_dim(spark: SparkSession, sf: str) -> DataFrame:
    return star.songs_dim(staging_songs(spark, sf))


@query(
    "songs_distinct",
    "SELECT DISTINCT song_id, title, artist_id, year, duration FROM staging_songs WHERE song_id IS NOT NULL",
)
def songs_distinct(spark: SparkSession, sf: str) -> DataFrame:
    return star.songs_distinct(staging_songs(spark, sf))


@query(
    "songs_generated_id",
    """SELECT title, artist_id, year, duration,
              md5(concat_ws('|', replace(replace(title, '\\', '\\\\'), '|', '\\|'),
                             replace(replace(artist_id, '\\', '\\\\'), '|', '\\|'), year::VARCHAR, duration::VARCHAR)) AS song_id
       FROM (SELECT DISTINCT title, artist_id, year, duration FROM staging_songs)""",
)
def songs_generated_id(spark: SparkSession, sf: str) -> DataFrame:
    """Distinct songs with a hash of the row as id."""
    return star.songs_generated_id(staging_songs(spark, sf))


@query(
    "songs_generated_number",
    """SELECT title, artist_id, year, duration, true AS id_unique
       FROM (SELECT DISTINCT title, artist_id, year, duration FROM staging_songs)""",
)
def songs_generated_number(spark: SparkSession, sf: str) -> DataFrame:
    """Distinct songs with a unique but unstable number as id: what each song has, and whether its id is its own."""
    return unique_ids(star.songs_generated_id(staging_songs(spark, sf), stable=False), "song_id")


@query(
    "artists_dim",
    """SELECT artist_id, artist_name AS name, artist_location AS location, artist_latitude AS latitude,
              artist_longitude AS longitude FROM staging_songs WHERE artist_id IS NOT NULL
       QUALIFY row_number() OVER (PARTITION BY artist_id ORDER BY artist_name NULLS FIRST,
         artist_location NULLS FIRST, artist_latitude NULLS FIRST, artist_longitude NULLS FIRST) = 1""",
)
def artists_dim(spark: SparkSession, sf: str) -> DataFrame:
    return star.artists_dim(staging_songs(spark, sf))


@query(
    "artists_distinct",
    """SELECT DISTINCT artist_id, artist_name AS name, artist_location AS location, artist_latitude AS latitude,
              artist_longitude AS longitude FROM staging_songs""",
)
def artists_distinct(spark: SparkSession, sf: str) -> DataFrame:
    return star.artists_distinct(staging_songs(spark, sf))


def _parts_sql(weekday: str) -> str:
    parts = ", ".join(f"CAST({p}(start_time) AS INTEGER) AS {p}" for p in ("hour", "day", "week", "month", "year"))
    return f"start_time, {parts}, {weekday} AS weekday"


@query(
    "time_nextsong",
    f"""SELECT {_parts_sql('dayname(start_time)')} FROM
        (SELECT DISTINCT make_timestamp_ms(ts) AS start_time FROM staging_events WHERE page = 'NextSong')""",
)
def time_nextsong(spark: SparkSession, sf: str) -> DataFrame:
    return star.time_nextsong(staging_events(spark, sf, ["page", "ts"]))


@query(
    "time_nextsong_short",
    f"""SELECT {_parts_sql("strftime(start_time, '%a')")} FROM
        (SELECT DISTINCT make_timestamp_ms(ts) AS start_time FROM staging_events WHERE page = 'NextSong')""",
)
def time_nextsong_short(spark: SparkSession, sf: str) -> DataFrame:
    """The same with abbreviated weekday names."""
    return star.time_nextsong(staging_events(spark, sf, ["page", "ts"]), weekday_style="short")


@query(
    "time_nextsong_day",
    f"""SELECT * REPLACE (CAST(start_time AS DATE) AS start_time) FROM (
        SELECT {_parts_sql('dayname(start_time)')} FROM
        (SELECT min(make_timestamp_ms(ts)) AS start_time FROM staging_events WHERE page = 'NextSong'
         GROUP BY CAST(make_timestamp_ms(ts) AS DATE)))""",
)
def time_nextsong_day(spark: SparkSession, sf: str) -> DataFrame:
    """Keyed by date: each day's first play gives the parts."""
    return star.time_nextsong(staging_events(spark, sf, ["page", "ts"]), grain="day")


@query(
    "time_all_events",
    f"""SELECT {_parts_sql("rpad(dayname(start_time), 9, ' ')")} FROM
        (SELECT DISTINCT make_timestamp_ms((ts // 1000) * 1000) AS start_time FROM staging_events)""",
)
def time_all_events(spark: SparkSession, sf: str) -> DataFrame:
    return star.time_all_events(staging_events(spark, sf, ["ts"]))


@query(
    "time_from_songplays",
    f"""SELECT {_parts_sql('CAST(dayofweek(start_time) AS INTEGER)')} FROM ({LEFT_MD5_SQL})""",
)
def time_from_songplays(spark: SparkSession, sf: str) -> DataFrame:
    return star.time_from_songplays(star.songplays_left_md5(_plays(spark, sf), staging_songs(spark, sf)))


@query(
    "time_from_songplays_distinct",
    f"""SELECT DISTINCT {_parts_sql('CAST(dayofweek(start_time) AS INTEGER)')} FROM ({LEFT_MD5_SQL})""",
)
def time_from_songplays_distinct(spark: SparkSession, sf: str) -> DataFrame:
    songplays = star.songplays_left_md5(_plays(spark, sf), staging_songs(spark, sf))
    return star.time_from_songplays(songplays, distinct=True)


QUESTION_SQL = """session_songs AS (
  SELECT CAST("sessionId" AS INTEGER) AS "sessionId", CAST("itemInSession" AS INTEGER) AS "itemInSession", artist,
         song AS song_title, length AS song_length
  FROM staging_events WHERE artist <> ''
  QUALIFY row_number() OVER (PARTITION BY "sessionId", "itemInSession" ORDER BY ts DESC, event_id DESC) = 1),
user_songs AS (
  SELECT TRY_CAST("userId" AS INTEGER) AS userid, CAST("sessionId" AS INTEGER) AS sessionid,
         CAST("itemInSession" AS INTEGER) AS "itemInSession", artist, song AS song_title, length AS song_length,
         "firstName" AS first_name, "lastName" AS last_name
  FROM staging_events WHERE artist <> ''
  QUALIFY row_number() OVER (PARTITION BY "userId", "sessionId", "itemInSession"
                             ORDER BY ts DESC, event_id DESC) = 1),
music_log AS (
  SELECT song AS song_title, TRY_CAST("userId" AS INTEGER) AS userid, "firstName" AS first_name,
         "lastName" AS last_name
  FROM staging_events WHERE artist <> ''
  QUALIFY row_number() OVER (PARTITION BY song, TRY_CAST("userId" AS INTEGER)
                             ORDER BY ts DESC, event_id DESC) = 1)"""

ORDER = ["ts", "event_id"]


SESSION_COLUMNS = ["artist", "itemInSession", "length", "sessionId", "song"]
LISTENER_COLUMNS = ["artist", "firstName", "lastName", "song", "userId"]


def _denormalised(spark: SparkSession, sf: str, columns: list[str]) -> DataFrame:
    return query_tables.events_denormalised(staging_events(spark, sf, [*columns, *ORDER]), *ORDER)


_LAID_OUT: dict[tuple[str, str, str], str] = {}


def _laid_out(spark: SparkSession, sf: str, build: Callable[[SparkSession, str], DataFrame], by: list[str], then: list[str]) -> DataFrame:
    """The table stored for lookups by its partition key; a session stores it once and every lookup reads that."""
    key = (spark.sparkContext.applicationId, sf, build.__name__)
    if key not in _LAID_OUT:
        path = scratch_path(spark, build.__name__)
        write_lookup(build(spark, sf), path, by, then)
        _LAID_OUT[key] = path
    return read_table(spark, _LAID_OUT[key])


@query("session_songs", "SELECT * FROM session_songs", QUESTION_SQL)
def session_songs(spark: SparkSession, sf: str) -> DataFrame:
    return query_tables.session_songs(_denormalised(spark, sf, SESSION_COLUMNS))


@query("user_songs", "SELECT * FROM user_songs", QUESTION_SQL)
def user_songs(spark: SparkSession, sf: str) -> DataFrame:
    return query_tables.user_songs(_denormalised(spark, sf, sorted({*SESSION_COLUMNS, *LISTENER_COLUMNS})))


@query("music_log", "SELECT * FROM music_log", QUESTION_SQL)
def music_log(spark: SparkSession, sf: str) -> DataFrame:
    return query_tables.music_log(_denormalised(spark, sf, LISTENER_COLUMNS))


@query(
    "q_song_in_session",
    """SELECT artist, song_title, song_length FROM session_songs
       WHERE "sessionId" = 7001 AND "itemInSession" = 0""",
    QUESTION_SQL,
)
def q_song_in_session(spark: SparkSession, sf: str) -> DataFrame:
    """Artist, title and length heard at one place of one session."""
    return query_tables.song_in_session(
        _laid_out(spark, sf, session_songs, ["sessionId"], ["itemInSession"]), 7001, 0
    )


@query(
    "q_user_session_playlist",
    """SELECT "itemInSession", artist, song_title, first_name, last_name FROM user_songs
       WHERE userid = 126 AND sessionid = 126003 ORDER BY "itemInSession" """,
    QUESTION_SQL,
)
def q_user_session_playlist(spark: SparkSession, sf: str) -> DataFrame:
    """One user's session in playing order."""
    return query_tables.user_session_playlist(
        _laid_out(spark, sf, user_songs, ["userid", "sessionid"], ["itemInSession"]), 126, 126003
    )


@query(
    "q_listeners_of_song",
    "SELECT first_name, last_name FROM music_log WHERE song_title = 'large plate 15'",
    QUESTION_SQL,
)
def q_listeners_of_song(spark: SparkSession, sf: str) -> DataFrame:
    """Everyone who heard one song."""
    return query_tables.listeners_of_song(
        _laid_out(spark, sf, music_log, ["song_title"], ["userid"]), "large plate 15"
    )

"""Projections, filters, text, casts and keys."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from rondo.functions.clean import blank_to_null, count_cut, count_rejects, to_double, to_int, to_whole_decimal, truncate_text
from rondo.functions.keys import concat_text, natural_key, session_second_key
from rondo.functions.timeparts import date_path, ms_to_second, ms_to_timestamp
from rondo.operators.numbering import identity_ids
from rondo.operators.published import Parts, Published
from rondo.operators.quality import unique_ids
from rondo.plans.query_tables import events_denormalised
from rondo.plans.star import LENGTH, lookup_first_match, match_catalogue, match_every, next_song
from rondo.queries.base import query
from rondo.schemas import DENORMALISED, LOG
from rondo.session import scratch_path
from rondo.sources.files import read_csv
from rondo.sources.views import staging_events, staging_songs

SONG_KEYS = (("song", "title"), ("artist", "artist_name"))


@query("project_columns", "SELECT song_id, title, artist_id, year, duration FROM staging_songs")
def project_columns(spark: SparkSession, sf: str) -> DataFrame:
    return staging_songs(spark, sf).select("song_id", "title", "artist_id", "year", "duration")


@query(
    "project_rename",
    """SELECT artist_id, artist_name AS name, artist_location AS location, artist_latitude AS latitude,
              artist_longitude AS longitude FROM staging_songs""",
)
def project_rename(spark: SparkSession, sf: str) -> DataFrame:
    return staging_songs(spark, sf).selectExpr(
        "artist_id",
        "artist_name AS name",
        "artist_location AS location",
        "artist_latitude AS latitude",
        "artist_longitude AS longitude",
    )


@query(
    "project_positional",
    """SELECT artist, "firstName", gender, "itemInSession", "lastName", length, level, location, "sessionId", song,
              "userId" FROM staging_events""",
)
def project_positional(spark: SparkSession, sf: str) -> DataFrame:
    """The eleven kept fields of a CSV whose columns stand in another order, bound by name instead of position."""
    path = scratch_path(spark, "permuted")
    staging_events(spark, sf, sorted(DENORMALISED.names, reverse=True)).write.option("header", "true").csv(
        path, escape='"', emptyValue='""'
    )
    kinds = {f.name: f.dataType for f in LOG.fields}
    schema = StructType([StructField(name, kinds[name]) for name in DENORMALISED.names])
    return read_csv(spark, path, schema).withColumn("userId", F.coalesce("userId", F.lit("")))


@query(
    "derive_subquery",
    """SELECT make_timestamp_ms((ts // 1000) * 1000) AS start_time, * FROM staging_events
       WHERE page = 'NextSong'""",
)
def derive_subquery(spark: SparkSession, sf: str) -> DataFrame:
    return next_song(staging_events(spark, sf)).withColumn("start_time", ms_to_second("ts"))


@query(
    "alias_reuse",
    """SELECT event_id, start_time, hour(start_time) AS hour, year(start_time) AS year
       FROM (SELECT event_id, make_timestamp_ms((ts // 1000) * 1000) AS start_time FROM staging_events)""",
)
def alias_reuse(spark: SparkSession, sf: str) -> DataFrame:
    timed = staging_events(spark, sf, ["event_id", "ts"])
    return timed.select(
        "event_id",
        ms_to_second("ts").alias("start_time"),
        F.expr("hour(start_time)").alias("hour"),
        F.expr("year(start_time)").alias("year"),
    )


@query("filter_next_song", "SELECT * FROM staging_events WHERE page = 'NextSong'")
def filter_next_song(spark: SparkSession, sf: str) -> DataFrame:
    return next_song(staging_events(spark, sf))


@query(
    "filter_not_null",
    """SELECT event_id, ts, level, nullif("userId", '') AS "userId" FROM staging_events
       WHERE nullif("userId", '') IS NOT NULL""",
)
def filter_not_null(spark: SparkSession, sf: str) -> DataFrame:
    events = blank_to_null(staging_events(spark, sf, ["event_id", "ts", "level", "userId"]), ["userId"])
    return events.filter(F.col("userId").isNotNull())


@query("filter_non_empty", "SELECT event_id, artist, song, length FROM staging_events WHERE artist <> ''")
def filter_non_empty(spark: SparkSession, sf: str) -> DataFrame:
    events = staging_events(spark, sf, ["event_id", "artist", "song", "length"])
    return events.filter("artist IS NOT NULL AND artist <> ''")


@query(
    "filter_conjunction",
    """SELECT event_id, artist, song, length, "sessionId", "userId" FROM staging_events
       WHERE "sessionId" = 126003 AND "userId" = '126' AND page = 'NextSong'""",
)
def filter_conjunction(spark: SparkSession, sf: str) -> DataFrame:
    columns = ["event_id", "artist", "song", "length", "sessionId", "userId", "page"]
    wanted = (F.col("sessionId") == 126003) & (F.col("userId") == "126") & (F.col("page") == "NextSong")
    return staging_events(spark, sf, columns).filter(wanted).drop("page")


@query(
    "filter_in_join_on",
    """SELECT e.event_id, e.ts, s.song_id, s.artist_id FROM staging_events e JOIN staging_songs s
       ON e.song = s.title AND e.artist = s.artist_name AND e.level = 'paid'""",
)
def filter_in_join_on(spark: SparkSession, sf: str) -> DataFrame:
    """A one-sided condition of an inner join is a filter before it."""
    events = staging_events(spark, sf, ["event_id", "ts", "song", "artist", "level"])
    paid = events.filter("level = 'paid'").drop("level")
    matched = match_every(paid, staging_songs(spark, sf), SONG_KEYS)
    return matched.select("event_id", "ts", "song_id", "artist_id")


@query(
    "blank_to_null",
    """SELECT event_id, nullif(trim("userId"), '') AS "userId", song FROM staging_events""",
)
def blank_text(spark: SparkSession, sf: str) -> DataFrame:
    return blank_to_null(staging_events(spark, sf, ["event_id", "userId", "song"]))


@query(
    "truncate_text",
    "SELECT doc_id, substring(text, 1, 256) AS text FROM documents",
)
def cut_text(spark: SparkSession, sf: str) -> DataFrame:
    """Whole texts are read; the declared column width cuts what is stored."""
    documents = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    return truncate_text(documents, columns=["text"])


@query(
    "truncate_text_report",
    """SELECT count(*) FILTER (length(text) > 256) AS text_cut, count(*) FILTER (length(source) > 256) AS source_cut
       FROM documents""",
)
def cut_text_report(spark: SparkSession, sf: str) -> DataFrame:
    """How many values a cut to the declared width would shorten."""
    documents = spark.read.parquet(f"{sf}/documents.parquet").select("text", "source")
    return count_cut(documents, {"text": 256, "source": 256})


@query("epoch_ms_parse", "SELECT event_id, make_timestamp_ms(ts) AS ts FROM staging_events")
def epoch_ms_parse(spark: SparkSession, sf: str) -> DataFrame:
    """Loading epoch milliseconds into a timestamp column."""
    return staging_events(spark, sf, ["event_id", "ts"]).withColumn("ts", ms_to_timestamp("ts"))


@query(
    "concat_text",
    """SELECT event_id, "sessionId"::VARCHAR || make_timestamp_ms((ts // 1000) * 1000)::VARCHAR AS joined,
              song || artist AS song_artist
       FROM staging_events""",
)
def joined_text(spark: SparkSession, sf: str) -> DataFrame:
    events = staging_events(spark, sf, ["event_id", "sessionId", "ts", "song", "artist"])
    return events.select(
        "event_id",
        concat_text(F.col("sessionId"), ms_to_second("ts")).alias("joined"),
        concat_text(F.col("song"), F.col("artist")).alias("song_artist"),
    )


@query(
    "md5_key",
    """SELECT event_id, md5(concat(CAST("sessionId" AS VARCHAR),
                strftime(make_timestamp_ms((ts // 1000) * 1000), '%Y-%m-%d %H:%M:%S'))) AS songplay_id
       FROM staging_events""",
)
def md5_key(spark: SparkSession, sf: str) -> DataFrame:
    events = staging_events(spark, sf, ["event_id", "sessionId", "ts"])
    key = session_second_key(F.col("sessionId"), ms_to_second("ts"))
    return events.select("event_id", key.alias("songplay_id"))


@query(
    "date_path_format",
    "SELECT event_id, strftime(make_timestamp_ms(ts), '%Y/%m/%d') AS day_path FROM staging_events",
)
def date_path_format(spark: SparkSession, sf: str) -> DataFrame:
    events = staging_events(spark, sf, ["event_id", "ts"])
    return events.select("event_id", date_path(ms_to_timestamp("ts")).alias("day_path"))


@query(
    "cast_int_float",
    """SELECT event_id, TRY_CAST("userId" AS INTEGER) AS user_id, TRY_CAST(part_text AS DOUBLE) AS number
       FROM (SELECT event_id, "userId", split_part("userAgent", '/', 2) AS part_text FROM staging_events)""",
)
def cast_int_float(spark: SparkSession, sf: str) -> DataFrame:
    events = staging_events(spark, sf, ["event_id", "userId", "userAgent"])
    texts = events.withColumn("part_text", F.split_part(F.col("userAgent"), F.lit("/"), F.lit(2)))
    return texts.select("event_id", to_int("userId").alias("user_id"), to_double("part_text").alias("number"))


@query(
    "cast_rejects",
    """SELECT count(*) FILTER (WHERE trim("userId") <> '' AND TRY_CAST("userId" AS INTEGER) IS NULL)
                AS "userId_rejects",
              count(*) FILTER (WHERE trim(song) <> '' AND TRY_CAST(song AS DOUBLE) IS NULL) AS song_rejects
       FROM staging_events""",
)
def cast_rejects(spark: SparkSession, sf: str) -> DataFrame:
    events = staging_events(spark, sf, ["userId", "song"])
    return count_rejects(events, {"userId": to_int("userId"), "song": to_double("song")})


@query(
    "cast_numeric_18_0",
    """SELECT event_id, CAST(trunc(length) AS DECIMAL(18,0)) AS length,
              CAST(trunc(-length) AS DECIMAL(18,0)) AS negated FROM staging_events""",
)
def cast_numeric_18_0(spark: SparkSession, sf: str) -> DataFrame:
    events = staging_events(spark, sf, ["event_id", "length"]).withColumn("negated", -F.col("length"))
    return events.select(
        "event_id", to_whole_decimal("length").alias("length"), to_whole_decimal("negated").alias("negated")
    )


@query(
    "join_numeric_18_0",
    """SELECT e.event_id, s.song_id FROM staging_events e LEFT JOIN staging_songs s
       ON e.song = s.title AND e.artist = s.artist_name AND trunc(e.length) = trunc(s.duration)
       WHERE e.page = 'NextSong'""",
)
def join_numeric_18_0(spark: SparkSession, sf: str) -> DataFrame:
    """The three-key join with lengths stored as numeric(18,0)."""
    plays = next_song(staging_events(spark, sf, ["event_id", "page", "song", "artist", "length"]))
    matched = match_catalogue(plays, staging_songs(spark, sf), (*SONG_KEYS, LENGTH), whole_seconds=True)
    return matched.select("event_id", "song_id")


LOOKUP_SQL = """known_songs AS (
  SELECT song_id, title, artist_id, duration FROM staging_songs WHERE song_id IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY song_id ORDER BY title, artist_id, year, duration) = 1),
known_artists AS (
  SELECT artist_id, artist_name FROM staging_songs WHERE artist_id IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY artist_id ORDER BY artist_name NULLS FIRST,
    artist_location NULLS FIRST, artist_latitude NULLS FIRST, artist_longitude NULLS FIRST) = 1),
lookup AS (
  SELECT title, artist_name, duration, song_id, s.artist_id
  FROM known_songs s JOIN known_artists USING (artist_id)
  QUALIFY row_number() OVER (PARTITION BY title, artist_name, duration ORDER BY song_id) = 1)"""


@query(
    "null_default",
    """SELECT e.event_id, l.song_id, l.artist_id FROM staging_events e LEFT JOIN lookup l
       ON e.song = l.title AND e.artist = l.artist_name AND e.length = l.duration
       WHERE e.page = 'NextSong' AND l.song_id IS NULL""",
    LOOKUP_SQL,
)
def null_default(spark: SparkSession, sf: str) -> DataFrame:
    """Plays whose lookup finds nothing keep null ids."""
    plays = next_song(staging_events(spark, sf, ["event_id", "page", "song", "artist", "length"]))
    found = lookup_first_match(plays, staging_songs(spark, sf))
    return found.filter(F.col("song_id").isNull()).select("event_id", "song_id", "artist_id")


@query("surrogate_monotonic", "SELECT event_id, ts, true AS id_unique FROM staging_events WHERE page = 'NextSong'")
def surrogate_monotonic(spark: SparkSession, sf: str) -> DataFrame:
    """Unique but unstable numbers: the plays, and whether each play's number is its own."""
    events = staging_events(spark, sf, ["event_id", "ts", "page"])
    plays = next_song(events).select(F.monotonically_increasing_id().alias("songplay_id"), "event_id", "ts")
    return unique_ids(plays, "songplay_id")


@query(
    "surrogate_identity",
    """SELECT row_number() OVER (ORDER BY ts, event_id) - 1 AS songplay_id, event_id, ts
       FROM staging_events WHERE page = 'NextSong'""",
)
def surrogate_identity(spark: SparkSession, sf: str) -> DataFrame:
    plays = next_song(staging_events(spark, sf, ["event_id", "ts", "page"])).drop("page")
    return identity_ids(plays, ["ts", "event_id"], "songplay_id")


@query(
    "surrogate_identity_appended",
    """SELECT row_number() OVER (ORDER BY level <> 'paid', ts, event_id) - 1 AS songplay_id, event_id, ts
       FROM staging_events WHERE page = 'NextSong'""",
)
def surrogate_identity_appended(spark: SparkSession, sf: str) -> DataFrame:
    """Plays of even days loaded first, then those of odd days: the second load's numbers go on where the first one's end."""
    shape = StructType([StructField(c, LongType()) for c in ("songplay_id", "event_id", "ts")])
    store = Published(spark, scratch_path(spark, "numbered"), {"songplays": (shape, Parts(("ts",), step=86_400_000))})
    plays = next_song(staging_events(spark, sf, ["event_id", "ts", "page", "level"]))
    for level in ("paid", "free"):
        load = store.begin()
        own = plays.where(F.col("level") == level).select("event_id", "ts")
        load.append_numbered("songplays", own, ["ts", "event_id"], "songplay_id")
        load.publish()
    return store.read("songplays")


@query(
    "surrogate_row_index",
    """SELECT md5(concat_ws('|', "sessionId"::VARCHAR, "itemInSession"::VARCHAR, ts::VARCHAR)) AS songplay_id,
              event_id
       FROM staging_events WHERE page = 'NextSong'""",
)
def surrogate_row_index(spark: SparkSession, sf: str) -> DataFrame:
    """A hash of the play's natural key in place of its row number in a file."""
    plays = next_song(staging_events(spark, sf, ["event_id", "page", "sessionId", "itemInSession", "ts"]))
    key = natural_key(F.col("sessionId"), F.col("itemInSession"), F.col("ts"))
    return plays.select(key.alias("songplay_id"), "event_id")


@query(
    "events_denormalised",
    """SELECT artist, "firstName", gender, CAST("itemInSession" AS INTEGER) AS "itemInSession", "lastName", length,
              level, location, CAST("sessionId" AS INTEGER) AS "sessionId", song,
              TRY_CAST("userId" AS INTEGER) AS "userId"
       FROM staging_events WHERE artist <> ''""",
)
def denormalised(spark: SparkSession, sf: str) -> DataFrame:
    return events_denormalised(staging_events(spark, sf, DENORMALISED.names))

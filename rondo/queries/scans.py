"""Sources. Each query stores the staged rows in the format under test and returns what the reader gives back."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from rondo.functions.clean import blank_to_null
from rondo.functions.timeparts import calendar_parts, ms_to_timestamp
from rondo.operators.quality import count_rows
from rondo.operators.sinks import write_csv, write_partitioned, write_plain
from rondo.plans.pipeline import apply_to_all
from rondo.plans.query_tables import events_denormalised, music_log, session_songs, user_songs
from rondo.plans.star import next_song
from rondo.queries.base import query
from rondo.schemas import EVENT_CSV, LOG, LOG_WITH_ID, SONG
from rondo.session import scratch_path, shuffle_tasks
from rondo.sources import files
from rondo.sources.jsonpaths import stage_by_paths
from rondo.sources.views import staging_events, staging_songs

LOG_SQL = ", ".join(f'"{c}"' for c in LOG.names)
SONG_SQL = ", ".join(SONG.names)


def log_as_json(spark: SparkSession, sf: str) -> str:
    path = scratch_path(spark, "log")
    staging_events(spark, sf, LOG.names).write.json(path)
    return path


def songs_as_json(spark: SparkSession, sf: str) -> str:
    path = scratch_path(spark, "songs")
    staging_songs(spark, sf).write.json(path)
    return path


def denormalised_as_csv(spark: SparkSession, sf: str) -> str:
    path = scratch_path(spark, "denormalised")
    write_csv(events_denormalised(staging_events(spark, sf)), path)
    return path


@query("scan_json_log", f"SELECT {LOG_SQL} FROM staging_events")
def scan_json_log(spark: SparkSession, sf: str) -> DataFrame:
    return files.read_log(spark, log_as_json(spark, sf))


@query("scan_json_log_inferred", f"SELECT {LOG_SQL} FROM staging_events")
def scan_json_log_inferred(spark: SparkSession, sf: str) -> DataFrame:
    return files.read_log(spark, log_as_json(spark, sf), infer=True).select(*LOG.names)


@query("scan_json_song", f"SELECT {SONG_SQL} FROM staging_songs")
def scan_json_song(spark: SparkSession, sf: str) -> DataFrame:
    return files.read_songs(spark, songs_as_json(spark, sf))


def _songs_in_folders(spark: SparkSession, sf: str) -> str:
    """The catalogue spread over three levels of folders by letters of the song id."""
    path = scratch_path(spark, "song-tree")
    songs = staging_songs(spark, sf)
    levels = [F.substring("song_id", at, 1).alias(f"level{at}") for at in (1, 2, 3)]
    songs.select("*", *levels).write.partitionBy("level1", "level2", "level3").json(path)
    return path


@query("scan_glob", f"SELECT {SONG_SQL} FROM staging_songs")
def scan_glob(spark: SparkSession, sf: str) -> DataFrame:
    return files.read_songs(spark, _songs_in_folders(spark, sf) + "/*/*/*/*.json")


@query("scan_recursive", f"SELECT {SONG_SQL} FROM staging_songs")
def scan_recursive(spark: SparkSession, sf: str) -> DataFrame:
    return files.read_tree(spark, _songs_in_folders(spark, sf), SONG)


EVENT_CSV_SQL = ", ".join(
    f'nullif("{f}", \'\') AS "{f}"' if f in ("userId",) else f'"{f}"'
    for f in EVENT_CSV.names
    if f not in ("itemInSession", "length", "registration", "sessionId", "status", "ts")
)


@query(
    "scan_csv_events",
    f"""SELECT {EVENT_CSV_SQL}, "itemInSession", length, registration, "sessionId", status, ts
        FROM staging_events""",
)
def scan_csv_events(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "event-csv")
    events = staging_events(spark, sf, EVENT_CSV.names)
    events.write.option("header", "true").option("escape", '"').csv(path)
    raw = files.read_event_csv(spark, path)
    whole = ["itemInSession", "sessionId", "status", "ts"]
    typed = {c: F.expr(f"try_cast({c} AS BIGINT)") for c in whole}
    typed |= {c: F.expr(f"try_cast({c} AS DOUBLE)") for c in ("length", "registration")}
    return blank_to_null(raw, ["userId"]).withColumns(typed)


@query(
    "scan_csv_denorm",
    """SELECT 'session_songs' AS table_name, count(*) AS n_rows FROM
         (SELECT DISTINCT "sessionId", "itemInSession" FROM staging_events WHERE artist <> '')
       UNION ALL SELECT 'user_songs', count(*) FROM
         (SELECT DISTINCT "userId", "sessionId", "itemInSession" FROM staging_events WHERE artist <> '')
       UNION ALL SELECT 'music_log', count(*) FROM
         (SELECT DISTINCT song, "userId" FROM staging_events WHERE artist <> '')""",
)
def scan_csv_denorm(spark: SparkSession, sf: str) -> DataFrame:
    """One reader of the stored CSV feeds all three query tables."""
    rows = files.read_denormalised(spark, denormalised_as_csv(spark, sf))
    # The file has no usable clock; a play's place in its session orders the writes.
    order = {"at_session": F.col("sessionId"), "at_item": F.col("itemInSession")}
    ordered = rows.withColumns(order)
    counts = [
        count_rows(build(ordered, list(order))).select(F.lit(build.__name__).alias("table_name"), "n_rows")
        for build in (session_songs, user_songs, music_log)
    ]
    return counts[0].unionByName(counts[1]).unionByName(counts[2])


STAGED_NAMES = {
    "artist": "artist", "auth": "auth", "first_name": "firstName", "gender": "gender",
    "item_in_session": "itemInSession", "last_name": "lastName", "length": "length", "level": "level",
    "location": "location", "method": "method", "page": "page", "registration": "registration",
    "session_id": "sessionId", "song": "song", "status": "status", "ts": "ts", "user_agent": "userAgent",
    "user_id": "userId",
}


@query(
    "stage_events_bulk",
    "SELECT "
    + ", ".join(f'"{source}" AS {target}' for target, source in STAGED_NAMES.items() if target != "user_id")
    + ", nullif(\"userId\", '') AS user_id FROM staging_events",
)
def stage_events_bulk(spark: SparkSession, sf: str) -> DataFrame:
    """Field-to-column map given by name."""
    return files.stage(spark, log_as_json(spark, sf), LOG, fields=STAGED_NAMES)


#: Where each staged column lies in a nested log record.
NESTED_PATHS = {
    "artist": "$.play.song.artist", "auth": "$['auth']", "first_name": "$.user['names'][0]", "gender": "$.user.gender",
    "item_in_session": "$.session[1]", "last_name": "$.user.names[1]", "length": "$.play.song.length", "level": "$.user.level",
    "location": "$.user.location", "method": "$.request.method", "page": "$.page", "registration": "$.user.registration",
    "session_id": "$.session[0]", "song": "$.play[\"song\"].title", "status": "$.request.status", "ts": "$.ts",
    "user_agent": "$.request.agents[0].text", "user_id": "$.user.id",
}


@query(
    "stage_events_jsonpaths",
    "SELECT "
    + ", ".join(f'"{source}" AS {target}' for target, source in STAGED_NAMES.items() if target != "user_id")
    + ", nullif(\"userId\", '') AS user_id FROM staging_events",
)
def stage_events_jsonpaths(spark: SparkSession, sf: str) -> DataFrame:
    """Nested log records staged by a stored JSONPaths document."""
    path = scratch_path(spark, "nested")
    nested = staging_events(spark, sf, LOG.names).selectExpr(
        "auth", "page", "ts", "array(sessionId, itemInSession) AS session",
        "named_struct('song', named_struct('artist', artist, 'title', song, 'length', length)) AS play",
        "named_struct('id', userId, 'names', array(firstName, lastName), 'gender', gender, 'level', level, 'location', location,"
        " 'registration', registration) AS user",
        "named_struct('method', method, 'status', status, 'agents', array(named_struct('text', userAgent))) AS request",
    )
    nested.write.json(f"{path}/log")
    document = spark.range(1).select(F.lit(json.dumps({"jsonpaths": list(NESTED_PATHS.values())})).alias("value"))
    document.coalesce(1).write.text(f"{path}/paths")
    fields = [StructField(target, LOG[STAGED_NAMES[target]].dataType) for target in NESTED_PATHS]
    return stage_by_paths(spark, f"{path}/log", f"{path}/paths", StructType(fields))


@query("stage_songs_bulk", f"SELECT {SONG_SQL} FROM staging_songs")
def stage_songs_bulk(spark: SparkSession, sf: str) -> DataFrame:
    return files.stage(spark, songs_as_json(spark, sf), SONG, clean_text=False)


@query(
    "stage_options",
    f"""SELECT {SONG_SQL.replace('artist_location', "nullif(artist_location, '') AS artist_location")}
        FROM staging_songs""",
)
def stage_options(spark: SparkSession, sf: str) -> DataFrame:
    """The CSV form of the templated load: header skipped, blanks to null, text kept whole."""
    path = scratch_path(spark, "song-csv")
    staging_songs(spark, sf).select(*SONG.names).write.option("header", "true").csv(path)
    return files.stage(spark, path, SONG, fmt="csv")


@query(
    "scan_date_path",
    f"""SELECT {LOG_SQL.replace('"userId"', "nullif(\"userId\", '') AS \"userId\"")} FROM staging_events
        WHERE CAST(make_timestamp_ms(ts) AS DATE) =
              (SELECT max(CAST(make_timestamp_ms(ts) AS DATE)) FROM staging_events)""",
)
def scan_date_path(spark: SparkSession, sf: str) -> DataFrame:
    """The log stored by day; the load opens the latest day's folder only."""
    path = scratch_path(spark, "log-by-day")
    day = ms_to_timestamp("ts").cast("date")
    events = staging_events(spark, sf, LOG.names).withColumns(
        {"year": F.date_format(day, "yyyy"), "month": F.date_format(day, "MM"), "day": F.date_format(day, "dd")}
    )
    events.hint("rebalance", "year", "month", "day").write.partitionBy("year", "month", "day").json(path)
    moments = staging_events(spark, sf, ["ts"])
    latest = moments.agg(F.max(day).alias("d")).first().d
    return files.stage(spark, path, LOG, day=latest, day_pattern="year=%Y/month=%m/day=%d")


@query("scan_parquet_partitions", f"SELECT {SONG_SQL} FROM staging_songs")
def scan_parquet_partitions(spark: SparkSession, sf: str) -> DataFrame:
    """Partition columns come back from the folder names."""
    path = scratch_path(spark, "songs-by-year")
    write_partitioned(staging_songs(spark, sf), path, ["year", "artist_id"], tasks=shuffle_tasks(spark))
    return files.read_partitioned(spark, path, "*/*", SONG)


@query("scan_table", f"SELECT event_id, {LOG_SQL} FROM staging_events")
def scan_table(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "stored-log")
    write_plain(staging_events(spark, sf), path)
    return files.read_table(spark, path)


@query("union_files", f"SELECT event_id, {LOG_SQL} FROM staging_events")
def union_files(spark: SparkSession, sf: str) -> DataFrame:
    """Plays stored as JSON in two folders and other events as parquet, read back as one bag of rows."""
    events = staging_events(spark, sf)
    root = scratch_path(spark, "many-files")
    plays = next_song(events)
    plays.filter("level = 'paid'").write.json(f"{root}/paid")
    plays.filter("level <> 'paid' OR level IS NULL").write.json(f"{root}/free")
    write_plain(events.filter("page <> 'NextSong'"), f"{root}/other")
    stored = files.read_json(spark, [f"{root}/paid", f"{root}/free"], LOG_WITH_ID)
    return stored.unionByName(files.read_table(spark, f"{root}/other"))


@query(
    "apply_transform",
    """SELECT event_id, ts, hour(t) AS hour, day(t) AS day, week(t) AS week, month(t) AS month, year(t) AS year,
              dayname(t) AS weekday
       FROM (SELECT *, make_timestamp_ms(ts) AS t FROM staging_events WHERE page = 'NextSong')""",
)
def apply_transform(spark: SparkSession, sf: str) -> DataFrame:
    """Whole-table steps passed as functions."""
    return apply_to_all(
        staging_events(spark, sf, ["event_id", "page", "ts"]),
        next_song,
        lambda df: df.select("event_id", "ts", *calendar_parts(ms_to_timestamp("ts"))),
    )

"""One registry of record shapes, keys and constraints, shared by sources, builders, sinks and checks."""

from __future__ import annotations

from pyspark.sql.types import (
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)

_TYPES = {
    "string": StringType(),
    "int": IntegerType(),
    "long": LongType(),
    "double": DoubleType(),
    "ts": TimestampNTZType(),
}


def shape(spec: str) -> StructType:
    """``"a string, b int"`` to a StructType, using the short type names above."""
    fields = (part.split() for part in spec.split(","))
    return StructType([StructField(name, _TYPES[kind]) for name, kind in fields])


# Raw play log, one JSON object per line.
LOG = shape(
    "artist string, auth string, firstName string, gender string, itemInSession long, lastName string,"
    "length double, level string, location string, method string, page string, registration double,"
    "sessionId long, song string, status long, ts long, userAgent string, userId string"
)

# The log with the tie-breaking event number our own ordered loads need.
LOG_WITH_ID = StructType([StructField("event_id", LongType()), *LOG.fields])

# Song catalogue, one JSON object per file.
SONG = shape(
    "artist_id string, artist_latitude double, artist_location string, artist_longitude double,"
    "artist_name string, duration double, num_songs int, song_id string, title string, year int"
)

# Event CSV: everything is text in the file, so numbers are cast later and their rejects counted.
EVENT_CSV = shape(
    "artist string, auth string, firstName string, gender string, itemInSession string, lastName string,"
    "length string, level string, location string, method string, page string, registration string,"
    "sessionId string, song string, status string, ts string, userId string"
)

# The narrower CSV kept for the query tables.
DENORMALISED = shape(
    "artist string, firstName string, gender string, itemInSession int, lastName string, length double,"
    "level string, location string, sessionId int, song string, userId int"
)

STAR: dict[str, StructType] = {
    "songplays": shape(
        "songplay_id string, start_time ts, user_id int, level string, song_id string, artist_id string,"
        "session_id long, location string, user_agent string"
    ),
    "users": shape("user_id int, first_name string, last_name string, gender string, level string"),
    "songs": shape("song_id string, title string, artist_id string, year int, duration double"),
    "artists": shape("artist_id string, name string, location string, latitude double, longitude double"),
    "time": shape("start_time ts, hour int, day int, week int, month int, year int, weekday string"),
}

PRIMARY_KEYS: dict[str, list[str]] = {
    "songplays": ["songplay_id"],
    "users": ["user_id"],
    "songs": ["song_id"],
    "artists": ["artist_id"],
    "time": ["start_time"],
    "session_songs": ["sessionId", "itemInSession"],
    "user_songs": ["userid", "sessionid", "itemInSession"],
    "music_log": ["song_title", "userid"],
}

NOT_NULL: dict[str, list[str]] = {
    "songplays": ["songplay_id", "start_time", "user_id"],
    "users": ["user_id", "first_name", "last_name", "gender", "level"],
    "songs": ["song_id", "title", "artist_id", "year", "duration"],
    "artists": ["artist_id", "name"],
    "time": ["start_time", "hour", "day", "week", "month", "year", "weekday"],
}

# (child table, child column, parent table, parent column); a null child passes.
FOREIGN_KEYS: list[tuple[str, str, str, str]] = [
    ("songplays", "start_time", "time", "start_time"),
    ("songplays", "user_id", "users", "user_id"),
    ("songplays", "song_id", "songs", "song_id"),
    ("songplays", "artist_id", "artists", "artist_id"),
    ("songs", "artist_id", "artists", "artist_id"),
]

# Declared width of the text columns in the staging tables.
TEXT_WIDTH = 256

# Parents come before children when creating, so dropping runs the other way round.
TABLE_ORDER = ["users", "artists", "songs", "time", "songplays"]

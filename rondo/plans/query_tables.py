"""Denormalised events and the three tables laid out for one question each."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rondo.functions.clean import to_double, to_int
from rondo.operators.upsert import upsert_last_write
from rondo.schemas import DENORMALISED, PRIMARY_KEYS

ORDER = ("ts", "event_id")


def events_denormalised(events: DataFrame, *more: str) -> DataFrame:
    """Those of the eleven columns of the query tables that ``events`` has, for events that name an artist."""
    named = events.filter("artist IS NOT NULL AND artist <> ''")
    casts = {"int": to_int, "double": to_double}
    columns = [
        casts[f.dataType.simpleString()](f.name).alias(f.name)
        if f.dataType.simpleString() in casts
        else F.col(f.name)
        for f in DENORMALISED.fields
        if f.name in events.columns
    ]
    return named.select(*columns, *more)


def session_songs(rows: DataFrame, order: Sequence[str] = ORDER) -> DataFrame:
    """What was heard at each position of each session; the last write of a position wins."""
    shaped = rows.select(
        "sessionId",
        "itemInSession",
        "artist",
        F.col("song").alias("song_title"),
        F.col("length").alias("song_length"),
        *order,
    )
    return upsert_last_write(shaped, PRIMARY_KEYS["session_songs"], order).drop(*order)


def user_songs(rows: DataFrame, order: Sequence[str] = ORDER) -> DataFrame:
    """The playlist of each user's sessions, with the user's names."""
    shaped = rows.select(
        F.col("userId").alias("userid"),
        F.col("sessionId").alias("sessionid"),
        "itemInSession",
        "artist",
        F.col("song").alias("song_title"),
        F.col("length").alias("song_length"),
        F.col("firstName").alias("first_name"),
        F.col("lastName").alias("last_name"),
        *order,
    )
    return upsert_last_write(shaped, PRIMARY_KEYS["user_songs"], order).drop(*order)


def music_log(rows: DataFrame, order: Sequence[str] = ORDER) -> DataFrame:
    """Who listened to each song; repeat plays of a user collapse to the last."""
    shaped = rows.select(
        F.col("song").alias("song_title"),
        F.col("userId").alias("userid"),
        F.col("firstName").alias("first_name"),
        F.col("lastName").alias("last_name"),
        *order,
    )
    return upsert_last_write(shaped, PRIMARY_KEYS["music_log"], order).drop(*order)


def song_in_session(table: DataFrame, session_id: int, item: int) -> DataFrame:
    """Artist, title and length of one position of one session."""
    hit = table.filter((F.col("sessionId") == session_id) & (F.col("itemInSession") == item))
    return hit.select("artist", "song_title", "song_length")


def user_session_playlist(table: DataFrame, user_id: int, session_id: int) -> DataFrame:
    """One user's session in playing order."""
    hits = table.filter((F.col("userid") == user_id) & (F.col("sessionid") == session_id))
    columns = ["itemInSession", "artist", "song_title", "first_name", "last_name"]
    return hits.select(*columns).orderBy("itemInSession")


def listeners_of_song(table: DataFrame, title: str) -> DataFrame:
    """Names of everyone who heard a song."""
    return table.filter(F.col("song_title") == title).select("first_name", "last_name")

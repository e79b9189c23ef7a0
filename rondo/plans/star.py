"""Star-schema builders. Each returns a lazy frame; variants of a table are parameters.

``events`` is the staged log (optionally with ``event_id``), ``songs`` the staged catalogue.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rondo.functions.clean import to_int, to_whole_decimal
from rondo.functions.keys import key_text, natural_key, session_second_key
from rondo.functions.timeparts import calendar_parts, ms_to_second, ms_to_timestamp
from rondo.operators.joins import skew_join, tiled_join
from rondo.operators.reduce import distinct_rows, first_per_key
from rondo.operators.sinks import write_in_place, write_partitioned
from rondo.operators.upsert import upsert_update
from rondo.schemas import STAR

TITLE = ("song", "title")
ARTIST = ("artist", "artist_name")
LENGTH = ("length", "duration")


def next_song(events: DataFrame) -> DataFrame:
    """Song plays only."""
    return events.filter(F.col("page") == "NextSong")


def match_catalogue(
    plays: DataFrame,
    songs: DataFrame,
    on: Sequence[tuple[str, str]] = (TITLE, ARTIST, LENGTH),
    how: str = "left",
    distinct_songs: bool = False,
    whole_seconds: bool = False,
    **skew,
) -> DataFrame:
    """Plays with the ids of matching catalogue songs.

    Keys compare by exact equality; ``whole_seconds`` compares lengths as numeric(18,0) instead. Every
    catalogue row counts as a match unless ``distinct_songs`` first reduces it to one row per key and id.
    """
    columns = [b for _, b in on] + ["song_id", "artist_id"]
    catalogue = songs.select(*columns)
    if whole_seconds and LENGTH in on:
        plays = plays.withColumn("length", to_whole_decimal("length"))
        catalogue = catalogue.withColumn("duration", to_whole_decimal("duration"))
    if distinct_songs:
        catalogue = catalogue.distinct()
    return skew_join(plays, catalogue, list(on), how, **skew)


def match_every(plays: DataFrame, songs: DataFrame, on: Sequence[tuple[str, str]], **tiling) -> DataFrame:
    """Every pair of a play and a matching catalogue row, copies included. Select the needed columns of plays first."""
    return tiled_join(plays, songs.select(*[b for _, b in on], *IDS), list(on), **tiling)


IDS = ["song_id", "artist_id"]


def split_catalogue(songs: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Keys and ids of the catalogue, each pair once: those of ids under one key, and those of ids under several."""
    rows = songs.select(*keys, *IDS).na.drop(how="any", subset=list(keys))
    key = F.struct(*keys)
    per_id = rows.groupBy(*IDS).agg(F.min(key).alias("_first"), F.max(key).alias("_last"))
    one = per_id.where("_first = _last").select(*[F.col(f"_first.{k}").alias(k) for k in keys], *IDS)
    several = per_id.where("_first != _last").select(*[F.col(i).alias(f"_{i}") for i in IDS])
    same = [F.col(i).eqNullSafe(F.col(f"_{i}")) for i in IDS]
    return one, rows.join(several, same, "left_semi").distinct()


def distinct_matches(
    plays: DataFrame,
    songs: DataFrame,
    on: Sequence[tuple[str, str]],
    shape: Callable[[DataFrame], DataFrame] = lambda rows: rows,
    shape_songs: Callable[[DataFrame], DataFrame] = lambda rows: rows,
    **skew,
) -> DataFrame:
    """Distinct rows of plays, without the keys, and ids of the catalogue songs they match.

    Where titles repeat the join makes many times more rows than it gets, so both sides are made distinct before it. After
    it a row can only come twice with ids that the catalogue holds under several keys; just those matches are made distinct
    again. ``shape`` changes columns of the distinct plays before the join, and must keep the keys and different rows different;
    ``shape_songs`` may add columns, made from the ids, to the catalogue or hint how to join it.
    """
    keys, others = [a for a, _ in on], [b for _, b in on]
    rows = shape(plays.distinct())
    kept = [c for c in rows.columns if c not in keys]
    once, again = [
        skew_join(rows, catalogue, list(on), "inner", **skew).select(*kept, *[c for c in catalogue.columns if c not in others])
        for catalogue in map(shape_songs, split_catalogue(songs, others))
    ]
    return once.unionByName(again.distinct())


def lookup_first_match(plays: DataFrame, songs: DataFrame, **skew) -> DataFrame:
    """At most one song per play: the smallest song_id with the same title, artist and length, or null ids.

    The names matched are those of the artists table, one per artist_id, as in a lookup over stored tables.
    """
    return lookup_stored(plays, songs_dim(songs), artists_dim(songs), **skew)


def lookup_stored(plays: DataFrame, songs: DataFrame, artists: DataFrame, **skew) -> DataFrame:
    """The lookup over a songs and an artists table, each with one row per id."""
    known = songs.select("song_id", "title", "artist_id", "duration")
    named = artists.select(F.col("artist_id").alias("_artist"), "name")
    candidates = skew_join(known, named, [("artist_id", "_artist")], "inner", right_unique=True, **skew)
    one = (
        candidates.groupBy("title", "name", "duration")
        .agg(F.min(F.struct("song_id", "artist_id")).alias("_hit"))
        .select("title", F.col("name").alias("artist_name"), "duration", "_hit.song_id", "_hit.artist_id")
    )
    return skew_join(plays, one, [TITLE, ARTIST, LENGTH], "left", right_unique=True, **skew)


def _own_columns(start_time: Column) -> dict[str, Column]:
    """The fact table's columns that come from the log."""
    return {
        "start_time": start_time,
        "user_id": to_int("userId"),
        "level": F.col("level"),
        "session_id": F.col("sessionId"),
        "location": F.col("location"),
        "user_agent": F.col("userAgent"),
    }


def _play_columns(start_time: Column, key: Column) -> list[Column]:
    columns = {"songplay_id": key, **_own_columns(start_time), **{i: F.col(i) for i in IDS}}
    return [columns[name].alias(name) for name in STAR["songplays"].names]


# What a play needs from the log, besides the keys of its catalogue match.
_LOGGED = ["ts", "userId", "level", "sessionId", "location", "userAgent"]


def _plays(events: DataFrame, *more: str) -> DataFrame:
    return next_song(events).select(*_LOGGED, *more)


def songplays_lookup(
    events: DataFrame,
    songs: DataFrame,
    grain: str = "timestamp",
    keep_first: Sequence[str] | None = None,
    **skew,
) -> DataFrame:
    """Every play, with the ids of its first matching song or null. ``grain="day"`` keeps the date only.

    ``keep_first`` is an order: of plays with one id, as in a log delivered twice, the first by it stays.
    """
    plays = _plays(events, "itemInSession", "song", "artist", "length", *(keep_first or []))
    if keep_first:
        plays = first_per_key(plays, ["sessionId", "itemInSession", "ts"], keep_first).drop(*keep_first)
    plays = lookup_first_match(plays, songs, **skew)
    start = ms_to_timestamp("ts")
    key = natural_key(F.col("sessionId"), F.col("itemInSession"), F.col("ts"))
    return plays.select(*_play_columns(start.cast("date") if grain == "day" else start, key))


def _built(rows: DataFrame) -> DataFrame:
    """Plays in the fact table's columns but the ids, with the texts before and after the ids in a row's key."""
    keys = [c for c in rows.columns if c not in _LOGGED]
    own = [column.alias(name) for name, column in _own_columns(ms_to_timestamp("ts")).items()]
    before, after = key_text(*[F.col(c) for c in _LOGGED[:3]]), key_text(*[F.col(c) for c in _LOGGED[3:]])
    return rows.select(*keys, *own, before.alias("_before"), after.alias("_after"))


def _named(catalogue: DataFrame) -> DataFrame:
    """The catalogue with the text of a song's ids in a row's key."""
    return catalogue.withColumn("_ids", key_text(*[F.col(i) for i in IDS]))


def _named_in_order(catalogue: DataFrame) -> DataFrame:
    """The same, for a merge join: plays of a title follow each other, each with the title's songs in one order.

    Song ids that repeat in one order are stored in next to nothing. A planner's hash join would leave plays as they come.
    """
    return _named(catalogue).hint("merge")


def _with_key(rows: DataFrame, *more: str) -> DataFrame:
    """Matched plays with the hash of the row as id."""
    key = F.md5(F.concat_ws("|", "_before", "_ids", "_after"))
    return rows.withColumn("songplay_id", key).select(*STAR["songplays"].names, *more)


def songplays_inner(events: DataFrame, songs: DataFrame, **skew) -> DataFrame:
    """Plays whose title and artist are in the catalogue, as distinct rows."""
    return _with_key(distinct_matches(_plays(events, "song", "artist"), songs, (TITLE, ARTIST), _built, _named, **skew))


_MONTH = ["year", "month"]


def _with_month(rows: DataFrame) -> DataFrame:
    return rows.withColumns({"year": F.year("start_time"), "month": F.month("start_time")})


def songplays_title_join(events: DataFrame, songs: DataFrame, **skew) -> DataFrame:
    """Plays whose title alone is in the catalogue, as distinct rows with year and month to partition by."""
    return _with_month(_with_key(distinct_matches(_plays(events, "song"), songs, (TITLE,), _built, _named_in_order, **skew)))


def write_title_plays(events: DataFrame, songs: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Store ``songplays_title_join`` in folders of year and month.

    Plays and the titles of a month's plays are joined by month and title, so the matches leave the join in the order of the
    folders and are written where they are made. The few others are added last: plays without a time, and matches with ids under
    several titles.
    """
    plays = _with_month(_built(_plays(events, "song").distinct()))
    once, again = map(_named, split_catalogue(songs, ["title"]))
    timed = plays.where(F.col("start_time").isNotNull())
    asked = timed.select(F.col("year").alias("_year"), F.col("month").alias("_month"), F.col("song").alias("_song")).distinct()
    monthly = skew_join(asked, once, [("_song", "title")], "inner")
    same = [F.col("year") == F.col("_year"), F.col("month") == F.col("_month"), F.col("song") == F.col("title")]
    write_in_place(_in_folders(timed.join(monthly.hint("merge"), same)), path, _MONTH, mode)
    untimed = skew_join(plays.where(F.col("start_time").isNull()), once, [TITLE], "inner")
    repeated = skew_join(plays, again, [TITLE], "inner")
    others = [rows.drop("song", "title") for rows in (untimed, repeated)]
    others = _in_folders(others[0].unionByName(others[1].distinct()))
    if not others.isEmpty():
        write_partitioned(others, path, _MONTH, "append")


def _in_folders(rows: DataFrame) -> DataFrame:
    return _with_key(rows, *_MONTH)


def songplays_left_md5(events: DataFrame, songs: DataFrame, whole_seconds: bool = False, **skew) -> DataFrame:
    """Every play, once per catalogue row matching on title, artist and length; md5 of session and second as id.

    The id repeats when two songs match or two plays share session and second.
    """
    timed = _plays(events, "song", "artist", "length").withColumn("start_time", ms_to_second("ts"))
    matched = match_catalogue(timed, songs, how="left", whole_seconds=whole_seconds, **skew)
    start = F.col("start_time")
    return matched.select(*_play_columns(start, session_second_key(F.col("sessionId"), start)))


def _users(events: DataFrame, user_id: Column, *more: str) -> DataFrame:
    return next_song(events).select(
        user_id.alias("user_id"),
        F.col("firstName").alias("first_name"),
        F.col("lastName").alias("last_name"),
        "gender",
        "level",
        *more,
    )


def users_upsert(
    events: DataFrame, order: Sequence[str] = ("ts", "event_id"), target: DataFrame | None = None
) -> DataFrame:
    """One row per user: names and gender of the first play, level of the last. Plays without a user are left out.

    With ``target``, stored users keep their names and gender and take the level, and its other users stay.
    """
    rows = _users(events, to_int("userId"), *order).filter(F.col("user_id").isNotNull())
    return upsert_update(rows, ["user_id"], list(order), ["level"], target)


def users_distinct(events: DataFrame, drop_blank: bool = True) -> DataFrame:
    """Distinct user rows, so a user who changed level appears once per level.

    ``drop_blank=False`` keeps logged-out plays as a row with a null user_id.
    """
    rows = _users(events, to_int("userId")).distinct()
    return rows.filter(F.col("user_id").isNotNull()) if drop_blank else rows


SONG_COLUMNS = ["song_id", "title", "artist_id", "year", "duration"]


def songs_dim(songs: DataFrame) -> DataFrame:
    """First row per song_id, taken in the order of the remaining columns."""
    rows = songs.select(*SONG_COLUMNS).filter(F.col("song_id").isNotNull())
    return first_per_key(rows, ["song_id"], ["title", "artist_id", "year", "duration"])


def songs_distinct(songs: DataFrame, drop_null: bool = True) -> DataFrame:
    """Distinct song rows, by default without null song_id."""
    rows = songs.select(*SONG_COLUMNS)
    return (rows.filter(F.col("song_id").isNotNull()) if drop_null else rows).distinct()


def songs_generated_id(songs: DataFrame, stable: bool = True) -> DataFrame:
    """Distinct title, artist, year and duration with a generated song_id.

    The stable id is a hash of the row. ``stable=False`` gives a unique number that a rerun may change.
    """
    columns = ["title", "artist_id", "year", "duration"]
    rows = distinct_rows(songs, columns)
    key = natural_key(*[F.col(c) for c in columns]) if stable else F.monotonically_increasing_id()
    return rows.withColumn("song_id", key)


def artist_rows(songs: DataFrame) -> DataFrame:
    """The catalogue's rows in the shape of the artists table."""
    return songs.select(
        "artist_id",
        F.col("artist_name").alias("name"),
        F.col("artist_location").alias("location"),
        F.col("artist_latitude").alias("latitude"),
        F.col("artist_longitude").alias("longitude"),
    )


def artists_dim(songs: DataFrame) -> DataFrame:
    """First row per artist_id, taken in the order of the remaining columns, nulls first."""
    rows = artist_rows(songs).filter(F.col("artist_id").isNotNull())
    return first_per_key(rows, ["artist_id"], ["name", "location", "latitude", "longitude"])


def artists_distinct(songs: DataFrame) -> DataFrame:
    """Distinct artist rows; an artist_id repeats when its details differ."""
    return artist_rows(songs).distinct()


def _with_parts(starts: DataFrame, weekday_style: str) -> DataFrame:
    return starts.select("start_time", *calendar_parts(F.col("start_time"), weekday_style))


def time_nextsong(events: DataFrame, grain: str = "timestamp", weekday_style: str = "full") -> DataFrame:
    """Calendar of song plays, milliseconds kept.

    Only the timestamps are shuffled for the distinct; the parts are computed afterwards. ``grain="day"`` keys
    the table by date and keeps the parts of each day's first play.
    """
    starts = next_song(events).select("ts")
    if grain == "day":
        moment = ms_to_timestamp("ts")
        firsts = starts.groupBy(moment.cast("date").alias("day_key")).agg(F.min("ts").alias("ts"))
        return firsts.select(F.col("day_key").alias("start_time"), *calendar_parts(moment, weekday_style))
    return _with_parts(starts.distinct().select(ms_to_timestamp("ts").alias("start_time")), weekday_style)


def time_all_events(events: DataFrame) -> DataFrame:
    """Calendar of every logged event, cut to the second, weekday padded to nine."""
    starts = events.select(ms_to_second("ts").alias("start_time")).distinct()
    return _with_parts(starts, "padded")


def time_from_songplays(
    songplays: DataFrame, distinct: bool = False, weekday_style: str = "number"
) -> DataFrame:
    """Calendar of the fact table's start times with weekday as number; repeats are kept unless ``distinct``."""
    starts = songplays.select("start_time")
    return _with_parts(starts.distinct() if distinct else starts, weekday_style)


def join_time(songplays: DataFrame, time: DataFrame, **skew) -> DataFrame:
    """Year and month by joining the time table, as an equivalent of deriving them from start_time."""
    parts = time.select(F.col("start_time").alias("_at"), "year", "month")
    return skew_join(songplays, parts, [("start_time", "_at")], "inner", right_unique=True, **skew).drop("_at")


def plays_at(songplays: DataFrame, time: DataFrame, when: Column | str, by: Sequence[str] = ("year", "month")) -> DataFrame:
    """Plays, stored in folders ``by`` calendar parts, at the moments of the time table that fulfil a condition, with their calendar.

    The folders that hold such moments are found first. They are no more than there are days, so they may be broadcast, and the scan
    of the plays skips all other folders while it runs.
    """
    wanted = time.where(when)
    inside = songplays.join(F.broadcast(wanted.select(*by).distinct()), list(by), "left_semi")
    parts = [c for c in ("hour", "day", "week", "month", "year", "weekday") if c not in by]
    moments = wanted.select(F.col("start_time").alias("_at"), *parts)
    return inside.join(moments, F.col("start_time") == F.col("_at")).drop("_at")

"""The batch run: stage, fact, dimensions, checks, over stored tables."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import date

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rondo.operators.layout import create_tables
from rondo.operators.quality import check_registry, require_non_empty
from rondo.operators.published import Parts, Published
from rondo.operators.sinks import append_rows, load_rows, write_partitioned, write_plain
from rondo.operators.upsert import upsert_update
from rondo.plans import star
from rondo.schemas import LOG, LOG_WITH_ID, PRIMARY_KEYS, SONG, STAR, TABLE_ORDER
from rondo.session import scratch_path, shuffle_tasks
from rondo.sources.files import read_partitioned, stage

Builder = Callable[[], DataFrame]

STAGING = {"staging_events": LOG_WITH_ID, "staging_songs": SONG}


def load_fact(build: Builder, table: str) -> None:
    """Build the fact rows and append them."""
    append_rows(build(), table)


def load_dimension(build: Builder, table: str, delete_load: bool = False) -> None:
    """Build a dimension and append it, or replace the table's rows when ``delete_load``."""
    load_rows(build(), table, delete_load)


def apply_to_all(df: DataFrame, *steps: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Run whole-table steps one after the other."""
    for step in steps:
        df = df.transform(step)
    return df


def run_pipeline(
    spark: SparkSession,
    log_path: str,
    song_path: str,
    namespace: str,
    location: str | None = None,
    day: date | None = None,
    day_pattern: str = "%Y/%m/%d",
) -> DataFrame:
    """Create tables, stage both inputs, load the fact table, then four dimensions, then check.

    The raw files are parsed once: staging is stored as parquet, and every later step reads only its columns.
    Returns the row-count report and raises if a table stays empty. ``namespace`` must exist.
    """
    create_tables(spark, namespace, STAGING, location)
    create_tables(spark, namespace, {t: STAR[t] for t in TABLE_ORDER}, location)

    def table(name: str) -> str:
        return f"{namespace}.{name}"

    load_dimension(
        lambda: stage(spark, log_path, LOG_WITH_ID, day=day, day_pattern=day_pattern),
        table("staging_events"),
        delete_load=True,
    )
    load_dimension(lambda: stage(spark, song_path, SONG), table("staging_songs"), delete_load=True)
    events, songs = spark.table(table("staging_events")), spark.table(table("staging_songs"))

    load_fact(lambda: star.songplays_left_md5(events, songs), table("songplays"))
    dimensions: dict[str, Builder] = {
        "users": lambda: star.users_distinct(events),
        "songs": lambda: star.songs_distinct(songs),
        "artists": lambda: star.artists_distinct(songs),
        "time": lambda: _time_as_text(star.time_from_songplays(spark.table(table("songplays")))),
    }
    for name, build in dimensions.items():
        load_dimension(build, table(name), delete_load=True)
    return require_non_empty({name: spark.table(table(name)) for name in TABLE_ORDER})


#: Buckets of the tables that are keyed by an id; plays and times are cut by day.
KEY_BUCKETS = 64


def keyed_store(spark: SparkSession, root: str, buckets: int = KEY_BUCKETS) -> Published:
    """The star tables that ``run_keyed`` publishes under a folder."""
    cut = {"users": "user_id", "songs": "song_id", "artists": "artist_id"}
    parts = {name: Parts((cut[name],), buckets) if name in cut else Parts(("start_time",)) for name in TABLE_ORDER}
    return Published(spark, root, {name: (STAR[name], parts[name]) for name in TABLE_ORDER})


def _expose(spark: SparkSession, namespace: str, store: Published) -> None:
    """A view of every published table in the catalogue."""
    manifest = store.manifest()
    for name, (schema, _) in store.tables.items():
        folders = [f for own in manifest["tables"].get(name, {}).values() for f in own]
        columns = ", ".join(f"CAST({f.name if folders else 'NULL'} AS {f.dataType.simpleString()}) AS {f.name}" for f in schema)
        source = f"parquet.`{store.root}/{{{','.join(folders)}}}`" if folders else "range(0)"
        spark.sql(f"CREATE OR REPLACE VIEW `{namespace}`.`{name}` AS SELECT {columns} FROM {source}")


def run_keyed(
    spark: SparkSession,
    log_path: str,
    song_path: str,
    namespace: str,
    location: str | None = None,
    day: date | None = None,
    day_pattern: str = "%Y/%m/%d",
) -> DataFrame:
    """Load the star tables by key, so that loading a day again changes nothing.

    Songs, artists, times and plays keep the first row of a key, stored ones before new ones; users keep their first
    row and take the level of the load's last play. A load reads and writes only the days and key buckets that its rows fall
    into, and publishes all tables at once under ``location`` (see ``rondo.operators.published``): one that dies leaves the
    former star whole. ``namespace`` gets a view of each table as it was published last.
    Returns the check report: row counts, repeated keys and nulls of every table, and orphans of the fact table.
    """
    create_tables(spark, namespace, STAGING, location)
    store = keyed_store(spark, location or f"{spark.catalog.getDatabase(namespace).locationUri}/published")

    def table(name: str) -> str:
        return f"{namespace}.{name}"

    load_dimension(
        lambda: stage(spark, log_path, LOG_WITH_ID, day=day, day_pattern=day_pattern), table("staging_events"), delete_load=True
    )
    load_dimension(lambda: stage(spark, song_path, SONG), table("staging_songs"), delete_load=True)
    load_keyed(store, spark.table(table("staging_events")), spark.table(table("staging_songs")))
    _expose(spark, namespace, store)
    return check_registry({name: store.read(name) for name in TABLE_ORDER})


def load_keyed(store: Published, events: DataFrame, songs: DataFrame) -> int:
    """Merge staged plays and songs into the published star; the number of the version that shows them."""
    load = store.begin()
    load.insert_ignore("songs", star.songs_dim(songs), PRIMARY_KEYS["songs"])
    load.insert_ignore("artists", star.artists_dim(songs), PRIMARY_KEYS["artists"])
    load.upsert("users", star.users_upsert(events), _newer_level)
    # The id is made of the columns of which the first play is kept, so it doesn't repeat.
    plays = star.songplays_lookup(events, songs, keep_first=["event_id"])
    fresh = load.insert_ignore("songplays", plays, PRIMARY_KEYS["songplays"])
    times = _time_as_text(star.time_from_songplays(fresh, distinct=True))
    load.insert_ignore("time", times, PRIMARY_KEYS["time"])
    return load.publish()


def _newer_level(stored: DataFrame, new: DataFrame) -> DataFrame:
    """Stored users with the new level, and the users that are new."""
    return upsert_update(new.withColumn("_at", F.lit(0)), ["user_id"], ["_at"], ["level"], stored)


def _time_as_text(time: DataFrame) -> DataFrame:
    return time.withColumn("weekday", time["weekday"].cast("string"))


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path is there, in whatever store Spark reads it from; nothing is read but its listing."""
    try:
        spark.read.format("binaryFile").load(path)
    except AnalysisException as missing:
        if "PATH_NOT_FOUND" in str(missing):
            return False
        raise
    return True


def run_lake(
    spark: SparkSession,
    log_path: str,
    song_path: str,
    out: str,
    songs_by: Sequence[str] = ("year",),
    mode: str = "errorifexists",
    match: str = "title",
) -> dict[str, str]:
    """Write the star schema as parquet folders and return their paths.

    Songs are partitioned by ``songs_by``, time and songplays by year and month. Unless ``mode`` is "overwrite", no
    target may exist, which is checked before anything is written. Both inputs are parsed once, into parquet
    under the shared scratch folder. Songplays are matched with the songs as written, by title alone, or by
    title and artist with ``match="artist"``, which doesn't multiply plays by songs of one title.
    """
    if mode not in ("errorifexists", "overwrite") or match not in ("title", "artist"):
        raise ValueError("mode must be 'errorifexists' or 'overwrite', match 'title' or 'artist'")
    paths = {name: f"{out.rstrip('/')}/{name}" for name in TABLE_ORDER}
    there = [name for name, path in paths.items() if mode != "overwrite" and path_exists(spark, path)]
    if there:
        raise FileExistsError(f"already written under {out}: {there}")
    parsed = scratch_path(spark, "parsed")
    write_plain(stage(spark, log_path, LOG, clean_text=False), f"{parsed}/log")
    write_plain(stage(spark, song_path, SONG, clean_text=False), f"{parsed}/songs")
    events, catalogue = spark.read.parquet(f"{parsed}/log"), spark.read.parquet(f"{parsed}/songs")

    tasks = shuffle_tasks(spark)
    write_partitioned(star.songs_distinct(catalogue), paths["songs"], songs_by, tasks=tasks)
    write_plain(star.artists_distinct(catalogue), paths["artists"], mode)
    write_plain(star.users_distinct(events), paths["users"], mode)
    time = star.time_nextsong(events, weekday_style="short")
    write_partitioned(time, paths["time"], ["year", "month"])
    songs = read_partitioned(spark, paths["songs"], schema=STAR["songs"])
    if match == "artist":
        # One name per artist, so that a play meets each song of its title and artist once.
        named = star.artists_dim(catalogue).select("artist_id", F.col("name").alias("artist_name"))
        plays = star.songplays_inner(events, songs.join(named, "artist_id"))
        plays = plays.withColumns({"year": F.year("start_time"), "month": F.month("start_time")})
        write_partitioned(plays, paths["songplays"], ["year", "month"])
    else:
        star.write_title_plays(events, songs, paths["songplays"])
    return paths

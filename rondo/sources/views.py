"""The two staging inputs, derived from the given parquet tables.

``staging_events`` turns the event stream into a play log and ``staging_songs`` turns the part list into a song
catalogue. Only the columns asked for are built, so a query that needs no user name joins no customer table and
one that needs no item number does no numbering.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rondo.functions.timeparts import minute_number, timestamp_to_ms
from rondo.operators.joins import skew_join
from rondo.operators.numbering import number_within
from rondo.schemas import LOG_WITH_ID

FROM_PART = {"artist", "song", "length"}
FROM_CUSTOMER = {"firstName", "lastName"}
FROM_NATION = {"location"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _title() -> Column:
    return F.concat(F.col("p_name"), F.lit(" "), (F.col("p_partkey") % 50).cast("string"))


def staging_events(spark: SparkSession, sf_dir: str, columns: Sequence[str] | None = None) -> DataFrame:
    """One row per event in the play log's shape, with ``event_id`` as tie-break."""
    wanted = list(columns) if columns is not None else LOG_WITH_ID.names
    need = set(wanted)
    events = table(spark, sf_dir, "events").select(
        "event_id",
        F.col("ts").alias("_ts"),
        F.col("user_id").alias("_user"),
        F.when(F.col("event_type").isin("view", "purchase"), "NextSong")
        .when(F.col("event_type") == "click", "Home")
        .when(F.col("event_type") == "signup", "Login")
        .otherwise("Logout")
        .alias("page"),
    )
    if "itemInSession" in need:
        keyed = events.withColumns(
            {
                "_owner": F.coalesce(F.col("_user"), F.lit(-1)),
                "_day": F.coalesce(F.dayofyear("_ts"), F.lit(0)),
            }
        )
        slot = F.coalesce(F.floor(minute_number("_ts") / 60), F.lit(-(1 << 40)))
        events = number_within(keyed, ["_owner", "_day"], slot, ["_ts", "event_id"], "itemInSession")
    if need & FROM_PART:
        part = table(spark, sf_dir, "part")
        size = part.agg(F.count(F.lit(1)).alias("n")).scalar()
        catalogue = part.select(
            F.col("p_partkey"), F.col("p_brand"), _title().alias("_title"), F.col("p_retailprice")
        )
        # The key is spread evenly by construction, so a plain equi-join has no hot spots.
        events = events.withColumn("_part", F.col("event_id") % size).join(
            catalogue, F.col("_part") == F.col("p_partkey"), "left"
        )
    if need & (FROM_CUSTOMER | FROM_NATION):
        customer = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment", "c_nationkey")
        events = skew_join(events, customer, [("_user", "c_custkey")], "left", right_unique=True)
    if need & FROM_NATION:
        nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
        events = skew_join(events, nation, [("c_nationkey", "n_nationkey")], "left", right_unique=True)

    is_play = F.col("page") == "NextSong"
    logged_out = F.col("event_id") % 97 == 0
    price = F.col("p_retailprice")
    build = {
        "event_id": lambda: F.col("event_id"),
        "page": lambda: F.col("page"),
        "artist": lambda: F.when(is_play, F.col("p_brand")),
        "song": lambda: F.when(is_play, F.col("_title")),
        "length": lambda: F.when(
            is_play, F.when(F.col("event_id") % 5 == 0, price + 0.75).otherwise(price + 0.25)
        ),
        "auth": lambda: F.when(logged_out, "Logged Out").otherwise("Logged In"),
        "userId": lambda: F.when(logged_out, "").otherwise(F.col("_user").cast("string")),
        "firstName": lambda: F.col("c_name"),
        "lastName": lambda: F.col("c_mktsegment"),
        "gender": lambda: F.when(F.col("_user") % 2 == 0, "F").otherwise("M"),
        "level": lambda: F.when(F.dayofmonth("_ts") % 2 == 0, "paid").otherwise("free"),
        "location": lambda: F.col("n_name"),
        "sessionId": lambda: F.col("_user") * 1000 + F.dayofyear("_ts"),
        "itemInSession": lambda: F.col("itemInSession"),
        "method": lambda: F.when(is_play, "PUT").otherwise("GET"),
        "status": lambda: F.lit(200).cast("long"),
        "registration": lambda: (F.col("_user") + 1540000000000).cast("double"),
        "userAgent": lambda: F.concat(F.lit("agent/"), (F.col("_user") % 5).cast("string")),
        "ts": lambda: timestamp_to_ms("_ts"),
    }
    return events.select(*[build[c]().alias(c) for c in wanted])


def staging_songs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every part as a song, every seventh once more unchanged, every tenth re-released a year later."""
    key = F.col("p_partkey")
    copies = F.array_compact(
        F.array(F.lit("SO"), F.when(key % 7 == 0, F.lit("SO")), F.when(key % 10 == 0, F.lit("SR")))
    )
    parts = table(spark, sf_dir, "part").withColumn("_prefix", F.explode(copies))
    known = F.col("p_size") % 2 != 0
    year = F.when(F.col("p_size") % 4 == 0, 0).otherwise(F.col("p_size") + 1970)
    return parts.select(
        F.lit(1).alias("num_songs"),
        F.concat(F.lit("AR"), F.col("p_brand")).alias("artist_id"),
        F.when(known, F.col("p_size") * 1.5).alias("artist_latitude"),
        F.when(known, F.col("p_size") * -2.5).alias("artist_longitude"),
        F.when(key % 3 == 0, "").otherwise(F.col("p_type")).alias("artist_location"),
        F.col("p_brand").alias("artist_name"),
        F.concat(F.col("_prefix"), key.cast("string")).alias("song_id"),
        _title().alias("title"),
        (F.col("p_retailprice") + 0.25).alias("duration"),
        (year + F.when(F.col("_prefix") == "SR", 1).otherwise(0)).cast("int").alias("year"),
    )

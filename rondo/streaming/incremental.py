"""Incremental load of the play log: new files go through the batch operators, one micro-batch at a time.

A batch becomes one published version of plays, users and rejects (``rondo.operators.published``), with its number in the
manifest, so readers see a batch whole or not at all. ``foreachBatch`` may repeat a batch after a failure; every step gives the same
outcome when repeated: plays are kept first, states of users merge by their order marks whatever the sequence, and the rejects of a
batch replace those of its former try. A batch whose number doesn't follow the published one stops.

What a batch reads and writes follows its own rows, not what is stored. Plays are compared with the stored plays of the same
days. The states of the users in the batch are appended in key buckets, and merged with the earlier ones when they are read; a
bucket of many appended folders is written as one now and then.

Lines that are no JSON object, and plays without a readable time, are stored as rejects with a reason and counted. Plays that
arrive more than ``late_days`` behind the newest are loaded like all others and counted as late.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from rondo.functions.clean import blank_to_null, to_int
from rondo.functions.keys import natural_key
from rondo.functions.timeparts import ms_to_timestamp
from rondo.operators.published import Load, Parts, Published
from rondo.operators.reduce import first_per_key
from rondo.operators.upsert import key_state, one_state
from rondo.plans.star import lookup_first_match, next_song, time_from_songplays
from rondo.schemas import LOG_WITH_ID, STAR, shape

ORDER = ["ts", "event_id"]
KEEP = ["first_name", "last_name", "gender"]
UPDATE = ["level"]


def _users(plays: DataFrame) -> DataFrame:
    rows = plays.select(
        to_int("userId").alias("user_id"),
        F.col("firstName").alias("first_name"),
        F.col("lastName").alias("last_name"),
        "gender",
        "level",
        *ORDER,
    ).filter(F.col("user_id").isNotNull())
    return key_state(rows, ["user_id"], ORDER, KEEP, UPDATE)


def _merged(states: DataFrame) -> DataFrame:
    """One state a user."""
    return one_state(states, ["user_id"], KEEP, UPDATE)


def _plays(plays: DataFrame, songs: DataFrame | None) -> DataFrame:
    if songs is None:
        nothing = F.lit(None).cast("string")
        matched = plays.withColumns({"song_id": nothing, "artist_id": nothing})
    else:
        matched = lookup_first_match(plays, songs)
    start = ms_to_timestamp("ts")
    return matched.select(
        natural_key(F.col("sessionId"), F.col("itemInSession"), F.col("ts")).alias("songplay_id"),
        start.alias("start_time"),
        to_int("userId").alias("user_id"),
        "level",
        "song_id",
        "artist_id",
        F.col("sessionId").alias("session_id"),
        "location",
        F.col("userAgent").alias("user_agent"),
        *ORDER,
    )


CORRUPT = "_corrupt_record"
REASON = "_reason"
BATCH = "batch_id"
#: Buckets of the users' states.
USER_BUCKETS = 64
_MARKS = shape("ts long, event_id long")
_STATE = StructType(
    [
        *shape("user_id int, first_name string, last_name string, gender string, level string"),
        StructField("first_at", _MARKS),
        StructField("last_at", _MARKS),
    ]
)
#: Batches whose rejects are stored together.
REJECT_BATCHES = 1000
_PLAY = StructType([*STAR["songplays"], *_MARKS])


class IncrementalLoad:
    """Songplays (keep-first) and users (level of the last play) kept under ``target``.

    Plays are matched with ``songs``, the staged catalogue as it is when they are loaded. ``schema`` is the log's.
    """

    def __init__(
        self,
        spark: SparkSession,
        target: str,
        songs: DataFrame | None = None,
        schema: StructType = LOG_WITH_ID,
        late_days: int = 1,
    ):
        self.spark, self.target, self.songs, self.late_days = spark, target.rstrip("/"), songs, late_days
        self._set_schema(schema)

    def _set_schema(self, schema: StructType) -> None:
        self.schema = StructType([*schema, StructField(CORRUPT, StringType())])
        rejects = StructType([*self.schema, StructField(REASON, StringType()), StructField(BATCH, LongType())])
        shapes = {
            "songplays": (_PLAY, Parts(("start_time",))),
            "users": (_STATE, Parts(("user_id",), USER_BUCKETS)),
            "rejects": (rejects, Parts((BATCH,), step=REJECT_BATCHES)),
        }
        self.store = Published(self.spark, self.target, shapes)

    def apply(self, batch: DataFrame, batch_id: int) -> None:
        """Load one micro-batch.

        Its rows are first stored, so the raw files are parsed once and each later step reads its own columns.
        """
        load = self.store.begin()
        done = load.before["marks"].get("batch")
        if done is not None and batch_id < done:
            raise RuntimeError(f"batch {batch_id} comes after batch {done}: numbers start again; restore {self.target}/_progress")
        if batch_id > (0 if done is None else done + 1):
            raise RuntimeError(f"batch {batch_id} follows batch {done}; restore {self.target}/published")
        if CORRUPT not in batch.columns:
            batch = batch.withColumn(CORRUPT, F.lit(None).cast("string"))
        no_time = (F.col("page") == "NextSong") & F.col("ts").isNull()
        reason = F.when(F.col(CORRUPT).isNotNull(), "malformed line").when(no_time, "no time of play")
        parsed = blank_to_null(batch.select(*self.schema.names)).withColumn(REASON, reason)
        staged = f"{self.target}/_staged/slot={batch_id % 2}"
        parsed.write.mode("overwrite").parquet(staged)
        rows = self.spark.read.schema(parsed.schema).parquet(staged)

        rejects = rows.where(f"{REASON} IS NOT NULL").withColumn(BATCH, F.lit(batch_id).cast("long"))
        if batch_id == done:
            load.upsert("rejects", rejects, lambda old, new: old.where(F.col(BATCH) != batch_id).unionByName(new))
        else:
            load.append("rejects", rejects)
        plays = next_song(rows.where(f"{REASON} IS NULL").drop(CORRUPT, REASON))
        # Nothing stored is read for the users; that it is still there is seen from the listing.
        self.store.read("users", manifest=load.before)
        load.append("users", _users(plays), _merged)
        first = first_per_key(_plays(plays, self.songs), ["songplay_id"], ORDER)
        self._count_late(load, load.insert_ignore("songplays", first, ["songplay_id"]))
        load.mark("batch", batch_id)
        load.publish()

    def _count_late(self, load: Load, fresh: DataFrame) -> None:
        """Count new plays that are more than ``late_days`` behind the newest of the batches before."""
        before = load.before["marks"]
        newest = before.get("newest")
        behind = F.lit(False) if newest is None else F.col("ts") < newest - self.late_days * 86_400_000
        late, last = fresh.agg(F.count_if(behind), F.max("ts")).first()
        load.mark("late", before.get("late", 0) + late)
        if last is not None:
            load.mark("newest", max(last, newest or last))

    def run(self, log_path: str, schema: StructType | None = None, files_per_batch: int = 1000) -> None:
        """Load every file not yet loaded, then stop."""
        if schema is not None:
            self._set_schema(schema)
        stream = (
            self.spark.readStream.schema(self.schema)
            .option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", CORRUPT)
            .option("maxFilesPerTrigger", files_per_batch)
            .option("recursiveFileLookup", "true")
            .json(log_path)
        )
        query = (
            stream.writeStream.foreachBatch(self.apply)
            .option("checkpointLocation", f"{self.target}/_progress")
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()

    def users(self) -> DataFrame:
        """The users table as of the last completed batch."""
        return _merged(self.store.read("users")).select("user_id", *KEEP, *UPDATE)

    def rejects(self) -> DataFrame:
        """Input not loaded, one row per line or play, with the reason and the number of its batch."""
        return self.store.read("rejects")

    def late(self) -> int:
        """Plays loaded so far that came late."""
        return self.store.manifest()["marks"].get("late", 0)

    def songplays(self) -> DataFrame:
        """All plays loaded so far."""
        return self.store.read("songplays").select(*STAR["songplays"].names)

    def time(self) -> DataFrame:
        """Calendar of the plays loaded so far."""
        return time_from_songplays(self.songplays(), distinct=True, weekday_style="full")

"""Sharding by fixed virtual slots.

Every record is hashed into one of thousands of virtual slots, once and for all. Bytes are summed per slot, and a versioned
map, a stored table (version, slot, shard, bytes, rows), gives each slot its shard. The first version deals the slots out, largest
first, each to the shard with the fewest bytes. Rebalancing edits the map: it writes a next version in which only as many
slots move as balance asks for, so records of all other slots stay where they are. The law kept is ``bytes``: shards have
near equal sizes.

The map has a row per slot, a fixed number, so it may pass through the driver and be broadcast. Records are numbered inside
their slots, and slots get offsets in their shard, so no task sees a whole shard.

Defined cases: a null text has no bytes and the checksum of an empty one. Null and repeated ids are hashed together with
the checksum of the text; rows repeated in full share a slot and are numbered in any order. Extra columns are ignored.
An empty table gives an empty result.
"""

from __future__ import annotations

import json
from heapq import heapify, heapreplace

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rondo.llm.store import stored

SLOTS = 4096
#: Bytes a record needs beyond its text.
EXTRA = 8


def records(docs: DataFrame, slots: int = SLOTS, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """doc_id, size, text_crc32 and virtual slot of every record, stored."""
    known = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(
        F.col(doc_id).alias("doc_id"),
        (F.octet_length(known) + EXTRA).cast("long").alias("size"),
        F.crc32(known.cast("binary")).alias("text_crc32"),
    )
    slot = F.pmod(F.xxhash64("doc_id", "text_crc32"), F.lit(slots)).cast("int")
    return stored(rows.withColumn("virtual_slot", slot), "records")


def slot_sizes(rows: DataFrame) -> list[tuple[int, int, int]]:
    """(slot, bytes, rows) of each used slot, by slot."""
    sums = rows.groupBy("virtual_slot").agg(F.sum("size"), F.count(F.lit(1)))
    return sorted((r[0], r[1], r[2]) for r in sums.collect())


def assign(sizes: list[tuple[int, int, int]], shards: int) -> dict[int, int]:
    """The first map: the largest slot left goes to the shard with the fewest bytes."""
    loads = [(0, shard) for shard in range(shards)]
    heapify(loads)
    out = {}
    for slot, size, _ in sorted(sizes, key=lambda s: (-s[1], s[0])):
        load, shard = loads[0]
        out[slot] = shard
        heapreplace(loads, (load + size, shard))
    return out


def rebalance(sizes: list[tuple[int, int, int]], old: dict[int, int], shards: int, close: float = 0.01) -> dict[int, int]:
    """The next map: new slots go to the emptiest shard, then slots move from the fullest to the emptiest.

    They do until the fullest shard is within the share ``close`` of the mean, or no move helps.
    """
    out, loads = {}, [0] * shards
    size_of = {slot: size for slot, size, _ in sizes}
    for slot, size, _ in sizes:
        if old.get(slot, shards) < shards:
            out[slot] = old[slot]
            loads[old[slot]] += size
    for slot, size, _ in sorted(sizes, key=lambda s: -s[1]):
        if slot not in out:
            out[slot] = min(range(shards), key=loads.__getitem__)
            loads[out[slot]] += size
    held: list[set[int]] = [set() for _ in range(shards)]
    for slot, shard in out.items():
        held[shard].add(slot)
    for _ in range(len(out)):
        full, empty = (f(range(shards), key=loads.__getitem__) for f in (max, min))
        if loads[full] * shards <= (1 + close) * sum(loads):
            break
        gap = loads[full] - loads[empty]
        fitting = [s for s in held[full] if 0 < size_of[s] < gap]
        if not fitting:
            break
        slot = min(fitting, key=lambda s: (abs(gap - 2 * size_of[s]), s))
        held[full].remove(slot)
        held[empty].add(slot)
        out[slot] = empty
        loads[full] -= size_of[slot]
        loads[empty] += size_of[slot]
    return out


def slot_map(spark: SparkSession, sizes: list[tuple[int, int, int]], shard_of: dict[int, int], version: int) -> DataFrame:
    """One version of the map as a stored table: version, slot, shard, bytes, rows."""
    rows = [{"slot": slot, "shard": shard_of[slot], "bytes": size, "rows": n} for slot, size, n in sizes]
    kind = "array<struct<slot:int,shard:int,bytes:bigint,rows:bigint>>"
    given = F.explode(F.from_json(F.lit(json.dumps(rows)), kind)).alias("_s")
    return stored(spark.range(1).select(F.lit(version).alias("version"), given).select("version", "_s.*"), f"slot-map-{version}")


def place(rows: DataFrame, mapped: DataFrame) -> DataFrame:
    """Each record's shard and its place there, without gaps from 0, by one version of the map."""
    before = Window.partitionBy("shard").orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    offsets = mapped.select(
        F.col("slot").alias("virtual_slot"),
        "shard",
        F.col("version").alias("map_version"),
        F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("_before"),
    )
    inside = Window.partitionBy("virtual_slot").orderBy("doc_id", "text_crc32", "size")
    numbered = rows.withColumn("_n", F.row_number().over(inside) - 1).join(F.broadcast(offsets), "virtual_slot")
    return numbered.withColumn("slot", F.col("_before") + F.col("_n")).drop("_n", "_before")


def shard(docs: DataFrame, shards: int = 24, slots: int = SLOTS, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One row per record: doc_id, size, text_crc32, law, shard, slot (place in its shard), grown_shard, virtual_slot, map_version."""
    rows = records(docs, slots, text, doc_id)
    sizes = slot_sizes(rows)
    placed = place(rows, slot_map(docs.sparkSession, sizes, assign(sizes, shards), 1))
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
        "virtual_slot",
        "map_version",
    )

"""Row numbers that do not need one task to see a whole group.

``number_within`` cuts groups into slots of time: rows are numbered inside a slot, and the counts of the
earlier slots, made with map-side combine, are added. A window over a group therefore runs over its slots, whose number
is bounded by the calendar, while a hot group's rows stay spread over as many tasks as it has slots.

``identity_ids`` numbers a whole table: a count that sets the number of ranges, so that none outgrows a task, one range shuffle, one write to the shared scratch folder so that the
placement of rows is fixed even when executors are lost, and one offset per partition.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rondo.session import scratch_path, shuffle_tasks

#: Rows of one range, which a task sorts.
ROWS_PER_RANGE = 2_000_000


def number_within(df: DataFrame, group: Sequence[str], slot: Column, order: Sequence[str], name: str) -> DataFrame:
    """Zero-based number of each row in its group by ``order``.

    ``slot`` is a whole number that must rise with ``order``; neither it nor the group columns may be null.
    """
    marked = df.withColumn("_slot", slot)
    counts = marked.groupBy(*group, "_slot").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*group).orderBy("_slot").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(*group, "_slot", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    inside = Window.partitionBy(*group, "_slot").orderBy(*order)
    numbered = marked.withColumn("_pos", F.row_number().over(inside) - 1)
    joined = numbered.join(offsets, [*group, "_slot"])
    return joined.select(*df.columns, (F.col("_before") + F.col("_pos")).alias(name))


def identity_ids(df: DataFrame, order: Sequence[str], name: str, start: int = 0) -> DataFrame:
    """Consecutive ids by ``order``, which must be total for the ids to be reproducible."""
    path = scratch_path(df.sparkSession, "identity")
    ranges = -(-df.count() // ROWS_PER_RANGE)
    many = [max(ranges, shuffle_tasks(df.sparkSession))] if ranges > 1 else []
    placed = (
        df.repartitionByRange(*many, *order)
        .sortWithinPartitions(*order)
        .withColumn("_part", F.spark_partition_id())
        .withColumn("_pos", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)))
    )
    placed.write.parquet(path)
    stored = df.sparkSession.read.parquet(path)
    # One row per written partition: spark.sql.shuffle.partitions, or a row for ROWS_PER_RANGE of the table's.
    sizes = stored.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    return stored.join(F.broadcast(offsets), "_part").select(
        (F.col("_before") + F.col("_pos") + F.lit(start)).alias(name), *df.columns
    )

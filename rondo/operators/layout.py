"""Namespaces, tables and physical layout.

``write_bucketed`` stores a table so that rows of equal keys lie in the same bucket of every table stored with as many buckets
by that key; ``co_located_join`` then joins bucket by bucket, without moving a row. A bucket is one task of the join, so keys with more
rows than a task should take are named when a table is written or joined: their rows are spread over several files of their
bucket, and joined where they lie with the few rows of those keys on the other side.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from rondo.schemas import STAR, TABLE_ORDER


def create_namespace(spark: SparkSession, name: str, location: str | None = None, use: bool = False) -> None:
    """Create a database if absent and optionally make it current."""
    place = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}`{place}")
    if use:
        spark.sql(f"USE `{name}`")


def drop_namespace(spark: SparkSession, name: str) -> None:
    """Drop a database with all its tables."""
    spark.sql(f"DROP DATABASE IF EXISTS `{name}` CASCADE")


def create_tables(
    spark: SparkSession,
    namespace: str,
    tables: Mapping[str, StructType] | None = None,
    location: str | None = None,
) -> list[str]:
    """Create the tables, parents first, and return their qualified names.

    With ``location`` they are external, so dropping them leaves the files.
    """
    shapes = tables if tables is not None else {name: STAR[name] for name in TABLE_ORDER}
    made = []
    for name, schema in shapes.items():
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
        place = f" LOCATION '{location}/{name}'" if location else ""
        spark.sql(f"CREATE TABLE IF NOT EXISTS `{namespace}`.`{name}` ({columns}) USING parquet{place}")
        made.append(f"{namespace}.{name}")
    return made


def drop_tables(spark: SparkSession, namespace: str, names: Iterable[str] | None = None) -> None:
    """Drop the tables, children first."""
    for name in names if names is not None else reversed(TABLE_ORDER):
        spark.sql(f"DROP TABLE IF EXISTS `{namespace}`.`{name}`")


def cluster_rows(df: DataFrame, partition_key: Sequence[str], clustering_key: Sequence[str] = ()) -> DataFrame:
    """Range-partition and sort by partition key, then clustering key.

    Range bounds use both keys, so a hot partition key spans several tasks and files, and the narrow min/max of
    each file lets a lookup by key skip the rest.
    """
    keys = [*partition_key, *clustering_key]
    return df.repartitionByRange(*keys).sortWithinPartitions(*keys)


def write_bucketed(
    df: DataFrame,
    table: str,
    by: Sequence[str],
    buckets: int,
    sort: Sequence[str] = (),
    location: str | None = None,
    hot: DataFrame | None = None,
) -> None:
    """Store ``df`` as a new table in hash buckets of ``by``, sorted inside a file by ``sort``.

    Rows are gathered by bucket first, so a bucket is one file. ``hot``, a list from ``hot_keys``, cuts the rows of those
    keys into slices by row content, each a file of its own.
    """
    bucket = F.pmod(F.hash(*by), F.lit(buckets))
    if hot is None:
        placed = df.repartition(buckets, bucket)
    else:
        cut = hot.select(*[F.col(k).alias(f"_hot_{k}") for k in by], "_slices")
        same = [F.col(k).eqNullSafe(F.col(f"_hot_{k}")) for k in by]
        marked = df.join(F.broadcast(cut), same, "left")
        part = F.coalesce(F.pmod(F.xxhash64(*df.columns), F.col("_slices").cast("long")), F.lit(0).cast("long"))
        placed = marked.repartition(buckets, bucket, part).select(*df.columns)
    writer = placed.write.format("parquet").bucketBy(buckets, *by)
    if sort:
        writer = writer.sortBy(*sort)
    if location:
        writer = writer.option("path", location)
    writer.saveAsTable(table)


def _has_null(columns: Sequence[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.col(c).isNull() for c in columns])


def co_located_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[tuple[str, str]],
    how: str = "inner",
    hot: DataFrame | None = None,
    right_unique: bool = False,
) -> DataFrame:
    """Inner or left equi-join of two tables in equally many buckets of the paired columns; neither is shuffled.

    The columns' names must differ. Null keys match nothing and don't meet in a bucket. ``hot``, a list from ``hot_keys`` under the
    left names, is joined by broadcast, which takes ``right_unique``: that no key repeats on the right, so that no more rows
    than the list has keys are broadcast.
    """
    if how not in ("inner", "left"):
        raise ValueError("how must be 'inner' or 'left'")
    if hot is not None and not right_unique:
        raise ValueError("hot keys are broadcast: the right side must be unique")
    lkeys, rkeys = [a for a, _ in on], [b for _, b in on]
    match = [F.col(a) == F.col(b) for a, b in on]
    keyed = left.where(~_has_null(lkeys))
    parts = []
    if hot is not None:
        listed = F.broadcast(hot.select(*[F.col(k).alias(f"_hot_{k}") for k in lkeys]))
        of_left = [F.col(k) == F.col(f"_hot_{k}") for k in lkeys]
        few = right.join(listed, [F.col(b) == F.col(f"_hot_{a}") for a, b in on], "left_semi")
        parts.append(keyed.join(listed, of_left, "left_semi").join(F.broadcast(few), match, how))
        keyed = keyed.join(listed, of_left, "left_anti")
    parts.append(keyed.join(right.hint("merge"), match, how))
    if how == "left":
        nothing = [F.lit(None).cast(f.dataType).alias(f.name) for f in right.schema.fields]
        parts.append(left.where(_has_null(lkeys)).select("*", *nothing))
    return reduce(DataFrame.unionByName, parts)

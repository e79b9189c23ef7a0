"""Versions of several tables, published together, of which a load writes only the parts it changes.

A table is cut into parts by a column of its rows (a day) or a hash bucket of its key. Every load writes the parts it adds to or
replaces into a folder of its own; nothing stored is touched. Last it publishes one small manifest, which names the folders of
every part of every table. Readers resolve the latest manifest, so they see all tables of a load or none of them: a load that dies
before its manifest leaves the former version whole, and its folders are never read.

A manifest is one line of JSON in a folder named by its number. Writing a number that is there already fails, so of two
loads at once only one publishes. Its size follows the number of parts (buckets, days), not of rows; parts made of more than
``MOST_FOLDERS`` folders are written anew by the load that adds to them.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from rondo.operators.numbering import identity_ids
from rondo.operators.upsert import without_keys
from rondo.session import scratch_path

#: Folders a part may consist of before it is written as one.
MOST_FOLDERS = 20
PART = "_part"


@dataclass(frozen=True)
class Parts:
    """How a table is cut: by a hash of columns into ``buckets``, by every ``step`` of a number, else by the day of a column."""

    columns: tuple[str, ...]
    buckets: int = 0
    step: int = 0

    def column(self) -> Column:
        if self.buckets:
            return F.pmod(F.xxhash64(*self.columns), F.lit(self.buckets)).cast("string")
        if self.step:
            return F.coalesce(F.floor(F.col(self.columns[0]) / self.step).cast("string"), F.lit("none"))
        return F.coalesce(F.col(self.columns[0]).cast("date").cast("string"), F.lit("none"))


def _missing(error: AnalysisException) -> bool:
    return "PATH_NOT_FOUND" in str(error) or "UNABLE_TO_INFER_SCHEMA" in str(error)


class Published:
    """The tables under ``root``: name, schema and parts of each are given, their contents come from the latest manifest."""

    def __init__(self, spark: SparkSession, root: str, tables: Mapping[str, tuple[StructType, Parts]]):
        self.spark, self.root, self.tables = spark, root.rstrip("/"), dict(tables)

    def manifest(self, version: int | None = None) -> dict:
        """The latest published manifest, or that of one version; an empty one if nothing is published."""
        try:
            found = self.spark.read.schema("value string, version long").text(f"{self.root}/published")
            if version is not None:
                found = found.where(F.col("version") == version)
            latest = found.agg(F.max_by("value", "version")).first()[0]
        except AnalysisException as error:
            if not _missing(error):
                raise
            latest = None
        return json.loads(latest) if latest else {"version": 0, "tables": {}, "marks": {}}

    def read(self, name: str, parts: list[str] | None = None, manifest: dict | None = None) -> DataFrame:
        """A table as published, or some parts of it; files of other parts are not listed."""
        schema = self.tables[name][0]
        stored = (manifest or self.manifest())["tables"].get(name, {})
        folders = [f"{self.root}/{f}" for part, own in stored.items() if parts is None or part in parts for f in own]
        if not folders:
            return self.spark.createDataFrame([], schema)
        try:
            return self.spark.read.schema(schema).parquet(*folders)
        except AnalysisException as error:
            if not _missing(error):
                raise
            raise RuntimeError(f"stored parts of {name} are gone; restore {self.root}/{name}") from error

    def begin(self) -> Load:
        """A load on top of the latest version."""
        return Load(self, self.manifest())


class Load:
    """Changes to tables, invisible until ``publish``. Each table is changed once in a load."""

    def __init__(self, store: Published, before: dict):
        self.store, self.before = store, before
        self.after = json.loads(json.dumps(before))
        self.after["version"] += 1
        self.folder = f"load-{uuid.uuid4().hex}"
        self.changed: set[str] = set()

    def _stored(self, name: str) -> dict[str, list[str]]:
        return self.before["tables"].get(name, {})

    def _settled(self, df: DataFrame) -> DataFrame:
        path = scratch_path(self.store.spark, "settled")
        df.write.parquet(path)
        return self.store.spark.read.schema(df.schema).parquet(path)

    def _write(self, name: str, rows: DataFrame, parts: list[str]) -> dict[str, str]:
        """Store rows of the given parts; the folders written, by part. Without parts there are no rows."""
        path = f"{self.store.root}/{name}/{self.folder}"
        if parts:
            rows.hint("rebalance", PART).write.partitionBy(PART).parquet(path)
        # The folder of a part is found by its name, as the writer made it.
        return {part: f"{name}/{self.folder}/{PART}={part}" for part in parts}

    def _set(self, name: str, parts: Mapping[str, list[str]]) -> None:
        self.after["tables"][name] = {**self._stored(name), **parts}

    def _taken(self, name: str, rows: DataFrame) -> DataFrame:
        """Rows given to change a table, cut into parts and stored."""
        if name in self.changed:
            raise ValueError(f"{name} is changed twice in one load")
        self.changed.add(name)
        return self._settled(self._cut(name, rows))

    def _cut(self, name: str, rows: DataFrame) -> DataFrame:
        schema, parts = self.store.tables[name]
        return rows.select(*schema.names).withColumn(PART, parts.column())

    def _touched(self, rows: DataFrame) -> list[str]:
        """The parts that stored rows fall into: names, few enough for the driver."""
        return [r[0] for r in rows.select(PART).distinct().collect()]

    def read(self, name: str) -> DataFrame:
        """A table as this load leaves it."""
        return self.store.read(name, manifest=self.after)

    def replace(self, name: str, rows: DataFrame) -> None:
        """All rows of the table."""
        settled = self._taken(name, rows)
        written = self._write(name, settled, self._touched(settled))
        self.after["tables"][name] = {part: [folder] for part, folder in written.items()}

    def append(self, name: str, rows: DataFrame, fold: Callable[[DataFrame], DataFrame] | None = None) -> None:
        """Rows added to the parts they fall into.

        A part of too many folders is written as one, and ``fold`` then reduces its rows, as by merging the states of a key.
        """
        settled = self._taken(name, rows)
        self._append(name, settled, self._touched(settled), fold)

    def _append(self, name: str, settled: DataFrame, parts: list[str], fold: Callable[[DataFrame], DataFrame] | None = None) -> None:
        stored = self._stored(name)
        full = [p for p in parts if len(stored.get(p, [])) >= MOST_FOLDERS]
        if full:
            whole = settled.where(F.col(PART).isin(full)).unionByName(self._cut(name, self.store.read(name, full, self.before)))
            if fold is not None:
                whole = self._cut(name, fold(whole.drop(PART)))
            settled = settled.where(~F.col(PART).isin(full)).unionByName(whole)
            parts = self._touched(settled)
        written = self._write(name, settled, parts)
        self._set(name, {p: [f] if p in full else [*stored.get(p, []), f] for p, f in written.items()})

    def append_numbered(self, name: str, rows: DataFrame, order: list[str], column: str) -> None:
        """Rows added with consecutive numbers by ``order`` in ``column``, going on from the table's last published number.

        The next free number is published with the rows, so a load that dies has used none and a repeated one takes the same.
        """
        mark = f"{name}.{column}"
        start = self.before["marks"].get(mark, 0)
        numbered = self._taken(name, identity_ids(rows, order, column, start))
        self.mark(mark, start + numbered.count())
        self._append(name, numbered, self._touched(numbered))

    def insert_ignore(self, name: str, first: DataFrame, keys: list[str]) -> DataFrame:
        """Add the rows whose key isn't stored; ``first`` has one row a key, and a key's rows always fall into one part.

        Only the parts that the new rows fall into are read; where nothing is stored in them, all rows are new. Returns the rows
        added.
        """
        fresh = self._taken(name, first)
        parts = self._touched(fresh)
        known = [p for p in parts if self._stored(name).get(p)]
        if known:
            fresh = self._settled(without_keys(fresh, self.store.read(name, known, self.before), keys))
            parts = self._touched(fresh)
        self._append(name, fresh, parts)
        return fresh.drop(PART)

    def upsert(self, name: str, new: DataFrame, merge: Callable[[DataFrame, DataFrame], DataFrame]) -> None:
        """Merge new rows into the parts they fall into; other parts, and parts that don't change, keep their files.

        ``merge`` gets stored and new rows of those parts and returns all rows they hold afterwards.
        """
        schema = self.store.tables[name][0]
        settled = self._taken(name, new)
        touched = self._touched(settled)
        old = self.store.read(name, touched, self.before)
        merged = self._settled(self._cut(name, merge(old, settled.drop(PART))))
        # A row that is only on one side, counted with its repeats, makes a part a changed one.
        sides = self._cut(name, old).withColumn("_side", F.lit(-1)).unionByName(merged.withColumn("_side", F.lit(1)))
        differ = sides.groupBy(PART, *schema.names).agg(F.sum("_side").alias("_n")).where("_n != 0")
        changed = [r[0] for r in differ.select(PART).distinct().collect()]
        if changed:
            rows = merged.where(F.col(PART).isin(changed))
            written = self._write(name, rows, self._touched(rows))
            self._set(name, {p: [written[p]] if p in written else [] for p in changed})

    def mark(self, name: str, value: int) -> None:
        """A number published with the tables, as that of a batch."""
        self.after["marks"][name] = value

    def publish(self) -> int:
        """Make all changes of the load visible at once; the new version's number."""
        line = self.store.spark.range(1).select(F.lit(json.dumps(self.after)).alias("value"))
        line.coalesce(1).write.text(f"{self.store.root}/published/version={self.after['version']}")
        return self.after["version"]

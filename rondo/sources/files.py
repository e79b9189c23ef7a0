"""Readers for logs, catalogues, event CSV, partitioned parquet and stored tables.

Schemas are always given, so no reader makes a first pass over the data; inference is an option.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from rondo.functions.clean import blank_to_null, truncate_text
from rondo.schemas import DENORMALISED, EVENT_CSV, LOG, SONG

Paths = str | Sequence[str]

# Quoting of the event CSV files: doubled quotes inside a quoted field. A malformed record stops the read.
CSV_QUOTING = {"header": "true", "quote": '"', "escape": '"', "encoding": "UTF-8", "mode": "FAILFAST"}


def read_json(
    spark: SparkSession,
    path: Paths,
    schema: StructType | None,
    recursive: bool = False,
    file_glob: str | None = None,
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """JSON lines under one or more paths; paths may hold wildcards. ``schema=None`` infers.

    A line that is no JSON object stops the read; pass another ``mode`` in ``options`` to be lenient.
    """
    reader = spark.read.options(**{"mode": "FAILFAST", **dict(options or {})})
    if schema is not None:
        reader = reader.schema(schema)
    if recursive:
        reader = reader.option("recursiveFileLookup", "true")
    if file_glob:
        reader = reader.option("pathGlobFilter", file_glob)
    return reader.json(path if isinstance(path, str) else list(path))


def read_log(spark: SparkSession, path: Paths, infer: bool = False, **kw) -> DataFrame:
    """The play log."""
    return read_json(spark, path, None if infer else LOG, **kw)


def read_songs(spark: SparkSession, path: Paths, **kw) -> DataFrame:
    """The song catalogue."""
    return read_json(spark, path, SONG, **kw)


def read_tree(spark: SparkSession, path: Paths, schema: StructType) -> DataFrame:
    """Every ``*.json`` file at any depth below a folder."""
    return read_json(spark, path, schema, recursive=True, file_glob="*.json")


def read_csv(
    spark: SparkSession, path: Paths, schema: StructType, recursive: bool = True, multi_line: bool = False
) -> DataFrame:
    """CSV files with a header each, concatenated; columns are bound by the names in the header.

    An unknown or absent name stops the read, and so does a file whose header differs from the first one's. A large file is read by many tasks. A line break inside a quoted field then stops the read as malformed;
    ``multi_line`` accepts such fields at the price of one task per file.
    """
    options = {**CSV_QUOTING, "multiLine": str(multi_line).lower()}
    if recursive:
        options["recursiveFileLookup"] = "true"
    return _csv_by_name(spark, [path] if isinstance(path, str) else list(path), schema, options)


def _csv_by_name(spark: SparkSession, paths: list[str], schema: StructType | str, options: Mapping[str, str]) -> DataFrame:
    schema = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    # Without a schema the reader opens one file and takes its header; no data are read.
    header = spark.read.options(**{**options, "inferSchema": "false"}).csv(paths).columns
    if sorted(header) != sorted(schema.names):
        raise ValueError(f"the CSV header has {sorted(header)}, the schema {sorted(schema.names)}")
    placed = StructType([schema[name] for name in header])
    reader = spark.read.schema(placed).options(**{**options, "enforceSchema": "false"})
    return reader.csv(paths).select(*schema.names)


def read_event_csv(spark: SparkSession, path: Paths, **kw) -> DataFrame:
    """The event CSV files, all fields as text."""
    return read_csv(spark, path, EVENT_CSV, **kw)


def read_denormalised(spark: SparkSession, path: Paths, **kw) -> DataFrame:
    """The eleven-column CSV; an empty quoted field reads as null."""
    return blank_to_null(read_csv(spark, path, DENORMALISED, **kw))


def day_path(base: str, day: date, pattern: str = "%Y/%m/%d") -> str:
    """The folder holding one day's files."""
    return f"{base.rstrip('/')}/{day.strftime(pattern)}"


def read_partitioned(spark: SparkSession, base: str, inside: str = "", schema: StructType | None = None) -> DataFrame:
    """Partitioned parquet below ``base``; ``inside`` narrows by wildcard while partition columns are kept."""
    reader = spark.read.option("basePath", base)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.parquet(f"{base.rstrip('/')}/{inside}" if inside else base)


def read_table(spark: SparkSession, name: str) -> DataFrame:
    """A stored table by catalogue name, or by path when the name holds a slash."""
    return spark.read.parquet(name) if "/" in name else spark.table(name)


def bind_columns(df: DataFrame, fields: Mapping[str, str]) -> DataFrame:
    """Select source fields under target names: ``{target column: source field}``."""
    return df.select(*[F.col(source).alias(target) for target, source in fields.items()])


def stage(
    spark: SparkSession,
    path: Paths,
    schema: StructType,
    fmt: str = "json",
    fields: Mapping[str, str] | None = None,
    day: date | None = None,
    day_pattern: str = "%Y/%m/%d",
    clean_text: bool = True,
    cut: Mapping[str, int] | None = None,
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """Bulk load of JSON or CSV files into staging shape.

    ``day`` narrows the load to that day's folder. A malformed record stops the load. Blank text becomes null
    unless ``clean_text`` is off. ``fields`` renames on the way in. Text is kept whole; ``cut`` gives widths for the
    columns that may lose their ends (never cut ids or join keys), and ``count_cut`` says how many values that hits.
    """
    paths = [path] if isinstance(path, str) else list(path)
    if day is not None:
        paths = [day_path(p, day, day_pattern) for p in paths]
    defaults = {"json": {"mode": "FAILFAST"}, "csv": CSV_QUOTING}
    if fmt.lower() not in defaults:
        raise ValueError(f"fmt must be one of {sorted(defaults)}")
    settings = {**defaults[fmt.lower()], **dict(options or {})}
    if fmt.lower() == "csv":
        loaded = _csv_by_name(spark, paths, schema, settings)
    else:
        loaded = spark.read.schema(schema).options(**settings).json(paths)
    if fields is not None:
        loaded = bind_columns(loaded, fields)
    if clean_text:
        loaded = blank_to_null(loaded)
    for column, width in dict(cut or {}).items():
        loaded = truncate_text(loaded, width, [column])
    return loaded

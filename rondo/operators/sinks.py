"""Writers. Modes are explicit, and partitioned writes are rebalanced so a hot partition gets many files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rondo.operators.joins import hot_keys
from rondo.operators.layout import cluster_rows


def write_partitioned(
    df: DataFrame, path: str, by: Sequence[str], mode: str = "overwrite", tasks: int | None = None
) -> None:
    """Parquet in one folder per value of ``by``.

    By default the rebalance hint gathers each folder's rows into few files and lets AQE split a folder that
    outgrows the advisory partition size. That sizes tasks by bytes, so thousands of tiny folders would be
    written by one task after the other; ``tasks`` spreads the folders over that many tasks instead, and cuts
    the folders that hold more than a task's share of the rows into slices.
    """
    _placed(df, by, tasks).write.mode(mode).partitionBy(*by).parquet(path)


def write_in_place(df: DataFrame, path: str, by: Sequence[str], mode: str = "overwrite") -> None:
    """Parquet in one folder per value of ``by``, written by the tasks that make the rows.

    For rows that a join multiplies: moving or sorting them would cost many times the join. ``df`` should come ordered by ``by``
    within its tasks, as from a merge join with ``by`` as its first keys, or the write sorts it. Hashes in hex, which the
    default codec can't shorten, are why the files are compressed by zstd, at the level that seeks few repeats in them, and
    why lengths stand apart from texts (pages of the second version): 32 digits take 16.5 bytes instead of 18.3.
    """
    options = {"compression": "zstd", "parquet.compression.codec.zstd.level": "1", "parquet.writer.version": "v2"}
    df.write.mode(mode).options(**options).partitionBy(*by).parquet(path)


def _placed(df: DataFrame, by: Sequence[str], tasks: int | None) -> DataFrame:
    if tasks is None:
        return df.hint("rebalance", *by)
    hot = hot_keys(df, by, 1.0 / max(2, tasks), nulls=True)
    hot = hot.select(*[F.col(c).alias(f"_hot_{c}") for c in by], "_slices")
    same = [F.col(c).eqNullSafe(F.col(f"_hot_{c}")) for c in by]
    marked = df.join(F.broadcast(hot), same, "left")
    slot = F.when(F.col("_slices") > 1, F.pmod(F.xxhash64(*df.columns), F.col("_slices").cast("long")))
    return marked.repartition(tasks, *by, F.coalesce(slot, F.lit(0))).select(*df.columns)


def write_lookup(
    df: DataFrame, path: str, key: Sequence[str], then: Sequence[str] = (), mode: str = "errorifexists", group_bytes: int = 16 << 20
) -> None:
    """Parquet laid out for lookups by value of ``key``.

    Rows are clustered by ``key`` and ``then``, so the value ranges of files, row groups and pages are narrow, and each row group
    has a Bloom filter of every key column: a lookup reads pages of the row groups that hold its value, and none for a value that isn't
    there. The filters size themselves by their row group's values.
    """
    options = {
        **{f"parquet.bloom.filter.enabled#{c}": "true" for c in key},
        "parquet.bloom.filter.adaptive.enabled": "true",
        "parquet.block.size": str(group_bytes),
        "parquet.page.row.count.limit": "2000",
    }
    cluster_rows(df, key, then).write.mode(mode).options(**options).parquet(path)


def write_plain(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Unpartitioned parquet; by default an existing path is an error."""
    df.write.mode(mode).parquet(path)


def write_csv(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """CSV with header and every field quoted, one file per task; nulls become empty fields."""
    df.write.mode(mode).options(header="true", quoteAll="true", escape='"', emptyValue="").csv(path)


def append_rows(df: DataFrame, table: str) -> None:
    """``INSERT INTO table SELECT``: columns are matched by name before the positional insert."""
    df.select(*df.sparkSession.table(table).columns).write.insertInto(table)


def reload_rows(df: DataFrame, table: str) -> None:
    """Replace all rows of a table in one step. The table must not be an input of ``df``."""
    df.select(*df.sparkSession.table(table).columns).write.insertInto(table, overwrite=True)


def load_rows(df: DataFrame, table: str, delete_load: bool = False) -> None:
    """Load a dimension, first emptying it when ``delete_load``."""
    (reload_rows if delete_load else append_rows)(df, table)

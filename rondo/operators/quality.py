"""Data-quality checks. Each returns a report frame; ``require`` turns a bad report into an error."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from rondo.schemas import FOREIGN_KEYS, NOT_NULL, PRIMARY_KEYS
from rondo.session import scratch_path


def check_not_null(df: DataFrame, table: str, columns: Sequence[str]) -> DataFrame:
    """Null count of each required column, from one pass over the table."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    rows = F.array(
        *[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("null_rows")) for c in columns]
    )
    return counts.select(F.lit(table).alias("table_name"), F.inline(rows))


def check_unique_key(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their number of rows."""
    return df.groupBy(*key).agg(F.count(F.lit(1)).alias("n_rows")).filter("n_rows > 1")


def check_foreign_key(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Child values without a parent row, with their number of rows. A null value passes.

    The child is counted per value and the parent reduced to its values first, so a hot value meets as one row.
    """
    values = child.filter(F.col(column).isNotNull()).groupBy(F.col(column).alias("key"))
    counts = values.agg(F.count(F.lit(1)).alias("n_rows"))
    known = parent.select(F.col(parent_column).alias("key")).distinct()
    return counts.join(known, "key", "left_anti")


class WriteChecks:
    """Checks of a table taken while it is written, so that it isn't read again for them.

    Write ``rows`` once, by any writer; then ``counts`` and ``nulls`` give the reports of ``check_row_counts`` and
    ``check_not_null``, and ``bounds`` the least and greatest value of each key column. They wait for the write.
    """

    def __init__(self, df: DataFrame, table: str, not_null: Sequence[str] = (), keys: Sequence[str] = ()):
        self.table, self.not_null, self.keys, self._spark = table, list(not_null), list(keys), df.sparkSession
        self._seen = Observation()
        self.rows = df.observe(
            self._seen,
            F.count(F.lit(1)).alias("n_rows"),
            *[F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in self.not_null],
            *[f(c).alias(f"{f.__name__}_{c}") for c in self.keys for f in (F.min, F.max)],
        )

    def _frame(self, rows: list[tuple], schema: str) -> DataFrame:
        return self._spark.createDataFrame(rows, schema)

    def counts(self) -> DataFrame:
        n = self._seen.get["n_rows"]
        return self._frame([(self.table, n, n > 0)], "table_name string, n_rows long, passed boolean")

    def nulls(self) -> DataFrame:
        rows = [(self.table, c, self._seen.get[f"null_{c}"]) for c in self.not_null]
        return self._frame(rows, "table_name string, column_name string, null_rows long")

    def bounds(self) -> dict[str, tuple]:
        return {c: (self._seen.get[f"min_{c}"], self._seen.get[f"max_{c}"]) for c in self.keys}


def count_rows(df: DataFrame, name: str = "n_rows") -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias(name))


def check_row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """One row per table: its number of rows and whether it is non-empty."""
    reports = [
        count_rows(df).select(F.lit(name).alias("table_name"), "n_rows", (F.col("n_rows") > 0).alias("passed"))
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, reports)


def require(report: DataFrame, failed: Column, what: str) -> None:
    """Raise if any row of the report is a failure, naming a few."""
    bad = report.filter(failed).limit(5).collect()
    if bad:
        raise ValueError(f"{what}: " + "; ".join(str(row.asDict()) for row in bad))


def require_non_empty(tables: Mapping[str, DataFrame]) -> DataFrame:
    """The row-count report, or an error when a table is empty."""
    report = check_row_counts(tables)
    require(report, ~F.col("passed"), "empty table")
    return report



def check_registry(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Every check the registry declares for the given tables: table_name, check_name and the number of failures."""

    def row(table: str, check: str, df: DataFrame, failures: Column) -> DataFrame:
        return df.agg(failures.cast("long").alias("failures")).select(
            F.lit(table).alias("table_name"), F.lit(check).alias("check_name"), "failures"
        )

    reports = []
    for name, df in tables.items():
        reports.append(row(name, "empty", df, (F.count(F.lit(1)) == 0).cast("int")))
        reports.append(row(name, "repeated key", check_unique_key(df, PRIMARY_KEYS[name]), F.count(F.lit(1))))
        nulls = check_not_null(df, name, NOT_NULL.get(name, []))
        reports.append(
            nulls.select("table_name", F.concat(F.lit("null "), "column_name").alias("check_name"), F.col("null_rows").alias("failures"))
        )
    for child, column, parent, parent_column in FOREIGN_KEYS:
        if child in tables and parent in tables:
            orphans = check_foreign_key(tables[child], column, tables[parent], parent_column)
            reports.append(row(child, f"orphan {column}", orphans, F.coalesce(F.sum("n_rows"), F.lit(0))))
    return reduce(DataFrame.unionByName, reports)


def unique_ids(df: DataFrame, name: str) -> DataFrame:
    """The rows without their id, and whether the id is given and no other row has it.

    The rows are stored first: an id that changes with every evaluation is looked at once.
    """
    path = scratch_path(df.sparkSession, "numbered")
    df.write.parquet(path)
    stored = df.sparkSession.read.schema(df.schema).parquet(path)
    counts = stored.groupBy(name).agg(F.count(F.lit(1)).alias("_n"))
    checked = stored.join(counts, name, "left").withColumn("id_unique", F.coalesce(F.col("_n") == 1, F.lit(False)))
    return checked.drop(name, "_n")

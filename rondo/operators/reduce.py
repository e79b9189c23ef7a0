"""One row per key, and whole-row distinct.

A ``row_number() = 1`` filter makes Spark place a group limit *before* the shuffle, so each task sends at most
one row per key: a key that holds a third of the table costs one row per task, not one huge task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_RANK = "_rondo_rank"


def _one_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    ranked = df.withColumn(_RANK, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.filter(F.col(_RANK) == 1).drop(_RANK)


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The earliest whole row of every key. ``order`` should be total, or ties are settled arbitrarily."""
    return _one_per_key(df, keys, [F.col(c).asc_nulls_first() for c in order])


def last_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The latest whole row of every key."""
    return _one_per_key(df, keys, [F.col(c).desc_nulls_last() for c in order])


def distinct_rows(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Whole-row distinct over the chosen columns; copies collapse before the shuffle."""
    return (df.select(*columns) if columns else df).distinct()

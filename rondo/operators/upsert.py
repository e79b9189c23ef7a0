"""Keyed loads as frames: keep-first, update-one-column and last-write-wins.

Arrival order does not exist in a distributed load, so each operator takes an explicit order. All three reduce
the new rows per key before they meet the stored table, so a hot key never reaches one task as a group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rondo.operators.reduce import first_per_key, last_per_key


def without_keys(rows: DataFrame, others: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key is not among the others'; a null is a key value like any other, so reloads stay idempotent."""
    known = others.select(*[F.col(k).alias(f"_known_{k}") for k in keys])
    return rows.join(known, [F.col(k).eqNullSafe(F.col(f"_known_{k}")) for k in keys], "left_anti")


def insert_ignore(
    new: DataFrame, keys: Sequence[str], order: Sequence[str], target: DataFrame | None = None
) -> DataFrame:
    """The first new row of every key not yet in ``target``; append the result to the target."""
    first = first_per_key(new, keys, order)
    return first if target is None else without_keys(first, target, keys)


def upsert_ignore(
    new: DataFrame, keys: Sequence[str], order: Sequence[str], target: DataFrame
) -> DataFrame:
    """The whole target after a keep-first load: stored rows win over new ones."""
    fresh = insert_ignore(new, keys, order, target)
    return target.unionByName(fresh.select(*target.columns))


def key_state(
    new: DataFrame, keys: Sequence[str], order: Sequence[str], keep: Sequence[str], update: Sequence[str]
) -> DataFrame:
    """Per key the first ``keep`` values and the last ``update`` values, with the order marks behind them.

    The marks make two states mergeable in any sequence, so the same function serves a batch and a stream.
    """
    at = F.struct(*[F.col(c) for c in order])
    return new.groupBy(*keys).agg(
        *[F.min_by(F.col(c), at).alias(c) for c in keep],
        *[F.max_by(F.col(c), at).alias(c) for c in update],
        F.min(at).alias("first_at"),
        F.max(at).alias("last_at"),
    )


def merge_states(
    old: DataFrame, new: DataFrame, keys: Sequence[str], keep: Sequence[str], update: Sequence[str]
) -> DataFrame:
    """Combine two ``key_state`` frames; the outcome does not depend on which one came first."""
    return one_state(old.unionByName(new), keys, keep, update)


def one_state(states: DataFrame, keys: Sequence[str], keep: Sequence[str], update: Sequence[str]) -> DataFrame:
    """One ``key_state`` row per key from any number of them."""
    return states.groupBy(*keys).agg(
        *[F.min_by(F.col(c), "first_at").alias(c) for c in keep],
        *[F.max_by(F.col(c), "last_at").alias(c) for c in update],
        F.min("first_at").alias("first_at"),
        F.max("last_at").alias("last_at"),
    )


def upsert_update(
    new: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    update: Sequence[str],
    target: DataFrame | None = None,
) -> DataFrame:
    """Insert unseen keys with their first row; for every seen key set ``update`` to its last new value."""
    keep = [c for c in new.columns if c not in {*keys, *order, *update}]
    columns = [*keys, *keep, *update]
    state = key_state(new, keys, order, keep, update).select(*columns)
    if target is None:
        return state
    renamed = state.toDF(*[f"_new_{c}" for c in columns]).withColumn("_fresh", F.lit(True))
    same = [F.col(k).eqNullSafe(F.col(f"_new_{k}")) for k in keys]
    merged = target.withColumn("_stored", F.lit(True)).join(renamed, same, "full")
    return merged.select(
        *[F.when(F.col("_stored"), F.col(c)).otherwise(F.col(f"_new_{c}")).alias(c) for c in [*keys, *keep]],
        *[F.when(F.col("_fresh"), F.col(f"_new_{c}")).otherwise(F.col(c)).alias(c) for c in update],
    )


def upsert_last_write(
    new: DataFrame, keys: Sequence[str], order: Sequence[str], target: DataFrame | None = None
) -> DataFrame:
    """Whole-row replace: the last new row of every key, and the target rows whose key is not rewritten."""
    last = last_per_key(new, keys, order)
    if target is None:
        return last
    kept = without_keys(target, last, keys)
    return kept.unionByName(last.select(*target.columns))

"""Equi-joins that survive hot keys on either side.

By default a join is left to the planner, which broadcasts a small right side and, with adaptive execution, splits
the tasks of a hot key. ``salt`` asks for more: keys with more rows than one task should take are found by a count
with map-side combine over the key columns only, and just those keys are salted. Their rows are spread over
slices on the side where they are hot, and copied once per slice on the other side. The list of hot keys has at most
``MOST`` entries per side, so it is safe to broadcast, and it is looked up by the keys themselves. No row is
dropped, so the result is exactly the plain join's.

``tiled_join`` is for keys that repeat on both sides, whose result is far larger than its inputs: it gives every pair too, in
an order that columnar files store in few bytes, on as many tasks as the pairs need.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from math import ceil

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Rows of one key that one task takes, and the most keys a list of hot ones holds.
ROWS_PER_TASK = 1_000_000
MOST = 20_000
#: Pairs that one task of a tiled join makes, and the right rows of a key that follow each other for every left row.
PAIRS_PER_TASK = 20_000_000
TILE = 64


def hot_keys(df: DataFrame, keys: Sequence[str], rows: float = ROWS_PER_TASK, nulls: bool = False) -> DataFrame:
    """Keys with more than ``rows`` rows, and how many slices bring each slice under that.

    The limit is raised where more than ``MOST`` keys could pass it. Keys holding a null count only with ``nulls``.
    A ``rows`` below one is a share of all rows.
    """
    picked = df.select(*keys) if nulls else df.select(*keys).na.drop(how="any")
    counts = picked.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    # The total is summed from the same counts, so their shuffle is made once and reused.
    total = F.sum("_n")
    asked = total * F.lit(float(rows)) if rows < 1 else F.lit(float(rows))
    limit = counts.agg(F.greatest(asked, total / MOST, F.lit(1.0)).alias("limit")).scalar()
    return counts.select(*keys, F.ceil(F.col("_n") / limit).cast("int").alias("_slices")).filter("_slices > 1")


def skew_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[tuple[str, str]],
    how: str = "inner",
    salt: bool = False,
    rows: float = ROWS_PER_TASK,
    right_unique: bool = False,
    hot: DataFrame | None = None,
) -> DataFrame:
    """Inner or left equi-join on ``(left column, right column)`` pairs; both sides' columns are kept.

    Column names of the two sides must differ and paired keys must have one type. With ``salt``, select the needed
    columns first: hot rows are spread by a hash of the whole row, which would keep unused columns alive.
    ``right_unique`` says that no key repeats on the right, which then needs no search for hot keys. ``hot`` is a list
    from ``hot_keys`` under the left column names, where one was made already for the left side or a frame it comes from.
    """
    if how not in ("inner", "left"):
        raise ValueError("how must be 'inner' or 'left'")
    if any(left.schema[a].dataType != right.schema[b].dataType for a, b in on):
        raise ValueError(f"paired keys differ in type: {list(on)}")
    match = [F.col(a) == F.col(b) for a, b in on]
    if not salt and hot is None:
        return left.join(right, match, how)
    lkeys, rkeys = [a for a, _ in on], [b for _, b in on]
    hot_left = hot_keys(left, lkeys, rows) if hot is None else hot
    return _salted_join(left, right, on, match, how, hot_left, None if right_unique else hot_keys(right, rkeys, rows))


def _salted_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[tuple[str, str]],
    match: list[Column],
    how: str,
    hot_left: DataFrame,
    hot_right: DataFrame | None,
) -> DataFrame:
    lkeys, rkeys = [a for a, _ in on], [b for _, b in on]
    names = [f"_k{i}" for i in range(len(on))]

    def renamed(hot: DataFrame, keys: Sequence[str], cuts: str) -> DataFrame:
        return hot.select(*[F.col(k).alias(n) for k, n in zip(keys, names)], F.col("_slices").alias(cuts))

    # One short list: into how many slices a key is cut on either side.
    cut = renamed(hot_left, lkeys, "_cut_left")
    if hot_right is None:
        cut = cut.withColumn("_cut_right", F.lit(1))
    else:
        both = cut.unionByName(renamed(hot_right, rkeys, "_cut_right"), allowMissingColumns=True)
        cut = both.groupBy(*names).agg(F.max("_cut_left").alias("_cut_left"), F.max("_cut_right").alias("_cut_right"))

    def with_cuts(df: DataFrame, keys: Sequence[str]) -> DataFrame:
        same = [F.col(k) == F.col(n) for k, n in zip(keys, names)]
        return df.join(F.broadcast(cut), same, "left").drop(*names)

    zero = F.lit(0).cast("long")

    def one_slice(cuts: str, columns: Sequence[str]) -> Column:
        return F.when(F.col(cuts) > 1, F.pmod(F.xxhash64(*columns), F.col(cuts).cast("long"))).otherwise(zero)

    def all_slices(cuts: str) -> Column:
        several = F.sequence(zero, F.col(cuts).cast("long") - 1)
        return F.explode(F.when(F.col(cuts) > 1, several).otherwise(F.array(zero)))

    slot = F.col("_ls") * F.lit(1 << 32) + F.col("_rs")
    # Null keys never match; in a left join they are spread by row content instead of meeting in one task.
    no_key = reduce(lambda x, y: x | y, [F.col(k).isNull() for k in lkeys])
    rows = with_cuts(left, lkeys).withColumn("_ls", one_slice("_cut_left", left.columns))
    rows = rows.withColumn("_rs", all_slices("_cut_right"))
    lsalt = F.when(no_key, F.xxhash64(*left.columns)).otherwise(slot)
    several = F.coalesce(F.col("_cut_right") > 1, F.lit(False))
    rows = rows.select(*left.columns, lsalt.alias("_lsalt"), several.alias("_several"))

    others = with_cuts(right.na.drop(how="any", subset=rkeys), rkeys)
    others = others.withColumn("_rs", one_slice("_cut_right", right.columns)).withColumn("_ls", all_slices("_cut_left"))
    others = others.select(*right.columns, slot.alias("_rsalt"))

    # The salt goes first: a sort by it settles many comparisons on one number.
    joined = rows.join(others, [F.col("_lsalt") == F.col("_rsalt"), *match], how)
    if how == "left" and hot_right is not None:
        # A key cut on the right side has a match in some slice; its empty slices are not results.
        joined = joined.filter(F.col("_rsalt").isNotNull() | ~F.col("_several"))
    return joined.select(*left.columns, *right.columns)


def tiled_join(
    left: DataFrame, right: DataFrame, on: Sequence[tuple[str, str]], pairs: int = PAIRS_PER_TASK, tile: int = TILE
) -> DataFrame:
    """Inner equi-join of keys that repeat on both sides: the left columns, then the right ones that are no keys.

    A key's right rows are packed into tiles of at most ``tile``, and its left rows pass each tile in turn. So a left row stands
    ``tile`` times in a row and the same right rows come again after ``tile`` rows, however often the key occurs: run lengths and
    a page's compression take both. The inputs are shuffled once; pairs are not.

    Keys are counted first. There are as many tasks as there are ``pairs`` to make or ``ROWS_PER_TASK`` left rows to hold, and
    left rows of a key that asks for more than one task are spread by a hash of their content, with the key's right rows copied
    for each slice. Select the needed columns first. Column names of the two sides must differ.
    """
    if any(left.schema[a].dataType != right.schema[b].dataType for a, b in on):
        raise ValueError(f"paired keys differ in type: {list(on)}")
    lkeys, rkeys = [a for a, _ in on], [b for _, b in on]
    names = [f"_k{i}" for i in range(len(on))]
    values = [c for c in right.columns if c not in rkeys]
    if not values:
        raise ValueError("the right side has no column besides its keys")
    # Null keys never match; NaN equals itself here, so na.drop would lose matches.
    left = left.where(reduce(lambda x, y: x & y, [F.col(k).isNotNull() for k in lkeys]))
    right = right.where(reduce(lambda x, y: x & y, [F.col(k).isNotNull() for k in rkeys]))

    def counted(df: DataFrame, keys: Sequence[str], count: str) -> DataFrame:
        named = df.select(*[F.col(k).alias(n) for k, n in zip(keys, names)])
        return named.groupBy(*names).agg(F.count(F.lit(1)).cast("double").alias(count))

    made = F.col("_left") * F.coalesce("_right", F.lit(0.0))
    asked = counted(left, lkeys, "_left").join(counted(right, rkeys, "_right"), names, "left")
    asked = asked.select(*names, F.greatest(made / pairs, F.col("_left") / ROWS_PER_TASK).alias("_tasks"))
    total = asked.agg(F.sum("_tasks")).first()[0] or 0.0
    most = max(1.0, total / MOST)
    cut = asked.where(F.col("_tasks") > most).select(*names, F.ceil(F.col("_tasks") / most).cast("int").alias("_slices"))

    def with_slices(df: DataFrame, keys: Sequence[str]) -> DataFrame:
        same = [F.col(k) == F.col(n) for k, n in zip(keys, names)]
        return df.join(F.broadcast(cut), same, "left").withColumn("_slices", F.coalesce("_slices", F.lit(1)))

    tasks = min(max(1, ceil(total)), MOST)
    one = F.pmod(F.xxhash64(*left.columns), F.col("_slices")).cast("int")
    rows = with_slices(left, lkeys).select(*left.columns, one.alias("_ls")).repartition(tasks, *lkeys, "_ls")

    every = F.explode(F.sequence(F.lit(0), F.col("_slices") - 1))
    tiles = with_slices(right, rkeys).select(*right.columns, every.alias("_rs")).repartition(tasks, *rkeys, "_rs")
    place = F.row_number().over(Window.partitionBy(*rkeys, "_rs").orderBy(*values)) - 1
    tiles = tiles.withColumn("_tile", F.floor(place / tile)).groupBy(*rkeys, "_rs", "_tile")
    tiles = tiles.agg(F.collect_list(F.struct(*values)).alias("_tiled"))

    # In a merge join the left side is read on and the right side's rows of a key are kept: tiles on the left.
    match = [F.col("_rs") == F.col("_ls"), *[F.col(b) == F.col(a) for a, b in on]]
    return tiles.join(rows.hint("merge"), match).select(*left.columns, F.inline("_tiled"))

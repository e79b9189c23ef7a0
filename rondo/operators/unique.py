"""Repeated keys of a table whose keys are wide or many, with only suspects shuffled.

A key's 64-bit hash names one bit: the upper bits a word, six others a place in it. The first pass tells, for every word, which bits
its rows set and how many rows there were; if each set a bit of its own, no two rows of the word have the same key. Only the rows
of the other words, few where keys repeat seldom, are grouped by the key itself in a second pass. What is shuffled of all other
rows is a number pair a word and task, whatever the width of the keys.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rondo.operators.quality import check_unique_key
from rondo.session import scratch_path

#: The most words of the first pass. Beyond some 2**30 rows more of them are suspects; the result is the same.
MOST_WORDS_LOG2 = 30


def _bit(hashed: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), hashed.bitwiseAND(F.lit(63)).cast("int"))


def crowded_words(df: DataFrame, hashed: Column, log2: int) -> DataFrame:
    """Words of which two rows set the same bit."""
    each = df.select(F.shiftrightunsigned(hashed, 64 - log2).alias("_word"), _bit(hashed).alias("_bit"))
    sums = each.groupBy("_word").agg(F.bit_or("_bit").alias("_set"), F.count(F.lit(1)).alias("_rows"))
    return sums.where(F.bit_count("_set") < F.col("_rows")).select("_word")


def repeated_keys(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """The report of ``check_unique_key``: keys that occur more than once, with their number of rows.

    Nulls are key values. The table is read twice, its key columns only; the crowded words are stored in between.
    """
    rows = df.select(*key)
    log2 = min(MOST_WORDS_LOG2, max(10, rows.count().bit_length()))
    hashed = F.xxhash64(*key)
    path = scratch_path(df.sparkSession, "crowded")
    crowded_words(rows, hashed, log2).write.parquet(path)
    words = df.sparkSession.read.schema("_word long").parquet(path)
    suspects = rows.withColumn("_word", F.shiftrightunsigned(hashed, 64 - log2)).join(words, "_word", "left_semi")
    return check_unique_key(suspects.select(*key), key)

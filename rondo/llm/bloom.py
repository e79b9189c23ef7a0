"""Bloom filters as tables of 64-bit words, built and probed with built-in functions only.

A 64-bit hash names one word by its upper bits and two bits of that word by its lower ones. A filter is the table
(word, bits) of its non-zero words. It has at most ``MAX_WORDS`` rows, whatever the data, so it may be broadcast; beyond
that size more rows pass as "maybe", which costs time and changes no result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rondo.llm.store import unused

MAX_WORDS = 1 << 22


def words_for(rows: int, max_words: int = MAX_WORDS) -> int:
    """A power of two giving at most two rows a word, up to the largest filter allowed."""
    return min(max_words, 1 << max(10, (rows // 2).bit_length()))


def _word(hashed: Column, words: int) -> Column:
    return F.shiftrightunsigned(hashed, 64 - (words.bit_length() - 1))


def _mask(hashed: Column) -> Column:
    one = F.lit(1).cast("long")
    first = F.call_function("shiftleft", one, hashed.bitwiseAND(F.lit(63)).cast("int"))
    second = F.call_function("shiftleft", one, F.shiftrightunsigned(hashed, 6).bitwiseAND(F.lit(63)).cast("int"))
    return first.bitwiseOR(second)


def members(df: DataFrame, hashed: Column, words: int) -> DataFrame:
    """Filter that holds every row's hash."""
    return df.groupBy(_word(hashed, words).alias("_word")).agg(F.bit_or(_mask(hashed)).alias("_bits"))


def repeated(df: DataFrame, hashed: Column, words: int) -> DataFrame:
    """Filter that holds every hash found in two rows or more, and few others.

    Per word, OR and XOR of the masks and the number of bits set tell which bits were set more than once: a bit in OR
    but not in XOR was set an even number of times. If those explain every setting beyond the first, the rest were set
    once; otherwise all bits of the word count as repeated. One small row a word and task is shuffled.
    """
    masks = df.select(_word(hashed, words).alias("_word"), _mask(hashed).alias("_mask"))
    found = masks.groupBy("_word").agg(
        F.bit_or("_mask").alias("_or"),
        F.bit_xor("_mask").alias("_xor"),
        F.sum(F.bit_count("_mask")).alias("_set"),
    )
    even = F.col("_or").bitwiseAND(F.bitwise_not("_xor"))
    explained = F.col("_set") - F.bit_count("_or") == F.bit_count(even)
    bits = F.when(explained, even).otherwise(F.col("_or"))
    return found.select("_word", bits.alias("_bits")).where("_bits != 0")


def probe(df: DataFrame, hashed: Column, words: int, found: DataFrame, name: str = "_maybe") -> DataFrame:
    """Add a boolean column: False if the row's hash is surely not in the filter. Rows don't move."""
    own, word, bits = (unused(c, df.columns) for c in ("_hash", "_word", "_bits"))
    keyed = df.withColumn(own, hashed).withColumn(word, _word(F.col(own), words))
    mask = _mask(F.col(own))
    hit = F.coalesce(F.col(bits).bitwiseAND(mask) == mask, F.lit(False))
    found = found.select(F.col("_word").alias(word), F.col("_bits").alias(bits))
    return keyed.join(F.broadcast(found), word, "left").withColumn(name, hit).drop(own, word, bits)


def _id_hash(name: str) -> Column:
    return F.xxhash64(F.lit(7), F.col(name))


def thin(df: DataFrame, ids: DataFrame, name: str, count: int) -> DataFrame:
    """Rows of ``df`` whose id may be in ``ids``, a column of that name; nothing is shuffled but the filter."""
    words, maybe = words_for(count), unused("_maybe", df.columns)
    return probe(df, _id_hash(name), words, members(ids, _id_hash(name), words), maybe).where(F.col(maybe)).drop(maybe)


def semi_join(df: DataFrame, ids: DataFrame, name: str, count: int) -> DataFrame:
    """Rows of ``df`` whose id is in ``ids``; only rows the filter lets through are shuffled."""
    return thin(df, ids, name, count).join(ids.select(name).distinct(), name, "left_semi")


def anti_join(df: DataFrame, ids: DataFrame, name: str, count: int) -> DataFrame:
    """Rows of ``df`` whose id is not in ``ids`` (a null id never is); most rows pass without a shuffle."""
    words, maybe = words_for(count), unused("_maybe", df.columns)
    probed = probe(df, _id_hash(name), words, members(ids, _id_hash(name), words), maybe)
    doubtful = probed.where(F.col(maybe)).drop(maybe).join(ids.select(name).distinct(), name, "left_anti")
    return probed.where(~F.col(maybe)).drop(maybe).unionByName(doubtful)

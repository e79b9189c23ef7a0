"""Exact dedup by two-pass Bloom filtering.

The first pass sets every text's hash in a Bloom filter that remembers which bits were set twice. The second pass sends
only rows whose hash may be repeated through a shuffle; all other rows go straight to the result. Groups are formed by
SHA-256 of the normalised text, so a false alarm of the filter costs a shuffle and changes nothing.

Defined cases: a null text counts as empty; all empty texts are equal; white space at the ends counts as one space, as
anywhere. Null ids sort after all others. Of rows repeated in full, one stays. Extra columns pass through ``dedup`` and
are ignored by ``mark``; names starting with an underscore are reserved. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rondo.llm import bloom
from rondo.llm.store import stored

#: Runs of white space that are not already one single space; replacing those alone gives the same text, faster.
_RUNS = r"[\x09-\x0D][\x20\x09-\x0D]*|\x20[\x20\x09-\x0D]+"
#: A group this share of all rows or larger is looked up by broadcast; there can't be more than 1 / _HOT of them.
_HOT = 1e-4


def normalised(text: Column) -> Column:
    """White-space runs become one space; null becomes empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), _RUNS, " ")


def mark(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256."""
    digest = F.sha2(normalised(F.col(text)).cast("binary"), 256)
    prints = stored(
        docs.select(F.col(doc_id).alias("doc_id"), digest.alias("text_sha256")).withColumn(
            "_row", F.monotonically_increasing_id()
        ),
        "fingerprints",
    )
    rows = prints.count()
    words = bloom.words_for(rows)
    hashed = F.xxhash64("text_sha256")
    probed = bloom.probe(prints, hashed, words, bloom.repeated(prints, hashed, words))
    single = {"keep_id": F.col("doc_id"), "group_size": F.lit(1).cast("long"), "kept": F.lit(True)}
    once = probed.where("NOT _maybe").withColumns(single)
    doubtful = probed.where("_maybe")
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "_row"))
    groups = stored(
        doubtful.groupBy("text_sha256").agg(first.alias("_first"), F.count(F.lit(1)).alias("group_size")),
        "groups",
    ).select(
        "text_sha256",
        F.col("_first.doc_id").alias("keep_id"),
        F.col("_first._row").alias("_keep"),
        "group_size",
    )
    hot = F.col("group_size") > max(1000, int(rows * _HOT))
    looked = doubtful.join(F.broadcast(groups.where(hot)), "text_sha256", "left")
    of_hot = looked.where("_keep IS NOT NULL")
    of_cold = looked.where("_keep IS NULL").drop("keep_id", "_keep", "group_size")
    of_cold = of_cold.join(groups.where(~hot), "text_sha256")
    several = of_hot.unionByName(of_cold).withColumn("kept", F.col("_row") == F.col("_keep"))
    columns = ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    return once.select(columns).unionByName(several.select(columns))


def dedup(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """The rows that stay, with all their columns. Texts that occur once are never shuffled."""
    words = bloom.words_for(docs.count())
    hashed = F.xxhash64(normalised(F.col(text)))
    probed = bloom.probe(docs, hashed, words, bloom.repeated(docs, hashed, words))
    once = probed.where("NOT _maybe").drop("_maybe")
    keyed = probed.where("_maybe").withColumn("_digest", F.sha2(normalised(F.col(text)).cast("binary"), 256))
    # A map can't be compared or hashed, so ties between rows with one id are settled by the text alone.
    order = F.struct(F.col(doc_id).isNull(), F.col(doc_id), F.xxhash64(text))
    best = keyed.groupBy("_digest").agg(F.min_by(F.struct(*docs.columns), order).alias("_best"))
    return once.unionByName(best.select("_best.*"))

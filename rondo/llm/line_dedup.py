"""Line dedup by range-partitioned hashes: a long line that many documents hold stays in one of them.

Every line long enough becomes a row of two 64-bit hashes of its key (the line without white space at its ends, A-Z as a-z), its
document's id, a hash of its text and its position; no text is shuffled for the decision. The rows are partitioned by ranges of
the hash and sorted inside a partition by hash, document (largest first) and position, so one pass over them meets all lines of
a key together, the document that keeps them first. What comes back is a bitmap per document: words of 64 lines, of which those
without a dropped line are left out (``keep_bitmaps``). ``apply`` joins the bitmaps to their texts. Only documents that may lose
a line are shuffled for that; a Bloom filter lets all others pass.

A key with more rows than one task should take never reaches the range shuffle. Such keys are found without a sample: rows are
counted by the upper bits of their hash, and only rows of crowded ranges are counted by key, with map-side combine. There are
at most ``MOST_HOT`` of them, so their number of documents and largest document may be broadcast.

Defined cases: a null or empty text is one empty line. Rows that share a document id are one document. A null id is one document
too, smaller than all others. All lines that the keeping document holds of a key stay, repeats included. Rows repeated in full
are treated alike. Extra columns pass through ``apply``, names starting with an underscore are reserved. An empty table gives
empty results.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rondo.llm import bloom
from rondo.llm.store import stored

_SPACE = " \t\n\x0b\x0c\r"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Keys with more rows than this share of all rows, and more than LEAST_HOT, are looked up instead of sorted.
MOST_HOT = 20_000
LEAST_HOT = 1_000
#: Ranges of the hash that rows are counted by to find hot keys.
_RANGE_BITS = 20


def split(text: Column) -> Column:
    """The lines of a text; at least one."""
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def _lowered(line: Column) -> Column:
    # lower() is A-Z to a-z where all characters are ASCII, and much faster than translate().
    ascii_only = F.octet_length(line) == F.length(line)
    return F.when(ascii_only, F.lower(line)).otherwise(F.translate(line, _UPPER, _UPPER.lower()))


def lines(docs: DataFrame, length: int = 40, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One row per line whose key has ``length`` code points or more: doc, of (hash of the text), pos, h and h2 (its key)."""
    each = docs.select(
        F.col(doc_id).alias("doc"), F.xxhash64(text).alias("of"), F.posexplode(split(F.col(text))).alias("pos", "_line")
    )
    bare = each.select("doc", "of", "pos", F.trim("_line", F.lit(_SPACE)).alias("_bare")).where(F.length("_bare") >= length)
    keyed = bare.select("doc", "of", "pos", _lowered(F.col("_bare")).alias("_key"))
    return keyed.select("doc", "of", "pos", F.xxhash64("_key").alias("h"), F.xxhash64(F.lit(1), "_key").alias("h2"))


def hot_keys(rows: DataFrame, count: int) -> DataFrame:
    """h, h2, documents and largest document of every key with too many rows for one task; at most ``MOST_HOT`` rows."""
    limit = max(LEAST_HOT, count // MOST_HOT)
    part = F.shiftrightunsigned("h", 64 - _RANGE_BITS)
    crowded = rows.groupBy(part.alias("_range")).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > limit)
    suspects = rows.join(F.broadcast(crowded.select("_range")), part == F.col("_range"), "left_semi")
    per_doc = suspects.groupBy("h", "h2", "doc").agg(F.count(F.lit(1)).alias("_n"))
    per_key = per_doc.groupBy("h", "h2").agg(
        F.sum("_n").alias("_n"), F.count(F.lit(1)).alias("_docs"), F.max("doc").alias("_last")
    )
    return stored(per_key.where(F.col("_n") > limit).drop("_n"), "hot-lines")


def dropped_lines(rows: DataFrame, least: int = 5) -> DataFrame:
    """Rows of ``lines`` that go: their key is in ``least`` documents or more, and theirs is not the largest of them."""
    hot = hot_keys(rows, rows.count())
    looked = rows.join(F.broadcast(hot), ["h", "h2"], "left")
    elsewhere = ~F.col("doc").eqNullSafe(F.col("_last"))
    of_hot = looked.where((F.col("_docs") >= least) & elsewhere).select("doc", "of", "pos")
    cold = looked.where("_docs IS NULL").select("h", "h2", "doc", "of", "pos").repartitionByRange("h", "h2")
    cold = cold.sortWithinPartitions("h", "h2", F.desc_nulls_last("doc"), "pos")
    same = Window.partitionBy("h", "h2")
    # The number of documents met so far: 1 in the document that keeps its lines.
    met = F.dense_rank().over(same.orderBy(F.desc_nulls_last("doc")))
    counted = cold.withColumn("_met", met).withColumn("_docs", F.max("_met").over(same))
    return of_hot.unionByName(counted.where((F.col("_docs") >= least) & (F.col("_met") > 1)).select("doc", "of", "pos"))


def keep_bitmaps(docs: DataFrame, least: int = 5, length: int = 40, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One row per document that loses lines: doc, of, n_dropped, keep.

    ``keep`` is a sorted array of (word, bits): bit i of word w stands for line 64 * w + i and is 1 if the line stays. Words
    that are not listed have all their lines kept.
    """
    gone = dropped_lines(stored(lines(docs, length, text, doc_id), "lines"), least)
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("pos").bitwiseAND(F.lit(63)))
    # Rows repeated in full set the same bits, so OR and not a sum.
    words = gone.groupBy("doc", "of", F.shiftright("pos", 6).alias("word")).agg(F.bit_or(bit).alias("_bits"))
    listed = F.sort_array(F.collect_list(F.struct("word", F.bitwise_not("_bits").alias("bits"))))
    return words.groupBy("doc", "of").agg(F.sum(F.bit_count("_bits")).cast("long").alias("n_dropped"), listed.alias("keep"))


def _dense(keep: Column) -> Column:
    """The words as an array without gaps, up to the last one listed."""
    before = lambda i: F.when(i == 0, F.lit(-1)).otherwise(F.get(keep, i - 1)["word"])
    filled = lambda x, i: F.concat(F.array_repeat(F.lit(-1).cast("long"), x["word"] - before(i) - 1), F.array(x["bits"]))
    return F.flatten(F.transform(keep, filled))


def kept_text(text: Column, dense: Column) -> Column:
    """The lines that stay by a bitmap laid out without gaps, joined by line ends."""

    def stays(_, i):
        word = F.coalesce(F.get(dense, F.shiftright(i, 6)), F.lit(-1).cast("long"))
        return F.call_function("shiftrightunsigned", word, i.bitwiseAND(F.lit(63))).bitwiseAND(F.lit(1)) == 1

    return F.array_join(F.filter(split(text), stays), "\n")


def apply(docs: DataFrame, bitmaps: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``docs`` with n_lines, n_dropped, keep (null: all lines stay) and kept_text."""
    ids = bitmaps.select(F.xxhash64("doc", "of").alias("_id"))
    keyed = docs.withColumn("_of", F.xxhash64(text)).withColumn("n_lines", F.size(split(F.col(text))).cast("long"))
    hashed = F.xxhash64(F.col(doc_id), F.col("_of"))
    words = bloom.words_for(bitmaps.count())
    probed = bloom.probe(keyed, hashed, words, bloom.members(ids, F.col("_id"), words))
    nothing = {"n_dropped": F.lit(0).cast("long"), "keep": F.lit(None).cast(bitmaps.schema["keep"].dataType)}
    whole = F.coalesce(F.col(text), F.lit(""))
    untouched = probed.where("NOT _maybe").withColumns(nothing).withColumn("kept_text", whole)
    doubtful = probed.where("_maybe").join(
        # Laid out before the join, so that it is done once a document and not once a line.
        bitmaps.withColumn("_dense", _dense(F.col("keep"))).withColumnsRenamed({"doc": "_doc", "of": "_text"}),
        F.col(doc_id).eqNullSafe(F.col("_doc")) & (F.col("_of") == F.col("_text")),
        "left",
    )
    cut = doubtful.withColumn("_dense", _dense(F.col("keep"))).withColumn(
        "kept_text", F.when(F.col("keep").isNull(), whole).otherwise(kept_text(F.col(text), F.col("_dense")))
    )
    columns = [*docs.columns, "n_lines", "n_dropped", "keep", "kept_text"]
    cut = cut.withColumn("n_dropped", F.coalesce("n_dropped", F.lit(0).cast("long")))
    return untouched.select(columns).unionByName(cut.select(columns))


def line_dedup(docs: DataFrame, least: int = 5, length: int = 40, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One row per document: doc_id, n_lines (before dropping), n_dropped, kept_sha256 (of the lines that stay)."""
    bitmaps = stored(keep_bitmaps(docs, least, length, text, doc_id), "keep-bitmaps")
    done = apply(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")), bitmaps)
    return done.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))

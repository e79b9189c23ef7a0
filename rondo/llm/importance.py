"""Importance resampling to a target's word distribution, with weights summed from bit planes.

Every run of 1 to ``longest`` consecutive words is a feature, and its CRC-32 picks one of ``buckets`` buckets. A bucket's gain is
the scaled, floored logarithm of how much more often the target's features fall into it than the corpus's. A document's weight
is the floored mean of its features' gains, and its score is the weight plus Gumbel noise drawn from a hash of its id, so that
taking the highest scores draws without replacement by weight, and the same again when a task is run twice.

The sum of gains is exact and bit-sliced. A document's bucket counts are laid out as planes of ``buckets`` bits: plane i holds
bit i of every bucket's count. The gains are laid out the same way in two's complement, the last plane counting negative. The sum is
that of 2**(i + j) times the number of bits set in (count plane i AND gain plane j), over all i and j.

The corpus is read twice: once for bucket counts (one row a bucket and task, summed by Spark), once for the scores. Only
``buckets`` sums reach the driver, and only the gains reach the tasks. Ranks take one range shuffle, of the ids of documents that
can be drawn: those with at least the score at which the draw ends, found in a histogram of the scores, which are whole
numbers of a small range.

Memory: texts are taken in slices of ``words.SLICE`` bytes, planes are laid out for a few documents at a time.

Defined cases: a null or empty text, and one without words, has no features, weight 0 and takes no part in the draw (unless
``least`` is 0). A null id is hashed as an empty one and comes last among ties; rows that share id and score are ranked in any
order. An empty target has gains by the corpus alone, an empty corpus gives no rows. Extra columns are ignored.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rondo.llm.store import stored
from rondo.llm.words import SLICE
from rondo.operators.numbering import identity_ids

BUCKETS = 10_000
#: Documents whose planes are laid out at a time.
_TOGETHER = 64
#: Features whose buckets a task remembers.
_REMEMBERED = 500_000
#: A-Z become a-z, every other ASCII character that is no letter or digit a space; bytes of other characters stay.
_WORD_BYTES = bytes(
    c + 32 if 65 <= c <= 90 else c if c >= 0x80 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256)
)


class _Buckets(dict):
    """The bucket of a feature, kept for the next time."""

    def __init__(self, buckets: int):
        self.buckets = buckets

    def __missing__(self, feature: bytes) -> int:
        if len(self) >= _REMEMBERED:
            self.clear()
        found = self[feature] = zlib.crc32(feature) % self.buckets
        return found


def words_of(data: bytes) -> Iterator[list[bytes]]:
    """The words of a text, some at a time."""
    begin, carried = 0, b""
    while begin < len(data):
        part = carried + data[begin : begin + SLICE].translate(_WORD_BYTES)
        begin += SLICE
        cut = len(part) if begin >= len(data) else part.rfind(b" ") + 1
        carried = part[cut:]
        yield part[:cut].split()


def features_of(data: bytes, longest: int) -> Counter:
    """How often each feature occurs in a text."""
    found: Counter = Counter()
    before: list[bytes] = []
    for some in words_of(data):
        found.update(some)
        if longest > 1:
            run = before + some
            for n in range(2, longest + 1):
                # Runs that end among the new words.
                first = max(0, len(before) - n + 1)
                found.update(b" ".join(run[k : k + n]) for k in range(first, len(run) - n + 1))
            before = run[-(longest - 1) :]
    return found


def _texts(batch: pa.RecordBatch, name: str) -> Iterator[bytes]:
    for value in batch.column(name).cast(pa.large_binary()):
        yield value.as_py() or b""


def bucket_counts(docs: DataFrame, buckets: int = BUCKETS, longest: int = 1, text: str = "text") -> dict[int, int]:
    """The number of features in each bucket, over all texts; at most ``buckets`` entries."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, sums = _Buckets(buckets), np.zeros(buckets, np.int64)
        for batch in batches:
            for data in _texts(batch, "text"):
                found = features_of(data, longest)
                at = np.fromiter((known[x] for x in found), np.int64, len(found))
                np.add.at(sums, at, np.fromiter(found.values(), np.int64, len(found)))
        at = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(sums[at])], ["bucket", "n"])

    each = docs.select(F.col(text).alias("text")).mapInArrow(count, "bucket int, n long")
    return {r.bucket: r.n for r in each.groupBy("bucket").agg(F.sum("n").alias("n")).collect()}


def gains(corpus: dict[int, int], target: dict[int, int], buckets: int = BUCKETS) -> np.ndarray:
    """Every bucket's gain: floor(1000 * ln(its smoothed share of the target / its smoothed share of the corpus))."""
    all_corpus, all_target = float(sum(corpus.values()) + buckets), float(sum(target.values()) + buckets)
    ratio = ((target.get(b, 0) + 1.0) * all_corpus / ((corpus.get(b, 0) + 1.0) * all_target) for b in range(buckets))
    return np.array([math.floor(1000.0 * math.log(x)) for x in ratio], np.int64)


def _packed(bits: np.ndarray) -> np.ndarray:
    """Rows of bits as rows of 64-bit words, the last one filled up with zeros."""
    data = np.packbits(bits, axis=1, bitorder="little")
    return np.pad(data, ((0, 0), (0, -data.shape[1] % 8))).view(np.uint64)


def gain_planes(values: np.ndarray) -> tuple[np.ndarray, list[int]]:
    """Planes of the gains in two's complement, and what a bit of each plane counts."""
    bits = max(int(values.max(initial=0)).bit_length(), int(-values.min(initial=0) - 1).bit_length() if len(values) else 0)
    planes = _packed(np.stack([(values >> j) & 1 for j in range(bits + 1)]).astype(np.uint8))
    return planes, [1 << j for j in range(bits)] + [-(1 << bits)]


def weight_sums(counts: list[tuple[np.ndarray, np.ndarray]], planes: np.ndarray, worth: list[int], buckets: int) -> np.ndarray:
    """The sum of gains of each of a few documents, given its buckets and how often each occurs."""
    out = np.zeros(len(counts), np.int64)
    row = np.repeat(np.arange(len(counts)), [len(at) for at, _ in counts])
    at = np.concatenate([at for at, _ in counts]) if counts else np.zeros(0, np.int64)
    n = np.concatenate([n for _, n in counts]) if counts else np.zeros(0, np.int64)
    i = 0
    while len(n) and int(n.max()) >> i:
        held = np.flatnonzero((n >> i) & 1)
        rows, place = np.unique(row[held], return_inverse=True)
        bits = np.zeros((len(rows), buckets), np.uint8)
        bits[place, at[held]] = 1
        plane = _packed(bits)
        for gain, value in zip(planes, worth):
            out[rows] += (value << i) * np.bitwise_count(plane & gain).sum(axis=1, dtype=np.int64)
        i += 1
    return out


def weigh(docs: DataFrame, values: np.ndarray, longest: int = 1, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """doc_id, n_words, n_features and weight of every document."""
    buckets, (planes, worth) = len(values), gain_planes(values)
    schema = docs.select(F.col(doc_id).alias("doc_id")).schema.add("n_words", "long").add("n_features", "long").add("weight", "long")

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _Buckets(buckets)
        for batch in batches:
            words, total, sums, waiting = [], [], [], []
            for data in _texts(batch, "text"):
                found = features_of(data, longest)
                total.append(found.total())
                words.append(sum(n for x, n in found.items() if b" " not in x) if longest > 1 else total[-1])
                places, back = np.unique(np.fromiter((known[x] for x in found), np.int64, len(found)), return_inverse=True)
                n = np.zeros(len(places), np.int64)
                np.add.at(n, back, np.fromiter(found.values(), np.int64, len(found)))
                waiting.append((places, n))
                if len(waiting) == _TOGETHER:
                    sums.append(weight_sums(waiting, planes, worth, buckets))
                    waiting = []
            sums.append(weight_sums(waiting, planes, worth, buckets))
            size = np.array(total, np.int64)
            weight = np.floor_divide(np.concatenate(sums), np.maximum(size, 1))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(np.array(words, np.int64)), pa.array(size), pa.array(weight)],
                ["doc_id", "n_words", "n_features", "weight"],
            )

    return docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).mapInArrow(score, schema)


def noise(doc_id: Column, seed: int) -> Column:
    """Gumbel noise in thousandths, from a hash of the seed and the id."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))).cast("binary"), 256)
    drawn = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((drawn + 0.5) / F.lit(4294967296.0))))


def draw(scored: DataFrame, percent: int, least: int) -> DataFrame:
    """``scored``, stored, with the rank of each of the floor(percent * N / 100) best of the N rows with ``least`` words."""
    able = F.col("n_words") >= least
    # One row a score: whole numbers between the lowest and the highest gain plus noise.
    histogram = scored.where(able).groupBy("score").agg(F.count(F.lit(1)).alias("n")).collect()
    wanted = percent * sum(r.n for r in histogram) // 100
    taken, bar = 0, None
    for score, n in sorted(((r.score, r.n) for r in histogram), reverse=True):
        if taken >= wanted:
            break
        taken, bar = taken + n, score
    undrawn = F.lit(None).cast("long")
    if bar is None:
        return scored.withColumn("rank", undrawn)
    near = F.coalesce(able & (F.col("score") >= bar), F.lit(False))
    order = {"_score": -F.col("score"), "_null": F.col("doc_id").isNull(), "_id": F.col("doc_id")}
    # Rows alike in id and score are spread by a number of their own.
    ordered = scored.where(near).withColumns(order).withColumn("_tie", F.monotonically_increasing_id())
    ranked = identity_ids(ordered, [*order, "_tie"], "rank", 1).drop(*order, "_tie")
    ranked = ranked.withColumn("rank", F.when(F.col("rank") <= wanted, F.col("rank")))
    return ranked.select(*scored.columns, "rank").unionByName(scored.where(~near).withColumn("rank", undrawn))


def resample(
    docs: DataFrame,
    target: DataFrame,
    percent: int = 10,
    least: int = 20,
    longest: int = 1,
    buckets: int = BUCKETS,
    seed: int = 2024,
    text: str = "text",
    doc_id: str = "doc_id",
) -> DataFrame:
    """One row per document: doc_id, n_features, weight, score, rank (null where it isn't drawn)."""
    values = gains(bucket_counts(docs, buckets, longest, text), bucket_counts(target, buckets, longest), buckets)
    weighed = weigh(docs, values, longest, text, doc_id)
    scored = stored(weighed.withColumn("score", F.col("weight") + noise(F.col("doc_id"), seed)), "scores")
    return draw(scored, percent, least).select("doc_id", "n_features", "weight", "score", "rank")

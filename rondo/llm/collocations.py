"""Phrase collocations by SETM: relations of occurrences, extended word by word, of which only frequent groups go on.

Texts are cut into pieces at punctuation and line ends, pieces into words; a phrase never leaves its piece. One pass counts words.
A second one writes the first relation: occurrences of frequent words in the order of piece and position, in blocks of one document
each (a block is cut after ``BLOCK`` words, with as many more as a phrase may need). Every next length is

1. a merge join of the stored relation with itself on piece and adjacent position: blocks are sorted, so a word's successor is the
   next element, and two overlapping phrases of length k - 1 make one of length k;
2. a group count, summed in the task first and by Spark over all tasks. Most phrases occur a few times, so occurrences are counted
   by short hashes first, and only phrases of hashes with ``least`` occurrences are counted by their words; groups under ``least`` go;
3. a semi-join of the occurrences with the frequent groups, whose result is stored as the next relation.

The semi-join takes a Bloom filter of the frequent groups, of bounded size whatever the data; an occurrence it lets through in
error is counted in the next step and found infrequent. Words are 64-bit hashes of language and word, checked to differ for all
words of the corpus and drawn anew if two meet. Phrases are grouped by their words, so counts are exact.

Memory: a slice of a text, or ``TOGETHER`` occurrences, at a time in a task. Occurrences never move between tasks, only
partial counts do, so a hot word or language costs a row a task.

Defined cases: a null text has no words. A null language is ``und``, the same as one of that name. Rows repeated in full count each.
Control characters other than tab and line ends are parts of words. Extra columns are ignored. Empty tables give empty results.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from itertools import count as numbers

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rondo.llm import bloom
from rondo.llm.store import stored
from rondo.llm.words import SLICE, mix

_U = np.uint64
_ALL = (1 << 64) - 1
#: Words a block of occurrences owns at most.
BLOCK = 1 << 16
#: Occurrences a task groups at a time.
TOGETHER = 1 << 19
#: Distinct words a task counts before it passes them on, and frequent ones it remembers for a language.
_DISTINCT = 200_000
_REMEMBERED = 100_000
#: Languages whose words a task remembers.
_LANGS = 20
#: A-Z become a-z, what ends a piece a full stop, a tab a space.
_PIECE_BYTES = bytes(
    c + 32 if 65 <= c <= 90 else 46 if c in b".,;:!?\n\x0b\x0c\r" else 32 if c == 9 else c for c in range(256)
)
_RELATION = "own int, w array<bigint>, starts array<boolean>"


def tokens(data: bytes) -> Iterator[list[bytes]]:
    """The words of a text, some at a time, with a full stop where a piece ends."""
    begin, carried = 0, b""
    while begin < len(data):
        part = carried + data[begin : begin + SLICE].translate(_PIECE_BYTES)
        begin += SLICE
        cut = len(part) if begin >= len(data) else max(part.rfind(b" "), part.rfind(b".")) + 1
        carried = part[cut:]
        # split(b" ") and not split(): some control characters count as white space there.
        yield [x for x in part[:cut].replace(b".", b" . ").split(b" ") if x]


@lru_cache(1000)
def _lang_key(lang: bytes, seed: int) -> bytes:
    return hashlib.blake2b(lang, digest_size=32, salt=seed.to_bytes(8, "little")).digest()


def word_hash(lang: bytes, word: bytes, seed: int) -> int:
    digest = hashlib.blake2b(word, digest_size=8, key=_lang_key(lang, seed)).digest()
    return int.from_bytes(digest, "little", signed=True)


def _rows(batch: pa.RecordBatch) -> Iterator[tuple[bytes, bytes]]:
    langs, texts = (batch.column(c).cast(pa.large_binary()) for c in ("lang", "text"))
    for lang, text in zip(langs, texts):
        yield lang.as_py(), text.as_py()


def _texts(docs: DataFrame, text: str, lang: str) -> DataFrame:
    known = F.coalesce(F.col(lang).cast("string"), F.lit("und"))
    return docs.select(known.alias("lang"), F.col(text).alias("text")).where("text IS NOT NULL")


def count_words(texts: DataFrame) -> DataFrame:
    """lang, word and number of occurrences of every word."""

    def emit(sums: dict[bytes, Counter]) -> pa.RecordBatch:
        langs = [lang for lang, own in sums.items() for _ in own]
        words = [w for own in sums.values() for w in own]
        n = [k for own in sums.values() for k in own.values()]
        arrays = [pa.array(x, pa.binary()).cast(pa.string()) for x in (langs, words)]
        return pa.RecordBatch.from_arrays([*arrays, pa.array(n, pa.int64())], ["lang", "word", "f"])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[bytes, Counter] = {}
        for batch in batches:
            for lang, data in _rows(batch):
                own = sums.setdefault(lang, Counter())
                for some in tokens(data):
                    own.update(some)
                del own[b"."]
                if sum(map(len, sums.values())) > _DISTINCT:
                    yield emit(sums)
                    sums = {}
        yield emit(sums)

    each = texts.mapInArrow(work, "lang string, word string, f long")
    return each.groupBy("lang", "word").agg(F.sum("f").alias("f"))


def hashed_words(words: DataFrame) -> tuple[DataFrame, int]:
    """``words`` with h, a hash no two of them share and none has 0 for, and the seed of the hash."""
    for seed in numbers():

        def work(batches: Iterator[pa.RecordBatch], seed: int = seed) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                langs, own = (batch.column(c).cast(pa.binary()).to_pylist() for c in ("lang", "word"))
                h = pa.array([word_hash(a, b, seed) for a, b in zip(langs, own)], pa.int64())
                yield pa.RecordBatch.from_arrays([*batch.columns, h], [*batch.schema.names, "h"])

        found = stored(words.mapInArrow(work, "lang string, word string, f long, h long"), "words")
        if found.groupBy("h").agg(F.count(F.lit(1)).alias("n")).where("n > 1 OR h = 0").isEmpty():
            return found, seed
    raise AssertionError


class _Maybe:
    """A Bloom filter in numpy, laid out as ``bloom`` does."""

    def __init__(self, bits: np.ndarray):
        self.bits, self.shift = bits, _U(64 - (len(bits).bit_length() - 1))

    def has(self, hashed: np.ndarray) -> np.ndarray:
        one = _U(1)
        mask = (one << (hashed & _U(63))) | (one << ((hashed >> _U(6)) & _U(63)))
        return (self.bits[(hashed >> self.shift).astype(np.int64)] & mask) == mask

    def has_one(self, hashed: int) -> bool:
        """The same of one signed number, without numpy's cost for short arrays."""
        mask = (1 << (hashed & 63)) | (1 << (hashed >> 6 & 63))
        return int(self.bits[(hashed & _ALL) >> int(self.shift)]) & mask == mask


def _filter(frequent: DataFrame, name: str) -> Broadcast:
    """The filter of a table's hashes for the tasks: ``bloom.MAX_WORDS`` words at most."""
    words = bloom.words_for(frequent.count())
    table = bloom.members(frequent, F.col(name), words).toArrow()
    bits = np.zeros(words, _U)
    bits[table.column("_word").to_numpy()] = table.column("_bits").to_numpy().view(_U)
    return frequent.sparkSession.sparkContext.broadcast(bits)


class _Known(dict):
    """The hash of a word if it may be frequent, else 0. Words that may be are remembered for the next time."""

    def __init__(self, lang: bytes, seed: int, maybe: _Maybe):
        self.lang, self.seed, self.maybe = lang, seed, maybe
        self[b"."] = 0

    def __missing__(self, word: bytes) -> int:
        h = word_hash(self.lang, word, self.seed)
        if not self.maybe.has_one(h):
            return 0
        if len(self) >= _REMEMBERED:
            self.clear()
            self[b"."] = 0
        self[word] = h
        return h


def _follows(flags: np.ndarray) -> np.ndarray:
    """Flags of the next position."""
    return np.append(flags[1:], False)


def _squeezed(own: int, w: np.ndarray, starts: np.ndarray, k: int) -> tuple[int, np.ndarray, np.ndarray]:
    """A block without words that no phrase of length ``k`` can cover: a 0 in place of each run of them."""
    cover = starts.copy()
    for j in range(1, k):
        cover[j:] |= starts[:-j]
    w = np.where(cover, w, 0)
    keep = cover.copy()
    keep[1:] |= cover[:-1]
    return int(keep[:own].sum()), w[keep], starts[keep]


def _relation(blocks: list[tuple[int, np.ndarray, np.ndarray]]) -> pa.RecordBatch:
    offsets = pa.array(np.cumsum([0, *(len(w) for _, w, _ in blocks)]), pa.int32())
    joined = [np.concatenate([x[i] for x in blocks]) if blocks else np.zeros(0, t) for i, t in ((1, np.int64), (2, bool))]
    lists = [pa.ListArray.from_arrays(offsets, pa.array(x)) for x in joined]
    return pa.RecordBatch.from_arrays([pa.array([x[0] for x in blocks], pa.int32()), *lists], ["own", "w", "starts"])


def first_relation(texts: DataFrame, frequent: Broadcast, seed: int, longest: int) -> DataFrame:
    """Blocks of frequent words in order; ``starts`` says where two of them are neighbours in a piece."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[bytes, _Known] = {}
        for batch in batches:
            blocks, size = [], 0
            for lang, data in _rows(batch):
                if lang not in known:
                    if len(known) >= _LANGS:
                        known.clear()
                    known[lang] = _Known(lang, seed, _Maybe(frequent.value))
                look = known[lang]
                parts = [np.array([look[x] for x in some], np.int64) for some in tokens(data)]
                w = np.concatenate([*parts, np.zeros(1, np.int64)])
                for begin in range(0, len(w), BLOCK):
                    part = w[begin : begin + BLOCK + longest - 1]
                    starts = (part != 0) & _follows(part != 0)
                    block = _squeezed(min(BLOCK, len(part)), part, starts, 2)
                    if block[2][: block[0]].any():
                        blocks.append(block)
                        size += len(block[1])
                if size > TOGETHER:
                    yield _relation(blocks)
                    blocks, size = [], 0
            yield _relation(blocks)

    return texts.mapInArrow(work, _RELATION)


def _blocks(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Some blocks joined, each followed by a 0: first positions, numbers of own words, words, starts."""
    own = batch.column("own").to_numpy()
    offsets = batch.column("w").offsets.to_numpy()
    w = batch.column("w").values.to_numpy()
    starts = batch.column("starts").values.to_numpy(zero_copy_only=False)
    begin = 0
    while begin < len(own):
        end = max(begin + 1, int(np.searchsorted(offsets, offsets[begin] + TOGETHER, "right")) - 1)
        sizes = np.diff(offsets[begin : end + 1])
        at = np.arange(offsets[end] - offsets[begin]) + np.repeat(np.arange(end - begin), sizes)
        first = np.concatenate([[0], np.cumsum(sizes + 1)])[:-1]
        joined = np.zeros(int(sizes.sum()) + end - begin, np.int64), np.zeros(int(sizes.sum()) + end - begin, bool)
        joined[0][at], joined[1][at] = w[offsets[begin] : offsets[end]], starts[offsets[begin] : offsets[end]]
        yield first, own[begin:end], *joined
        begin = end


def _phrase_hash(w: np.ndarray, at: np.ndarray, k: int) -> np.ndarray:
    g = np.zeros(len(at), _U)
    for j in range(k):
        g = mix(g * _U(0x9E3779B97F4A7C15) + w[at + j].view(_U))
    return g


def _summed(parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes, phrases and numbers, summed by phrase. Phrases are equal if all their words are."""
    g, phrases, n = (np.concatenate([x[i] for x in parts]) for i in range(3))
    order = np.argsort(g, kind="stable")
    g, phrases, n = g[order], phrases[order], n[order]
    first = np.flatnonzero(np.append(True, g[1:] != g[:-1])) if len(g) else np.zeros(0, np.int64)
    if (phrases != np.repeat(phrases[first], np.diff(np.append(first, len(g))), axis=0)).any():
        _, first, group = np.unique(phrases, axis=0, return_index=True, return_inverse=True)
        return g[first], phrases[first], np.bincount(group, n).astype(np.int64)
    return g[first], phrases[first], np.add.reduceat(n, first) if len(g) else n


def _bucket(g: np.ndarray) -> np.ndarray:
    """34 bits of a hash, laid where a Bloom filter looks for them; the others are 0 and cost nothing to store."""
    return (g >> _U(42) << _U(42)) | (g >> _U(30) & _U(0xFFF))


def _owned(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Words, and where the phrases of the blocks' own words start, some blocks at a time."""
    for first, own, w, starts in _blocks(batch):
        inside = np.zeros(len(w) + 1, np.int64)
        np.add.at(inside, first, 1)
        np.add.at(inside, first + own, -1)
        yield w, np.flatnonzero(starts & (np.cumsum(inside)[:-1] > 0))


def crowded_buckets(relation: DataFrame, k: int, least: int) -> DataFrame:
    """Buckets of phrase hashes that hold ``least`` occurrences or more; every frequent phrase is in one of them."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for w, at in _owned(batch):
                bucket, n = np.unique(_bucket(_phrase_hash(w, at, k)), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(bucket.view(np.int64)), pa.array(n)], ["bucket", "n"])

    each = relation.mapInArrow(work, "bucket long, n long")
    return each.groupBy("bucket").agg(F.sum("n").alias("n")).where(F.col("n") >= least)


def _batch(g: np.ndarray, phrases: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
    offsets = pa.array(np.arange(len(g) + 1) * phrases.shape[1], pa.int32())
    lists = pa.ListArray.from_arrays(offsets, pa.array(phrases.ravel()))
    return pa.RecordBatch.from_arrays([pa.array(g.view(np.int64)), lists, pa.array(n)], ["g", "words", "f"])


def count_phrases(relation: DataFrame, crowded: Broadcast, k: int, least: int, tasks: int) -> DataFrame:
    """g (hash), words and f of every phrase of ``k`` words that occurs ``least`` times or more.

    A task passes on a row a phrase, so the relation is read in ``tasks`` parts, fewer than it has files.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        maybe, held = _Maybe(crowded.value), []
        for batch in batches:
            for w, at in _owned(batch):
                g = _phrase_hash(w, at, k)
                crowd = maybe.has(_bucket(g))
                at, g = at[crowd], g[crowd]
                held.append((g, np.stack([w[at + j] for j in range(k)], axis=1), np.ones(len(at), np.int64)))
                if sum(len(x[0]) for x in held) >= 2 * TOGETHER:
                    held = [_summed(held)]
                    if len(held[0][0]) >= TOGETHER:
                        yield _batch(*held.pop())
        if held:
            yield _batch(*_summed(held))

    each = relation.coalesce(tasks).mapInArrow(work, "g long, words array<bigint>, f long")
    return each.groupBy("g", "words").agg(F.sum("f").alias("f")).where(F.col("f") >= least)


def next_relation(relation: DataFrame, frequent: Broadcast, k: int) -> DataFrame:
    """Occurrences whose phrase of ``k`` words, and the one a word further on, may both be frequent."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        maybe = _Maybe(frequent.value)
        for batch in batches:
            for first, own, w, starts in _blocks(batch):
                at = np.flatnonzero(starts)
                held = np.zeros(len(w), bool)
                held[at[maybe.has(_phrase_hash(w, at, k))]] = True
                further = held & _follows(held)
                blocks = []
                for begin, n, end in zip(first, own, [*first[1:], len(w)]):
                    if further[begin : begin + n].any():
                        blocks.append(_squeezed(n, w[begin:end], further[begin:end], k + 1))
                yield _relation(blocks)

    return relation.mapInArrow(work, _RELATION)


def frequent_phrases(texts: DataFrame, longest: int, least: int, part: int = 1 << 24) -> tuple[DataFrame, list[DataFrame]]:
    """The words (lang, word, f, h), and the frequent phrases of each length from 2 on (words, f), all stored.

    ``part`` is the number of the corpus's words a task counts phrases of, about 100 MB of text.
    """
    words, seed = hashed_words(count_words(texts))
    tasks = 1 + (words.agg(F.sum("f")).first()[0] or 0) // part
    known = _filter(words.where(F.col("f") >= least), "h")
    found, relation = [], stored(first_relation(texts, known, seed, longest), "occurrences-1")
    for k in range(2, longest + 1):
        crowded = _filter(stored(crowded_buckets(relation, k, least), f"buckets-{k}"), "bucket")
        found.append(stored(count_phrases(relation, crowded, k, least, tasks), f"phrases-{k}"))
        if k < longest:
            relation = stored(next_relation(relation, _filter(found[-1], "g"), k), f"occurrences-{k}")
    return words, [f.select("words", "f") for f in found]


def _uncovered(found: list[DataFrame], cover: int) -> DataFrame:
    """Phrases (words, a) in no longer frequent one that is ``cover`` % as frequent or more.

    The next length decides: whatever lies between a phrase and a longer one is at least as frequent as the longer.
    """
    out = None
    for k, own in enumerate(found, 2):
        left = own.withColumnRenamed("f", "a")
        if k - 1 < len(found):
            longer = found[k - 1].select(F.explode(F.array(F.slice("words", 1, k), F.slice("words", 2, k))).alias("words"), "f")
            most = longer.groupBy("words").agg(F.max("f").alias("_most"))
            left = left.join(most, "words", "left").where(F.expr(f"_most IS NULL OR 100 * _most < {cover} * a")).drop("_most")
        out = left if out is None else out.unionByName(left)
    return out


def _spelled(phrases: DataFrame, words: DataFrame, least: int) -> DataFrame:
    """``phrases`` with their language and text."""
    names = words.where(F.col("f") >= least).select("h", "lang", "word")
    each = phrases.select("words", "a", F.posexplode("words").alias("pos", "h")).join(names, "h")
    parts = F.sort_array(F.collect_list(F.struct("pos", "word")))["word"]
    spelled = each.groupBy("words", "a").agg(F.min("lang").alias("lang"), parts.alias("_parts"))
    return spelled.withColumn("phrase", F.array_join("_parts", " ")).drop("_parts")


def _scored(phrases: DataFrame, words: DataFrame, found: list[DataFrame]) -> DataFrame:
    """``phrases`` (words, a, lang, phrase, n) with l, r and score of the cut that scores lowest."""
    known = words.select(F.array("h").alias("part"), "f")
    for own in found:
        known = known.unionByName(own.select(F.col("words").alias("part"), "f"))
    cut = phrases.select("words", "a", "n", F.explode(F.sequence(F.lit(1), F.size("words") - 1)).alias("cut"))
    rest = F.slice("words", F.col("cut") + 1, F.size("words") - F.col("cut"))
    sides = F.array(F.struct(F.lit(True).alias("left"), F.slice("words", F.lit(1), F.col("cut")).alias("part")),
                    F.struct(F.lit(False).alias("left"), rest.alias("part")))
    each = cut.withColumn("_side", F.explode(sides)).select("words", "a", "n", "cut", "_side.*").join(known, "part")
    both = each.groupBy("words", "a", "n", "cut").agg(
        F.max(F.when(F.col("left"), F.col("f"))).alias("l"), F.max(F.when(~F.col("left"), F.col("f"))).alias("r")
    )
    # Decimals: 1000 * a * n passes 64 bits. The quotient is at most 1000 * n / max(l, r) and does not.
    wide = lambda c: F.col(c).cast("decimal(18,0)")
    score = F.call_function("div", F.lit(1000) * wide("a") * wide("n"), wide("l") * wide("r"))
    best = both.withColumn("score", score).groupBy("words").agg(F.min(F.struct("score", "cut", "l", "r")).alias("_best"))
    return phrases.join(best.select("words", "_best.score", "_best.l", "_best.r"), "words")


def collocations(
    docs: DataFrame,
    longest: int = 5,
    least: int = 100,
    cover: int = 100,
    top: int = 2000,
    text: str = "text",
    lang: str = "lang",
) -> DataFrame:
    """Each language's ``top`` phrases of 2 to ``longest`` words: lang, rank, phrase, a, l, r, n, score."""
    words, found = frequent_phrases(_texts(docs, text, lang), longest, least)
    totals = words.groupBy("lang").agg(F.sum("f").alias("n"))
    spelled = stored(_spelled(_uncovered(found, cover), words, least).join(totals, "lang"), "phrases")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = _scored(spelled, words.where(F.col("f") >= least), found).withColumn("rank", F.row_number().over(order))
    return ranked.where(F.col("rank") <= top).select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", F.col("score").cast("long").alias("score")
    )

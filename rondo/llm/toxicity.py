"""Toxicity by non-negative positive-unlabelled learning.

Confirmed toxic texts are the positives; texts drawn from the whole table, whatever they are, the unlabelled ones. The
risk of a classifier g under the class prior p is p * R_pos(+) + max(0, R_unl(-) - p * R_pos(-)): the unlabelled texts
stand in for the negatives after the positives among them are taken off, and the difference is kept from turning
negative. Several small numpy classifiers are trained on different parts of both sets and averaged.

Features are hashed words and word prefixes found once, twice or four times and more. Only features that are clearly more frequent in positive
than in unlabelled texts get a weight, so a long text isn't judged by the sum of thousands of tiny ones.

The classifier is fitted on at most ``max_positive`` and ``max_unlabelled`` texts, taken in the order of a hash of the
id; all texts are scored whole. Defined cases: null and empty texts get the score of a text without any feature. Ids
may be null or repeated; such rows are scored like all others. Without a usable label every text is scored 0. Extra
columns are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rondo.llm.words import word_hashes

PREFIXES = (4, 5, 6, 7)
BITS = 20
#: A feature is used if chance explains its frequency in positive texts with odds of less than about exp(-CLEAR).
CLEAR = 7.0
#: A feature is told apart by whether it occurs so many times in the text.
LEVELS = (1, 2, 4)


def held_out(doc_id: Column) -> Column:
    """Rows whose labels are never learned from. A null id counts as held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(True))


def _slots(texts: pa.Array) -> Iterator[np.ndarray]:
    """Hash slots of each text's words and prefixes, with repeats."""
    for _, words, prefixes in word_hashes(texts, PREFIXES):
        yield (np.concatenate([words, *prefixes]) >> np.uint64(64 - BITS)).astype(np.int64)


def _levels(slots: np.ndarray) -> np.ndarray:
    """Distinct features of a text: a slot found once or more, twice or more, four times or more."""
    found, times = np.unique(slots, return_counts=True)
    return np.concatenate([found[times >= least] + (level << BITS) for level, least in enumerate(LEVELS)])


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """In how many positive and unlabelled texts each feature occurs, per task."""
    found = np.zeros((2, len(LEVELS) << BITS), np.int32)
    for batch in batches:
        for kind, slots in zip(batch.column("kind").to_pylist(), _slots(batch.column("text"))):
            found[kind][_levels(slots)] += 1
    some = np.flatnonzero(found.any(0))
    yield pa.RecordBatch.from_arrays([pa.array(x.astype(np.int64)) for x in (some, found[0][some], found[1][some])], ["slot", "u", "p"])


def _chosen_in(chosen: np.ndarray):
    """Function from a text's slots to the places of its features among the chosen ones."""
    place = np.full(len(LEVELS) << BITS, -1, np.int32)
    place[chosen] = np.arange(len(chosen))
    wanted = np.zeros(1 << BITS, bool)
    wanted[chosen & ((1 << BITS) - 1)] = True

    def found(slots: np.ndarray) -> np.ndarray:
        at = place[_levels(slots[wanted[slots]])]
        return at[at >= 0]

    return found


def _pick(chosen: np.ndarray):
    """Which of the chosen features each text has, as bytes of int32."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = _chosen_in(chosen)
        for batch in batches:
            rows = [found(slots).tobytes() for slots in _slots(batch.column("text"))]
            yield pa.RecordBatch.from_arrays([batch.column("kind"), pa.array(rows, pa.binary())], ["kind", "found"])

    return run


def train(
    positive: list[np.ndarray], unlabelled: list[np.ndarray], size: int, prior: float, steps: int = 800, decay: float = 1e-4
) -> np.ndarray:
    """Weights and, last, the bias of one logistic classifier with the least non-negative risk, by Adam."""

    def sparse(rows):
        of = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
        return of, np.concatenate(rows) if len(rows) else np.zeros(0, np.int32), len(rows)

    sets = sparse(positive), sparse(unlabelled)
    weights, first, second = np.zeros(size + 1), np.zeros(size + 1), np.zeros(size + 1)
    weights[-1] = np.log(prior / (1 - prior))
    sigmoid = lambda x: 0.5 * (1 + np.tanh(x / 2))
    for step in range(1, steps + 1):
        scores = [np.bincount(of, weights[at], n) + weights[-1] for of, at, n in sets]
        # The sigmoid loss of a score s is sigmoid(s) for a negative and sigmoid(-s) for a positive text. It is bounded,
        # so positives scored high can't make the estimate of the negatives' risk small by themselves.
        chance = [sigmoid(s) for s in scores]
        slope = [c * (1 - c) for c in chance]
        negative_part = chance[1].mean() - prior * chance[0].mean()
        on_positive, on_unlabelled = -prior * slope[0], np.zeros(len(scores[1]))
        if negative_part >= 0:
            on_positive = on_positive - prior * slope[0]
            on_unlabelled = slope[1]
        else:  # the estimate fell below zero: step back along it
            on_positive = prior * slope[0]
            on_unlabelled = -slope[1]
        gradient = decay * weights
        gradient[-1] = 0
        for (of, at, n), g in zip(sets, (on_positive, on_unlabelled)):
            gradient[:-1] += np.bincount(at, g[of] / n, size)
            gradient[-1] += g.mean()
        first = 0.9 * first + 0.1 * gradient
        second = 0.999 * second + 0.001 * gradient**2
        weights -= 0.05 * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
    return weights


def fit(
    docs: DataFrame,
    labels: DataFrame,
    text: str = "text",
    doc_id: str = "doc_id",
    toxic: str = "toxic",
    max_positive: int = 4000,
    max_unlabelled: int = 16000,
    max_features: int = 2000,
    models: int = 3,
) -> tuple[np.ndarray, np.ndarray]:
    """Chosen features and, a row each, the weights of every classifier. Held-out rows take no part."""
    learn = ~held_out(F.col("id"))
    drawn = lambda rows, n: rows.where(learn).orderBy(F.xxhash64("id"), "id").limit(n)
    known = labels.select(F.col(doc_id).alias("id"), F.col(toxic).alias("toxic")).where(learn & F.col("toxic").isNotNull())
    share = known.agg(F.avg((F.col("toxic") == 1).cast("double"))).first()[0]
    none = np.zeros(0, np.int64), np.zeros((0, 1))
    if not share:
        return none
    prior = min(max(share, 1e-4), 0.5)
    texts = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text"))
    positives = drawn(known.where("toxic = 1").select("id").distinct(), max_positive)
    unlabelled = drawn(texts.select("id"), max_unlabelled)
    # Both id lists have at most as many rows as their bounds say.
    wanted = positives.withColumn("kind", F.lit(1)).unionByName(unlabelled.distinct().withColumn("kind", F.lit(0)))
    sample = texts.join(F.broadcast(wanted), "id").select("kind", "text").dropDuplicates(["kind", "text"])
    counted = sample.mapInArrow(_count, "slot long, u long, p long").groupBy("slot").agg(F.sum("u").alias("u"), F.sum("p").alias("p"))
    kinds = {r[0]: r[1] for r in sample.groupBy("kind").count().collect()}
    if not kinds.get(1) or not kinds.get(0):
        return none
    # How often the feature would be in so many negative texts, after the prior's share of positives is taken off the
    # unlabelled ones, and the log of the odds against finding it in the positive ones as often by chance.
    ratio = kinds[1] / kinds[0]
    by_chance = F.greatest(F.col("u") * ratio - F.col("p") * prior, F.lit(0.0)) / (1 - prior) + 1.5 * ratio
    rank = F.col("p") * F.log(F.col("p") / by_chance) - (F.col("p") - by_chance)
    best = counted.where(F.col("p") > by_chance).withColumn("rank", rank).where(F.col("rank") >= CLEAR)
    chosen = np.array([r[0] for r in best.orderBy(F.desc("rank"), "slot").limit(max_features).select("slot").collect()], np.int64)
    rows = sample.mapInArrow(_pick(chosen), "kind int, found binary").collect()
    rows = sorted((r.kind, bytes(r.found)) for r in rows)  # any order of arrival gives the same model
    sets = [[np.frombuffer(f, np.int32) for k, f in rows if k == kind] for kind in (1, 0)]
    if not sets[0] or not sets[1]:
        return none
    weights = []
    for m in range(models):
        order = [np.random.default_rng(m).permutation(len(s)) for s in sets]
        part = [[s[i] for i in o[: max(1, len(s) * 4 // 5)]] for s, o in zip(sets, order)]
        weights.append(train(*part, len(chosen), prior))
    return chosen, np.array(weights)


def _scored(
    batches: Iterator[pa.RecordBatch], chosen: np.ndarray, weights: np.ndarray, text: str
) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Pieces of the batches and their scores; short ones keep the copies on their way out small."""
    found = _chosen_in(chosen)
    for batch in (whole.slice(at, 1000) for whole in batches for at in range(0, whole.num_rows, 1000)):
        scores = np.zeros(batch.num_rows)
        if len(weights):
            for i, slots in enumerate(_slots(batch.column(text))):
                raw = weights[:, found(slots)].sum(1) + weights[:, -1]
                scores[i] = (0.5 * (1 + np.tanh(raw / 2))).mean()
        yield batch, scores


def _scorer(chosen: np.ndarray, weights: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, scores in _scored(batches, chosen, weights, "_text"):
            kept = [batch.column(i) for i in range(batch.num_columns - 1)]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(scores)], [*batch.schema.names[:-1], "_score"])

    return run


def score(docs: DataFrame, model: tuple[np.ndarray, np.ndarray], keep: list[str], text: str = "text") -> DataFrame:
    """The columns ``keep`` and ``_score``, 0 to 1, of every row."""
    rows = docs.select(*keep, F.col(text).alias("_text"))
    schema = rows.drop("_text").schema.add("_score", "double")
    return rows.mapInArrow(_scorer(*model), schema)


def toxicity(docs: DataFrame, labels: DataFrame, text: str = "text", doc_id: str = "doc_id", toxic: str = "toxic") -> DataFrame:
    """doc_id, held_out, score, predicted for every document."""
    model = fit(docs, labels, text, doc_id, toxic)
    scored = score(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")), model, ["doc_id"])
    return scored.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        F.col("_score").alias("score"),
        (F.col("_score") >= 0.5).cast("int").alias("predicted"),
    )


def drop_toxic(docs: DataFrame, labels: DataFrame, text: str = "text", doc_id: str = "doc_id", toxic: str = "toxic") -> DataFrame:
    """Documents scored below one half, with all their columns; nothing is shuffled, and a text goes to Python once."""
    chosen, weights = fit(docs, labels, text, doc_id, toxic)
    own = docs.select(text).columns[0]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, scores in _scored(batches, chosen, weights, own):
            yield batch.filter(pa.array(scores < 0.5))

    return docs.mapInArrow(run, docs.schema)

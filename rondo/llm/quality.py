"""Quality by ordinal cumulative-link regression on graded ratings.

All grades share one weight vector over hashed text features; ordered thresholds cut its score into grades:
P(grade > k) = sigmoid(score - threshold[k]). That gives each text an expected grade and, for selection, the probability
of a grade of at least ``least``.

Features are hashed words and shapes of word endings, as the root of their share of the text's words, and four times the
share of words that repeat the word or the word run before, so length alone says nothing.

The model is fitted on at most ``max_rated`` rated texts, taken in the order of a hash of the id; all texts are scored
whole. Defined cases: null and empty texts have no features and are scored by the thresholds alone. Null and repeated ids are
scored like others. Without ratings, or with one grade only, every text gets that grade (0 if none) and is selected
if it is high enough. Extra columns are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rondo.llm.words import shingles, word_hashes

BITS = 13
#: Two features beyond the hashed ones: words equal to the one before, and word triples found before in the text.
SIZE = (1 << BITS) + 2


def _features(texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Slots and values of each text."""
    for _, words, extra in word_hashes(texts, (), endings=True):
        n = len(words)
        if not n:
            yield np.zeros(0, np.int32), np.zeros(0, np.float32)
            continue
        hashed = np.concatenate([words, *extra]) >> np.uint64(64 - BITS)
        slots, times = np.unique(hashed.astype(np.int32), return_counts=True)
        again = (words[1:] == words[:-1]).sum() / n
        seen = 1 - len(shingles(words, 3)) / max(1, n - 2)
        slots = np.append(slots, np.array([SIZE - 2, SIZE - 1], np.int32))
        yield slots, np.append(np.sqrt(times / n), [4 * again, 4 * max(0.0, seen)]).astype(np.float32)


def _vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [(s.tobytes(), v.tobytes()) for s, v in _features(batch.column("text"))]
        columns = [batch.column("grade"), *(pa.array(c, pa.binary()) for c in (zip(*rows) if rows else ([], [])))]
        yield pa.RecordBatch.from_arrays(columns, ["grade", "slots", "shares"])


def train(
    rows: list[tuple[np.ndarray, np.ndarray]], grades: np.ndarray, levels: int, steps: int = 300, decay: float = 1e-3
) -> tuple[np.ndarray, np.ndarray]:
    """Weights and ordered thresholds of the greatest likelihood, with a penalty on the weights, by Adam."""
    of = np.repeat(np.arange(len(rows)), [len(s) for s, _ in rows])
    slots, shares = (np.concatenate(c) for c in zip(*rows))
    share_above = np.array([(grades > k).mean() for k in range(levels - 1)]).clip(1e-3, 1 - 1e-3)
    # The first threshold and the logs of the steps to the next ones are learned, which keeps them in order.
    cuts = -np.log(share_above / (1 - share_above))
    free = np.append(cuts[:1], np.log(np.maximum(np.diff(cuts), 1e-2)))
    size = SIZE + len(free)
    at, first, second = np.append(np.zeros(SIZE), free), np.zeros(size), np.zeros(size)
    sigmoid = lambda x: 0.5 * (1 + np.tanh(x / 2))
    n = len(rows)
    for step in range(1, steps + 1):
        weights, free = at[:SIZE], at[SIZE:]
        thresholds = np.cumsum(np.append(free[:1], np.exp(free[1:])))
        score = np.bincount(of, weights[slots] * shares, n)
        # P(grade <= k) for k = -1 .. levels - 1, and its density at each inner threshold.
        below = np.hstack([np.zeros((n, 1)), sigmoid(thresholds[None, :] - score[:, None]), np.ones((n, 1))])
        density = below * (1 - below)
        every = np.arange(n)
        mass = np.maximum(below[every, grades + 1] - below[every, grades], 1e-9)
        on_score = (density[every, grades + 1] - density[every, grades]) / mass / n
        on_cut = np.zeros(levels + 1)
        np.add.at(on_cut, grades + 1, -density[every, grades + 1] / mass / n)
        np.add.at(on_cut, grades, density[every, grades] / mass / n)
        tail = np.cumsum(on_cut[1:-1][::-1])[::-1]
        gradient = np.append(
            np.bincount(slots, on_score[of] * shares, SIZE) + decay * weights, np.append(tail[:1], tail[1:] * np.exp(free[1:]))
        )
        first = 0.9 * first + 0.1 * gradient
        second = 0.999 * second + 0.001 * gradient**2
        at = at - 0.05 * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
    free = at[SIZE:]
    return at[:SIZE], np.cumsum(np.append(free[:1], np.exp(free[1:])))


def fit(docs: DataFrame, ratings: DataFrame, text: str = "text", doc_id: str = "doc_id", grade: str = "grade", max_rated: int = 6000):
    """Weights, thresholds and the grades they stand for."""
    rated = ratings.select(F.col(doc_id).alias("id"), F.col(grade).cast("int").alias("grade")).where("grade IS NOT NULL")
    # At most max_rated rows.
    drawn = rated.groupBy("id").agg(F.min("grade").alias("grade")).orderBy(F.xxhash64("id"), "id").limit(max_rated)
    texts = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text"))
    sample = texts.join(F.broadcast(drawn), "id").select("grade", "text")
    rows = sample.mapInArrow(_vectors, "grade int, slots binary, shares binary").collect()
    rows = sorted((r.grade, bytes(r.slots), bytes(r.shares)) for r in rows)  # any order of arrival gives the same model
    known = sorted({r[0] for r in rows})
    if len(known) < 2:
        return np.zeros(SIZE), np.zeros(0), known or [0]
    vectors = [(np.frombuffer(s, np.int32), np.frombuffer(v, np.float32)) for _, s, v in rows]
    weights, thresholds = train(vectors, np.searchsorted(known, [r[0] for r in rows]), len(known))
    return weights, thresholds, known


def _scorer(weights: np.ndarray, thresholds: np.ndarray, known: list[int], least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = np.array([float((weights[s] * v).sum()) for s, v in _features(batch.column("_text"))])
            above = 0.5 * (1 + np.tanh((scores[:, None] - thresholds[None, :]) / 2))
            expected = known[0] + above @ np.diff(known) if len(known) > 1 else np.full(len(scores), float(known[0]))
            at = int(np.searchsorted(known, least))
            tail = np.ones(len(scores)) if at == 0 else above[:, at - 1] if at < len(known) else np.zeros(len(scores))
            kept = [batch.column(i) for i in range(batch.num_columns - 1)]
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(expected), pa.array(tail)], [*batch.schema.names[:-1], "expected_grade", "tail_probability"]
            )

    return run


def grade_documents(
    docs: DataFrame,
    ratings: DataFrame,
    least: int = 1,
    text: str = "text",
    doc_id: str = "doc_id",
    grade: str = "grade",
    max_rated: int = 6000,
) -> DataFrame:
    """doc_id, expected_grade, tail_probability of a grade of at least ``least``, and whether that is one half or more."""
    model = fit(docs, ratings, text, doc_id, grade, max_rated)
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("_text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    scored = rows.mapInArrow(_scorer(*model, least), f"doc_id {kind}, expected_grade double, tail_probability double")
    return scored.withColumn("selected", F.col("tail_probability") >= 0.5)

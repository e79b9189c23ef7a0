from __future__ import annotations

import random
import zlib

import numpy as np
import pytest

from rondo.llm import toxicity


@pytest.fixture(scope="module")
def texts(prose):
    draw, out, labels = random.Random(4), [], []
    for i in range(900):
        words = prose(i, draw.randrange(20, 120))
        toxic = i % 8 == 0
        for _ in range(3 * toxic):
            words.insert(draw.randrange(len(words)), draw.choice(("vile", "scumbag", "fool")) + draw.choice(("", "s", "ish")))
        out.append((i, " ".join(words)))
        labels.append((i, int(toxic)))
    return out, labels


def labelled(spark, labels):
    return spark.createDataFrame(labels, "doc_id long, toxic int").selectExpr("*", "'z' AS text", "0.5 AS score")


def test_held_out_rows_are_told_apart(spark, make, texts):
    pairs, labels = texts
    rows = toxicity.toxicity(make(pairs), labelled(spark, labels)).collect()
    truth = dict(labels)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    held = [r for r in rows if r.held_out]
    assert np.mean([r.predicted == truth[r.doc_id] for r in held]) > 0.95
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)


def test_labels_of_held_out_rows_change_nothing(spark, make, texts):
    pairs, labels = texts
    other = [(i, 1 - x if zlib.crc32(str(i).encode()) % 5 == 0 else x) for i, x in labels]
    score = lambda own: {r.doc_id: r.score for r in toxicity.toxicity(make(pairs), labelled(spark, own)).collect()}
    assert score(labels) == score(other)


def test_defined_cases(spark, make, texts):
    pairs, labels = texts
    odd = [(None, "vile fools scumbags"), (2000, None), (2001, ""), (3, "again"), (3, "again"), (2002, "w1 " * 100_000)]
    docs = make(pairs + odd)
    rows = toxicity.toxicity(docs, labelled(spark, labels + [(None, 1), (5, None)])).collect()
    assert len(rows) == len(pairs) + len(odd)
    empty = {r.score for r in rows if r.doc_id in (2000, 2001)}
    assert len(empty) == 1 and empty.pop() < 0.5
    assert next(r for r in rows if r.doc_id is None).predicted == 1
    kept = toxicity.drop_toxic(docs, labelled(spark, labels))
    assert kept.columns == docs.columns and kept.where("doc_id = 2000").count() == 1


def test_what_stays_is_what_is_scored_clean_whatever_the_columns(spark, make, texts):
    pairs, labels = texts
    docs = make(pairs + [(None, "plain"), (2001, None)]).selectExpr("*", "'a' AS _text", "1.5D AS _score", "array(1) AS kind")
    scored = {r.doc_id for r in toxicity.toxicity(docs, labelled(spark, labels)).collect() if not r.predicted}
    kept = toxicity.drop_toxic(docs, labelled(spark, labels))
    assert kept.schema == docs.schema and {r.doc_id for r in kept.collect()} == scored
    assert {(r._text, r._score) for r in kept.collect()} == {("a", 1.5)}


def test_without_labels_or_documents(spark, make, texts):
    none = labelled(spark, [])
    assert {r.score for r in toxicity.toxicity(make([(1, "a"), (2, None)]), none).collect()} == {0.0}
    assert toxicity.toxicity(make([]), none).count() == 0
    assert toxicity.toxicity(make([]), labelled(spark, texts[1])).count() == 0


def test_non_negative_risk_separates():
    draw = np.random.default_rng(0)
    positive = [np.array([0], np.int32) for _ in range(50)]
    unlabelled = [np.array([0], np.int32) if draw.random() < 0.2 else np.array([1], np.int32) for _ in range(500)]
    weights = toxicity.train(positive, unlabelled, 2, 0.2)
    assert weights[0] + weights[2] > 0 > weights[1] + weights[2]

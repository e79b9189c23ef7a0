"""Operators against plain versions of themselves, and columns that have the names operators use."""

from __future__ import annotations

import itertools
import random
import re
import struct
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from rondo.llm import exact_dedup, mixing, ngram_join, quality, toxicity, url_filter
from rondo.llm.queries import QUERIES
from rondo.llm.words import word_hashes

SF = "/root/testdata/sf0.001"
WORD = re.compile("[^\x20\x09-\x0d]+")


def plain_topic(text: str) -> str:
    words = max(1, len(WORD.findall(text)))
    for pattern, name in ((r"\|", "table"), (r"[%$&*#!]{2,}", "noise"), (r"\n", "lines")):
        if len(re.findall(pattern, text)) / words > 0.2:
            return name
    return "prose"


def plain_cells(docs):
    """Each document's cell and tokens, and the tokens of each cell."""
    out, sums = {}, Counter()
    for d in docs:
        text = d.text or ""
        parts = (d.source, d.lang, plain_topic(text))
        cell = tuple(p if p in own else "other" for p, own in zip(parts, mixing.TARGETS.values()))
        out[d.doc_id] = cell, max(1, len(WORD.findall(text)))
        sums[cell] += out[d.doc_id][1]
    return out, sums


def plain_draw(doc_id: int, text: str | None) -> float:
    h = xxhash.xxh64_intdigest(struct.pack("<i", 0), 42)
    h = xxhash.xxh64_intdigest(struct.pack("<q", doc_id), h)
    return ((xxhash.xxh64_intdigest(text.encode(), h) if text is not None else h) >> 11) / (1 << 53)


def test_mixing_query_equals_plain_cells_and_draws(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    cells, sums = plain_cells(docs)
    rows = QUERIES["op5_raked_mixture"](spark, SF).collect()
    assert len(rows) == len(docs) and {r.doc_id: (tuple(r.cell.split("/")), r.tokens) for r in rows} == cells
    chance = dict({(cells[r.doc_id][0], r.probability): None for r in rows})
    assert len(chance) == len(sums)  # one probability a cell
    assert sum(sums[cell] * p for cell, p in chance) == pytest.approx(sum(sums.values()) / 2)
    texts = {d.doc_id: d.text for d in docs}
    assert all(r.drawn == (plain_draw(r.doc_id, texts[r.doc_id]) < r.probability) for r in rows)


def test_mixing_equals_plain_raking(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    cells, sums = plain_cells(docs.collect())
    keep, total = 0.005, sum(sums.values())  # so little that no cell reaches probability 1
    factor = [defaultdict(lambda: 1.0) for _ in range(3)]
    weight = lambda c: sums[c] / total * factor[0][c[0]] * factor[1][c[1]] * factor[2][c[2]]
    goals = []
    for axis, own in enumerate(mixing.TARGETS.values()):
        now = Counter()
        for c, n in sums.items():
            now[c[axis]] += n / total
        named = {c: own[c] for c in now if c in own}
        goals.append({c: now[c] if c == "other" else named[c] / sum(named.values()) * (1 - now["other"]) for c in now})
    for _ in range(400):
        for axis, goal in enumerate(goals):
            now = Counter()
            for c in sums:
                now[c[axis]] += weight(c)
            for category in goal:
                factor[axis][category] *= goal[category] / now[category]
    rows = mixing.plan(docs, mixing.TARGETS, mixing.columns_of(), keep).collect()
    for r in rows:
        c = cells[r.doc_id][0]
        assert r.probability < 1 and r.probability == pytest.approx(weight(c) / sums[c] * keep * total, rel=1e-4)


def test_cumulative_link_model_is_where_the_likelihood_is_flat():
    draw, decay, size = np.random.default_rng(5), 1e-2, 4
    grades = np.arange(60) % 3
    rows = [(np.array([0, 1 + g % 3], np.int32), draw.uniform(0.2, 1, 2).astype(np.float32)) for g in grades + draw.integers(0, 2, 60)]
    weights, thresholds = quality.train(rows, grades, 3, steps=4000, decay=decay)
    assert thresholds[0] < thresholds[1] and not weights[size:].any()

    def loss(at):
        total = 0.0
        for (slots, shares), grade in zip(rows, grades):
            score = sum(at[s] * v for s, v in zip(slots, shares))
            below = [0.0, *(1 / (1 + np.exp(score - t)) for t in at[size:]), 1.0]
            total -= np.log(below[grade + 1] - below[grade]) / len(rows)
        return total + decay / 2 * sum(w * w for w in at[:size])

    at = np.append(weights[:size], thresholds)
    slopes = [(loss(at + step) - loss(at - step)) / 2e-5 for step in 1e-5 * np.eye(len(at))]
    assert np.abs(slopes).max() < 2e-3


def test_grades_equal_plain_scoring(spark, make, prose):
    pairs = [(i, " ".join(prose(i, 30, 50) + ["Zz%9"] * (i % 4))) for i in range(200)] + [(300, None), (301, " \n"), (302, "one")]
    docs = make(pairs)
    ratings = spark.createDataFrame([(i, i // 2 % 3) for i in range(0, 200, 2)], "doc_id long, grade int")
    weights, thresholds, known = quality.fit(docs, ratings)

    def slots(word):
        _, words, extra = next(word_hashes(pa.array([word]), (), endings=True))
        return [int(h) >> (64 - quality.BITS) for part in (words, *extra) for h in part]

    for r in quality.grade_documents(docs, ratings, least=2).collect():
        words = WORD.findall((dict(pairs)[r.doc_id] or "").lower())
        cased = WORD.findall(dict(pairs)[r.doc_id] or "")
        n, score = len(words), 0.0
        if n:
            times = Counter(s for w in cased for s in slots(w))
            score = sum(weights[s] * (k / n) ** 0.5 for s, k in times.items())
            triples = {tuple(words[i : i + 3]) for i in range(max(1, n - 2))}
            score += weights[-2] * 4 * sum(a == b for a, b in itertools.pairwise(words)) / n
            score += weights[-1] * 4 * (1 - len(triples) / max(1, n - 2))
        above = [1 / (1 + np.exp(t - score)) for t in thresholds]
        assert r.expected_grade == pytest.approx(known[0] + sum(p * (b - a) for p, a, b in zip(above, known, known[1:])), abs=1e-4)
        assert r.tail_probability == pytest.approx(above[1], abs=1e-4) and r.selected == (r.tail_probability >= 0.5)


def test_positive_unlabelled_model_is_where_the_risk_is_flat():
    draw, prior, decay = np.random.default_rng(6), 0.3, 3e-2
    positive = [np.array(sorted({0, int(draw.integers(1, 3))}), np.int32) for _ in range(40)]
    unlabelled = [np.array([0] if draw.random() < 0.4 else [int(draw.integers(1, 3))], np.int32) for _ in range(200)]
    weights = toxicity.train(positive, unlabelled, 3, prior, steps=4000, decay=decay)

    def parts(at):
        chance = lambda rows: np.array([1 / (1 + np.exp(-sum(at[i] for i in r) - at[-1])) for r in rows])
        p, u = chance(positive), chance(unlabelled)
        return prior * (1 - p).mean(), u.mean() - prior * p.mean()

    loss = lambda at: sum(parts(at)) + decay / 2 * (at[:-1] ** 2).sum()
    assert parts(weights)[1] > 0  # the risk of the negatives isn't clipped here
    slopes = [(loss(weights + step) - loss(weights - step)) / 2e-5 for step in 1e-5 * np.eye(len(weights))]
    assert np.abs(slopes).max() < 2e-3


def test_vocabulary_of_thousands_of_weighted_terms(spark):
    draw = random.Random(7)
    word = lambda: "".join(draw.choice("abcdefgh0-") for _ in range(draw.randint(3, 6)))
    strict, soft = {word() for _ in range(1500)}, {word(): draw.randint(1, 4) for _ in range(4000)}
    table = url_filter.vocabulary_rows(spark, ["old"], {}, 1).unionByName(url_filter.vocabulary_rows(spark, strict, soft, 2))
    odd = [(2, None, "soft", 9), (2, "", "strict", None), (2, "abc", "other", 3), (2, "NOWEIGHT", "soft", None), (None, "x", "strict", 1)]
    table = table.unionByName(spark.createDataFrame([*odd, (2, "noweight", "soft", None)], url_filter.VOCABULARY))
    hard, weights = url_filter.read_vocabulary(table)
    assert set(hard) == strict and weights == {**{t: w for t, w in soft.items() if t not in strict}, "noweight": 1}
    assert url_filter.read_vocabulary(table, 1) == (("old",), {}) and url_filter.read_vocabulary(table, 9) == ((), {})
    known = [*list(strict)[:40], *weights]
    urls = ["http://h.com/" + draw.choice("/._x").join(draw.choice((word(), draw.choice(known))) for _ in range(3)) for _ in range(600)]
    urls += [urls[0], urls[0], None, "http://h.com/" + "noweight/" * 20_000]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string").withColumn("_text", F.lit("x"))
    got = {r.page_id: (r.strict_hits, r.soft_weight, r.verdict) for r in url_filter.judge(pages, strict=hard, soft=weights, limit=5).collect()}
    want = {}
    for i, url in enumerate(urls):
        found = {(url or "")[a:b] for a in range(len(url or "")) for b in range(a + 3, min(a + 9, len(url)) + 1) if i < 603 if bounded(url, a, b)}
        found |= {"noweight"} if i == 603 else set()
        hits, total = len(found & set(hard)), sum(weights.get(t, 0) for t in found)
        want[i] = hits, total, "block" if hits or total >= 5 else "allow"
    assert got == want and {v for *_, v in want.values()} == {"allow", "block"}
    none = url_filter.judge(pages, strict=(), soft={}).select("strict_hits", "soft_weight").distinct().collect()
    assert [tuple(r) for r in none] == [(0, 0)]


def bounded(url: str, a: int, b: int) -> bool:
    return (a == 0 or not url[a - 1].isalnum()) and (b == len(url) or not url[b].isalnum())


def test_a_vocabulary_over_the_bound_is_refused(spark, monkeypatch):
    monkeypatch.setattr(url_filter, "MOST", 3)
    with pytest.raises(ValueError):
        url_filter.read_vocabulary(url_filter.vocabulary_rows(spark, "abcd", {}, 1))


@pytest.mark.parametrize("repeated", [False, True])
def test_columns_may_have_the_names_operators_use(make, prose, repeated):
    pairs = [(i, " ".join(prose(i // 2, 40))) for i in range(60)] + [(70, None), (71, "")]
    pairs += [(3, "another text of the same id")] * repeated
    names = "_cell _tokens _chance _word _bits _hash __hash _maybe _digest _draw _text _score _part _rank"
    plain = make(pairs)
    docs = plain.withColumns({n: F.lit(i) for i, n in enumerate(names.split())})
    steps = {
        "mix": lambda d: mixing.mix(d, mixing.TARGETS, mixing.columns_of(), 0.5),
        "near": ngram_join.drop_near_copies,
    }
    for step in steps.values():
        got, want = step(docs), step(plain)
        assert got.columns == docs.columns
        ids = lambda df: sorted((r.doc_id, r.text or "") for r in df.collect())
        assert ids(got) == ids(want)
        assert {tuple(r[n] for n in names.split()) for r in got.collect()} == {tuple(range(len(names.split())))}
    assert exact_dedup.dedup(plain).count() < plain.count()

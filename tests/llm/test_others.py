"""Sharding, URL filter, token counts, mixing, quality, top-k search."""

from __future__ import annotations

import math
import random
import zlib

import duckdb
import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer, models, pre_tokenizers

from rondo.llm import mixing, quality, sharding, token_counts, topk_search, url_filter
from rondo.llm.queries import ORACLES, QUERIES

ODD = [(None, "a"), (None, None), (3, ""), (3, ""), (4, "b " * 50_000), (5, "é☃")]


def test_sharding(make):
    draw = random.Random(2)
    pairs = [(i, "x" * draw.randrange(400)) for i in range(3000)] + ODD
    rows = sharding.shard(make(pairs), 8, slots=256).collect()
    want = sorted((str(i), len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t in pairs)
    assert sorted((str(r.doc_id), r.size, r.text_crc32) for r in rows) == want
    loads, places = [0] * 8, [[] for _ in range(8)]
    for r in rows:
        loads[r.shard] += r.size
        places[r.shard].append(r.slot)
    assert max(loads) <= max(1.02 * sum(loads) / 8, 1.05 * 100_008)  # one record is larger than a fair share
    assert all(sorted(p) == list(range(len(p))) for p in places)
    assert sharding.shard(make([])).count() == 0


def test_rebalancing_moves_few_slots(spark, make):
    draw = random.Random(5)
    sizes = [(slot, draw.randrange(50, 150), 1) for slot in range(1000)]
    old = sharding.assign(sizes, 10)
    new = sharding.rebalance(sizes, old, 11)
    loads = [0] * 11
    for slot, size, _ in sizes:
        loads[new[slot]] += size
    moved = [s for s in old if old[s] != new[s]]
    assert max(loads) < 1.05 * sum(loads) / 11 and len(moved) < 120 and {new[s] for s in moved} == {10}
    table = sharding.slot_map(spark, sizes, new, 2)
    assert {(r.version, r.slot, r.shard) for r in table.collect()} == {(2, s, new[s]) for s, _, _ in sizes}


def test_url_filter(spark):
    urls = {
        "http://a.net/x": ("a.net", "/x", "net/", "block"),
        "http://A.Example.NET/en/1?q=#f": ("a.example.net", "/en/1", "example.net/en/", "allow"),
        "https://example.com/de/": ("example.com", "/de/", "example.com/de/", "block"),
        "https://notexample.com/de/": ("notexample.com", "/de/", None, "allow"),
        "ftp://x.org/fr/xxx": ("x.org", "/fr/xxx", "org/fr/", "allow"),
        "http://b.net": ("b.net", "", None, "allow"),
        "http://b.com?x=/porn/": ("b.com", "", None, "block"),
        "http://b.com/pornography": ("b.com", "/pornography", None, "allow"),
        "http://free.com/free": ("free.com", "/free", None, "allow"),
        "http://free.com/win": ("free.com", "/win", None, "block"),
        "http://c.com/CASINO#": ("c.com", "/CASINO", None, "block"),
        "no-scheme/xxx": ("", "", None, "allow"),
        "": ("", "", None, "allow"),
        None: ("", "", None, "allow"),
        "://": ("", "", None, "allow"),
        "a://b://c/d": ("b:", "//c/d", None, "allow"),
    }
    rows = [(i, u, "h") for i, u in enumerate(urls)]
    pages = spark.createDataFrame(rows, "page_id long, url string, host string")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_filter.judge(pages).collect()}
    assert got == dict(enumerate(urls.values()))
    assert url_filter.judge(pages.limit(0)).count() == 0


@pytest.mark.parametrize("bytes_", [False, True])
def test_token_counts_equal_the_tokenizer(bytes_):
    draw = random.Random(6)
    every = [(f"<0x{b:02X}>", 0.0) for b in range(256)] if bytes_ else []
    for _ in range(400):
        pieces = {"".join(draw.choice("abc▁") for _ in range(draw.randint(1, 4))): -float(draw.randint(1, 5)) for _ in range(9)}
        vocabulary = every + list(pieces.items())
        model = Tokenizer(models.Unigram([("<unk>", 0.0), *vocabulary], 0, bytes_))
        word = "".join(draw.choice("abcd☃") for _ in range(draw.randint(1, 12)))
        assert token_counts.Counter(vocabulary).count(word) == len(model.encode(word, add_special_tokens=False).ids)


def test_token_counts_of_documents(make):
    pieces = token_counts.vocabulary(public_tokenizers.path("piece_bpe_32k.model"))
    model = Tokenizer(models.Unigram([("<unk>", 0.0), *pieces], 0, True))
    model.pre_tokenizer = pre_tokenizers.Metaspace(replacement="▁", prepend_scheme="always", split=True)
    pairs = ODD + [(9, "The  quick\nbrown fox's 12,345 ▁x"), (10, " \t ")]
    want = sorted((str(i), len(model.encode(" ".join((t or "").split()), add_special_tokens=False).ids)) for i, t in pairs)
    got = token_counts.count_tokens(make(pairs), pieces).collect()
    assert sorted((str(r.doc_id), r.n_tokens) for r in got) == want
    assert token_counts.count_tokens(make([]), pieces).count() == 0


def test_raking_meets_the_marginals():
    sums = np.random.default_rng(1).uniform(1, 9, (4, 3, 2))
    targets = [np.array([0.4, 0.3, 0.2, 0.1]), np.array([0.5, 0.3, 0.2]), np.array([0.9, 0.1])]
    weights = mixing.rake(sums, targets)
    for axis, target in enumerate(targets):
        assert np.allclose(weights.sum(tuple(i for i in range(3) if i != axis)), target)
    odds = weights / sums  # the cells' interactions stay as they are
    assert np.isclose(odds[0, 0, 0] * odds[1, 1, 0], odds[0, 1, 0] * odds[1, 0, 0])
    chance = mixing.probabilities(weights, sums, 0.5 * sums.sum())
    assert chance.max() <= 1 and np.isclose((chance * sums).sum(), 0.5 * sums.sum())


def test_mixing(make):
    pairs = [(i, "word " * (1 + i % 50)) for i in range(4000)] + ODD
    docs = make(pairs)
    targets = {"source": {"src0": 0.6, "src1": 0.2, "src2": 0.2}, "lang": {"en": 0.9, "other": 0.1}, "topic": {"prose": 1.0}}
    columns = mixing.columns_of()
    rows = mixing.plan(docs, targets, columns, 0.4).collect()
    assert len(rows) == len(pairs)
    total = sum(r.tokens for r in rows)
    expected = {}
    for r in rows:
        expected[r.cell.split("/")[0]] = expected.get(r.cell.split("/")[0], 0) + r.tokens * r.probability
    assert math.isclose(sum(expected.values()), 0.4 * total, rel_tol=1e-6)
    drawn = sum(r.tokens for r in rows if r.drawn)
    assert abs(drawn - 0.4 * total) < 0.1 * total + 50_000
    kept = mixing.mix(docs, targets, columns, 0.4)
    assert kept.columns == docs.columns and kept.count() == sum(r.drawn for r in rows)
    assert mixing.plan(make([]), targets, columns).count() == 0


def test_raking_goes_on_under_the_cap():
    draw = np.random.default_rng(3)
    sums = draw.uniform(1, 9, (4, 3, 2))
    a, b, c = (draw.uniform(0.5, 1.5, n) for n in sums.shape)
    want = np.minimum(a[:, None, None] * b[:, None] * c, 1.0)
    budget = (want * sums).sum()
    goals = [(want * sums).sum(tuple(i for i in range(3) if i != axis)) / budget for axis in range(3)]
    chance = mixing.probabilities(mixing.rake(sums, goals), sums, budget, goals=goals)
    assert 3 < (want == 1).sum() < 20 and np.allclose(chance, want, atol=1e-4)
    # A language of 3 % can be 6 % of half the tokens at most, and is; its missing tokens go to the others by their targets.
    sums = np.outer([1 / 3] + [2 / 57] * 19, [0.80, 0.10, 0.07, 0.03])
    goals = [np.full(20, 0.05), np.array([0.55, 0.15, 0.15, 0.15])]
    chance = mixing.probabilities(mixing.rake(sums, goals), sums, 0.5, goals=goals)
    assert np.allclose((chance * sums).sum(0) / 0.5, [0.8 * 0.55 / 0.7, 0.8 * 0.15 / 0.7, 0.14, 0.06], atol=1e-3)
    assert np.isclose((chance * sums).sum(), 0.5) and chance.min() > 0
    cells = {f"s{i}\x1fl{j}": (sums[i, j], chance[i, j]) for i, j in np.ndindex(sums.shape)}
    reached = mixing.marginals(cells, {"source": {}, "lang": {"l3": 0.15}})["lang"]["l3"]
    assert reached[0] == 0.15 and np.allclose(reached[1:], (0.03, 0.06), atol=1e-4)


def test_mixing_keeps_what_the_targets_do_not_name(spark):
    langs = ["en"] * 4 + ["de", "fr", "es", None, "xx", None]
    rows = [(i, f"word {i}", langs[i % 10], None if i % 9 == 0 else "web" if i % 9 == 1 else f"src{i % 20}") for i in range(9000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    plan = mixing.plan(docs, mixing.TARGETS, mixing.columns_of(), 0.5).join(docs, "doc_id").collect()
    assert min(r.probability for r in plan) > 0
    kept = sum(r.tokens * r.probability for r in plan)
    share = lambda on: sum(r.tokens * r.probability for r in plan if on(r)) / kept
    assert abs(share(lambda r: r.lang in (None, "xx")) - 0.3) < 0.02
    assert abs(share(lambda r: r.source in (None, "web")) - 2 / 9) < 0.02
    drawn = [r for r in plan if r.drawn]
    for odd in (None, "xx"):
        assert any(r.lang == odd for r in drawn)
    for odd in (None, "web"):
        assert any(r.source == odd for r in drawn)


def test_quality(spark, make, prose):
    pairs, ratings = [], []
    for i in range(600):
        words = prose(i, 60)
        grade = i % 3
        if grade == 0:
            words = [w + "%%%" for w in words]
        elif grade == 1:
            words = [w for w in words[:20] for _ in range(3)]
        pairs.append((i, " ".join(words)))
        ratings.append((i, grade))
    learned = spark.createDataFrame([r for r in ratings if r[0] % 2], "doc_id long, grade int")
    rows = quality.grade_documents(make(pairs + ODD), learned, least=2).collect()
    assert len(rows) == len(pairs) + len(ODD)
    truth = dict(ratings)
    own = [r for r in rows if r.doc_id is not None and r.doc_id >= 6 and r.doc_id % 2 == 0]
    assert np.mean([r.selected == (truth[r.doc_id] == 2) for r in own]) > 0.9
    means = [np.mean([r.expected_grade for r in own if truth[r.doc_id] == g]) for g in range(3)]
    assert means[0] < means[1] < means[2]
    none = spark.createDataFrame([], "doc_id long, grade int")
    assert {(r.expected_grade, r.selected) for r in quality.grade_documents(make(pairs[:3]), none).collect()} == {(0.0, False)}
    assert quality.grade_documents(make([]), learned).count() == 0


def test_topk_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(topk_search, "BLOCK", 16)
    draw = random.Random(8)
    rows = [(i, [draw.choice((-0.5, -0.01, 0.0, 0.3, draw.gauss(0, 1))) for _ in range(6)]) for i in range(300)]
    rows += [(300 + i, list(rows[i][1])) for i in range(0, 60)]  # ties
    odd = [(1000, None), (1010, [None, 1.0]), (1020, [float("nan")] * 6), (1030, [float("inf")] * 6), (None, rows[0][1]), (1050, [1.0] * 3), (1040, []), (0, rows[0][1])]
    vectors = spark.createDataFrame(rows + odd, "vec_id long, embedding array<float>").selectExpr("*", "1 AS rank", "'b' AS block")
    got = {(r.query_id, r["rank"]): (r.vec_id, r.score) for r in topk_search.search(vectors, F.col("vec_id") % 10 == 0).collect()}
    exact = {i: [math.floor(256 * float(np.float32(x))) for x in v] for i, v in rows}
    want = {}
    for q in (i for i in exact if i % 10 == 0):
        copies = {0: 2}  # the row of id 0 is there twice, as a query and as a candidate
        scores = [(-sum(a * b for a, b in zip(exact[q], exact[c])), c) for c in exact if c != q for _ in range(copies.get(c, 1))]
        scored = sorted(scores * copies.get(q, 1))[:5]
        want.update({(q, n): (c, -s) for n, (s, c) in enumerate(scored, 1)})
    assert got == want
    assert topk_search.search(vectors.limit(0), F.col("vec_id") % 10 == 0).count() == 0


def test_topk_takes_every_vector_of_an_id(spark, monkeypatch):
    monkeypatch.setattr(topk_search, "BLOCK", 8)
    draw = random.Random(9)
    rows = [(i % 40, [float(draw.randrange(-30, 30)) for _ in range(4)]) for i in range(100)]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = topk_search.search(vectors, F.col("vec_id") % 10 == 0).orderBy("query_id", "rank").collect()
    want = []
    for q in range(0, 40, 10):
        scores = [(-sum(65536 * x * y for x, y in zip(a, b)), c) for i, a in rows if i == q for c, b in rows if c != q]
        want += [(q, n, c, -int(s)) for n, (s, c) in enumerate(sorted(scores)[:5], 1)]
    assert [tuple(r) for r in got] == want


def test_topk_equals_its_sql_on_repeated_rows(spark, tmp_path):
    draw = random.Random(10)
    rows = [(i, [draw.choice((-0.5, 0.25, 1.0)) for _ in range(3)]) for i in range(120)]
    rows = [r for r in rows for _ in range(draw.choice((1, 1, 2, 9)))] + [(7, [0.5] * 3), (50, [-1.0] * 3), (60, None)]
    spark.createDataFrame(rows, "vec_id long, embedding array<float>").write.parquet(f"{tmp_path}/embeddings.parquet")
    duck = duckdb.connect()
    duck.sql(f"CREATE VIEW embeddings AS SELECT * FROM '{tmp_path}/embeddings.parquet/*.parquet'")
    got = QUERIES["op1_threshold_search"](spark, str(tmp_path))
    want = duck.sql(ORACLES["op1_threshold_search"])
    assert got.columns == want.columns and sorted(map(tuple, got.collect())) == sorted(want.fetchall())


def test_topk_with_very_large_components(spark):
    rows = [(0, [1e30, 1.0]), (1, [-1e30, 1.0]), (2, [1.0, 2.0])]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = topk_search.search(vectors, F.col("vec_id") == 0).orderBy("rank").collect()
    assert [(r.vec_id, r.score) for r in got] == [(2, (1 << 63) - 1), (1, -(1 << 63))]


def test_topk_walk_stops_early():
    draw = np.random.default_rng(2)
    vectors = np.floor(256 * draw.normal(size=(2000, 4)))
    vectors[0] = 5000
    block = topk_search.Block(np.arange(2000), vectors)
    read = []
    monkey = topk_search._products
    topk_search._products = lambda q, v: read.append(len(v)) or monkey(q, v)
    try:
        found = list(block.search(np.array([5000]), np.array([[9.0, 9.0, 9.0, 9.0]]), np.array([-np.inf]), 1))
    finally:
        topk_search._products = monkey
    assert found[0][1].tolist() == [0] and sum(read) < 200

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest

from rondo.llm import importance
from rondo.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def features(text, longest):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)
    return words, [" ".join(words[k : k + n]) for n in range(1, longest + 1) for k in range(len(words) - n + 1)]


def brute(pairs, target, percent=10, least=20, longest=1, buckets=10000):
    """doc_id -> n_features, weight, score, rank, by the formulas as stated."""
    bucket = lambda f: zlib.crc32(f.encode()) % buckets
    corpus, wanted = [0] * buckets, [0] * buckets
    for sums, texts in ((corpus, [t for _, t in pairs]), (wanted, target)):
        for text in texts:
            for f in features(text, longest)[1]:
                sums[bucket(f)] += 1
    S, T = sum(corpus), sum(wanted)
    gain = [math.floor(1000 * math.log((t + 1) * (S + buckets) / ((s + 1) * (T + buckets)))) for s, t in zip(corpus, wanted)]
    rows = []
    for i, text in pairs:
        words, found = features(text, longest)
        weight = sum(gain[bucket(f)] for f in found) // len(found) if found else 0
        h = int(hashlib.sha256(f"2024:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append([i, len(found), weight, score, None, len(words)])
    able = sorted((r for r in rows if r[5] >= least), key=lambda r: (-r[3], r[0] is None, r[0]))
    for rank, row in enumerate(able[: percent * len(able) // 100], 1):
        row[4] = rank
    return sorted((tuple(r[:5]) for r in rows), key=repr)


def found(df):
    return sorted((tuple(r) for r in df.select("doc_id", "n_features", "weight", "score", "rank").collect()), key=repr)


@pytest.fixture(scope="module")
def pairs():
    draw = random.Random(5)
    words = ["été", "The", "the", "x1", "naïve", "日本", "a_b", "don't"] + [f"w{k}" for k in range(300)]
    texts = [" ".join(draw.choices(words, k=draw.randrange(60))) for _ in range(200)]
    odd = [None, "", "...", "é", "one " * 1500, "A-B.c\x00d"]
    return list(enumerate(texts + odd)) + [(300, "tie " * 30)]


@pytest.fixture(scope="module")
def target(spark):
    texts = ["the x1 x1 w5 w6", None, "", "Été 日本 w7 w7", "tie tie"]
    return texts, spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "item_id long, text string")


@pytest.mark.parametrize("longest", [1, 3])
def test_equals_brute_force(make, pairs, target, longest):
    got = importance.resample(make(pairs), target[1], percent=25, longest=longest)
    assert found(got) == brute(pairs, target[0], percent=25, longest=longest)


def test_fewer_buckets_and_everything_drawn(make, pairs, target):
    got = importance.resample(make(pairs), target[1], percent=100, least=0, buckets=70)
    assert found(got) == brute(pairs, target[0], percent=100, least=0, buckets=70)


def test_query_equals_brute_force(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    target = [r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    assert found(QUERIES["op12_importance_resampling"](spark, SF)) == brute(docs, target)


def test_long_texts_are_cut_between_words(monkeypatch):
    text = ("Some words, and " * 50 + "x" * 90).encode()
    whole = importance.features_of(text, 3)
    monkeypatch.setattr(importance, "SLICE", 17)
    assert importance.features_of(text, 3) == whole and whole[b"x" * 90] == 1


def test_bit_planes_sum_exactly():
    draw = np.random.default_rng(3)
    for low, high in ((-5, 6), (0, 1), (-(1 << 15), 1), (0, 30_000), (-20_000, 20_000)):
        values = draw.integers(low, high, 130)
        planes, worth = importance.gain_planes(values)
        counts = []
        for _ in range(9):
            at = draw.choice(130, draw.integers(0, 130), replace=False)
            counts.append((at, draw.integers(1, 1 << 20, len(at))))
        want = [int((values[at] * n).sum()) for at, n in counts]
        assert importance.weight_sums(counts, planes, worth, 130).tolist() == want


def test_null_and_repeated_ids(make, target):
    pairs = [(None, "word " * 25)] * 3 + [(1, "word " * 25)] * 4 + [(2, "other " * 25)]
    got = importance.resample(make(pairs), target[1], percent=100)
    ranks = sorted(r.rank for r in got.collect())
    assert ranks == list(range(1, 9))
    assert [r[:4] for r in found(got)] == [r[:4] for r in brute(pairs, target[0], percent=100)]


def test_empty_tables(spark, make, target):
    assert importance.resample(make([]), target[1]).count() == 0
    none = spark.createDataFrame([], "text string")
    pairs = [(k, f"w{k} w{k + 1} " * 15) for k in range(30)]
    assert found(importance.resample(make(pairs), none)) == brute(pairs, [])

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from rondo.llm import collocations

SCHEMA = "doc_id long, text string, lang string, rank int, w string, n long"


def brute(rows, longest=5, least=100, cover=100, top=2000):
    """The contract by counting all phrases of all pieces."""
    f, n = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lowered):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in range(1, longest + 1):
                f.update((lang, tuple(w[i : i + k])) for i in range(len(w) - k + 1))
    frequent = {key: a for key, a in f.items() if a >= least and len(key[1]) > 1}
    covered = set()
    for (lang, p), more in frequent.items():
        for k in range(2, len(p)):
            for i in range(len(p) - k + 1):
                if 100 * more >= cover * f[lang, p[i : i + k]]:
                    covered.add((lang, p[i : i + k]))
    lists = defaultdict(list)
    for (lang, p), a in frequent.items():
        if (lang, p) not in covered:
            cuts = [(1000 * a * n[lang] // (f[lang, p[:k]] * f[lang, p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            lists[lang].append((-score, -a, " ".join(p).encode(), f[lang, p[:k]], f[lang, p[k:]]))
    return {
        (lang, i, p.decode(), -a, left, right, n[lang], -s)
        for lang, own in lists.items()
        for i, (s, a, p, left, right) in enumerate(sorted(own)[:top], 1)
    }


def found(spark, rows, **kw):
    df = spark.createDataFrame([(k, t, lang, 1, "x", 2) for k, (t, lang) in enumerate(rows)], SCHEMA)
    out = collocations.collocations(df, **kw)
    assert out.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    got = [tuple(r) for r in out.collect()]
    assert len(got) == len(set(got))
    return set(got)


def texts(seed, n, size=60):
    draw = random.Random(seed)
    words = ["a", "B", "b", "été", "ÉTÉ", "x-y", "\x00z", "日", "'q'"]
    marks = [" "] * 12 + ["  ", "\t", ". ", ",", ";\n", " ! ", "\r\n", "\x0b", " \x1c "]
    out = []
    for k in range(n):
        text = "".join(draw.choice(words) + draw.choice(marks) for _ in range(draw.randrange(size)))
        out.append((text, draw.choice(["en", "en", "fr", None, "und"])))
    return out


@pytest.fixture
def rows():
    return texts(1, 150) + [(None, "en"), ("", "fr"), (".", None), ("alone", "only"), ("a a a a a a a a a", "en")]


def test_equals_brute_force(spark, rows):
    want = brute(rows, least=8)
    assert want and found(spark, rows, least=8) == want


def test_other_lengths_cover_and_top(spark, rows):
    for kw in ({"longest": 3, "least": 5, "cover": 60, "top": 7}, {"longest": 2, "least": 4}, {"least": 3, "top": 40}):
        assert found(spark, rows, **kw) == brute(rows, **kw)


def test_long_text_in_many_blocks(spark, monkeypatch):
    draw = random.Random(4)
    rows = [(" ".join(draw.choice("abcde") for _ in range(150_000)), "en"), ("b a " * 300, "en")]
    assert 150_000 > 2 * collocations.BLOCK
    assert found(spark, rows) == brute(rows)


def test_slices_blocks_and_groups_of_any_size(monkeypatch):
    text = "One two, three\tfour five.six ".encode() * 40 + b"z" * 90
    whole = [x for some in collocations.tokens(text) for x in some]
    monkeypatch.setattr(collocations, "SLICE", 11)
    assert [x for some in collocations.tokens(text) for x in some] == whole and whole[-1] == b"z" * 90


def test_groups_are_of_words_and_not_of_hashes():
    phrases = np.array([[1, 2], [3, 4], [1, 2], [5, 6]])
    for g in ([0, 0, 0, 0], [7, 2, 7, 9]):
        parts = [(np.array(g[i : i + 2], np.uint64), phrases[i : i + 2], np.array([1, 10])) for i in (0, 2)]
        _, found, n = collocations._summed(parts)
        assert sorted(zip(found.tolist(), n.tolist())) == [([1, 2], 2), ([3, 4], 10), ([5, 6], 10)]


def test_partial_counts_of_many_tasks(spark, rows):
    df = spark.createDataFrame(rows, "text string, lang string").repartition(6)
    texts = collocations._texts(df, "text", "lang")
    some = collocations.frequent_phrases(texts, 3, 8, part=100)[1]
    want = brute(rows, longest=3, least=8, cover=10**9)
    assert sorted(r.f for f in some for r in f.collect()) == sorted(row[3] for row in want)


def test_words_are_hashed_anew_if_two_meet(spark, monkeypatch):
    words = spark.createDataFrame([("en", f"w{k}", k) for k in range(50)], "lang string, word string, f long")
    seeds, real = [], collocations.numbers
    monkeypatch.setattr(collocations, "numbers", lambda: (seeds.append(s) or s for s in real()))
    hashed, seed = collocations.hashed_words(words)
    assert seeds == [0] and seed == 0 and hashed.select("h").distinct().count() == 50
    twice = words.unionByName(words)
    monkeypatch.setattr(collocations, "numbers", lambda: iter((0, 1)))
    with pytest.raises(AssertionError):
        collocations.hashed_words(twice)


def test_exact_beyond_64_bits(spark):
    words = spark.createDataFrame([("en", w, f, h) for h, (w, f) in enumerate([("a", 3_000_000_019), ("b", 5_000_000_029)], 1)],
                                  "lang string, word string, f long, h long")
    a, n = 2_000_000_011, 9_000_000_000_000_000
    both = spark.createDataFrame([([1, 2], a)], "words array<long>, f long")
    phrase = spark.createDataFrame([([1, 2], a, "en", "a b", n)], "words array<long>, a long, lang string, phrase string, n long")
    row = collocations._scored(phrase, words, [both]).collect()[0]
    assert row.score == 1000 * a * n // (3_000_000_019 * 5_000_000_029) and 1000 * a * n > 1 << 80


def test_empty_tables(spark):
    assert found(spark, []) == set() and found(spark, [(None, "en"), ("", None)], least=1) == set()

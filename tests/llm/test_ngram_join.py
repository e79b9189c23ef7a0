from __future__ import annotations

import random
import re
from itertools import combinations

import numpy as np
import pytest

from rondo.llm import ngram_join
from rondo.llm.components import components


def sets(pairs, size):
    out = {}
    for i, t in pairs:
        own = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        out[i] = set(zip(*(own[k:] for k in range(size)))) or ({tuple(own)} if own else set())
    return out


def brute(pairs, size, num, den):
    own = sets(pairs, size)
    root = {i: i for i in own}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in combinations(own, 2):
        both = len(own[a] & own[b])
        if both and den * both >= num * len(own[a] | own[b]):
            low, high = sorted((find(a), find(b)))
            root[high] = low
    return {i: (len(own[i]), find(i)) for i in own}


def corpus(prose, seed, n=260):
    """Groups of texts with one word or more changed, texts that share passages, very short texts and plain ones."""
    draw, out = random.Random(seed), []
    bases = [prose(seed * 100 + k, draw.choice((4, 9, 12, 30, 80, 200))) for k in range(12)]
    passage = prose(seed * 100 + 50, 40)
    for k in range(n):
        words = list(draw.choice(bases))
        for _ in range(draw.choice((0, 0, 1, 1, 2, 3, 6))):
            words[draw.randrange(len(words))] = f"n{draw.randrange(10_000)}"
        if draw.random() < 0.2:
            words = passage + prose(seed * 1000 + k, draw.choice((1, 5, 40)))
        if draw.random() < 0.1:
            words = words[: draw.randrange(5)]
        text = " ".join(words)
        out.append((1000 - k, text.upper() if draw.random() < 0.1 else text))
    return out


@pytest.mark.parametrize(("seed", "size", "num"), [(1, 3, 90), (2, 5, 80), (3, 1, 80), (4, 2, 95)])
def test_groups_equal_brute_force(make, prose, seed, size, num):
    pairs = corpus(prose, seed)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.link_groups(make(pairs), size, num, 100).collect()}
    assert got == brute(pairs, size, num, 100)


def test_defined_cases(make):
    text = "one two three four five six seven"
    pairs = [(4, None), (3, ""), (2, " \t "), (9, text), (7, text + " "), (None, text), (8, text.replace(" ", "\n")), (1, "x"), (5, "X")]
    rows = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.link_groups(make(pairs), 3, 90, 100).collect()}
    assert rows == {4: (0, 4), 3: (0, 3), 2: (0, 2), 9: (5, 7), 7: (5, 7), 8: (5, 7), 1: (1, 1), 5: (1, 1), None: (5, None)}
    assert ngram_join.link_groups(make([]), 3, 90, 100).count() == 0
    kept = ngram_join.drop_near_copies(make(pairs + [(9, text)]))
    assert sorted((r.doc_id or 0 for r in kept.collect())) == [0, 1, 2, 3, 4, 7]
    assert kept.columns == make(pairs).columns


def test_texts_that_share_an_id_are_judged_by_themselves(make, prose):
    base, other, third = (prose(seed, 60) for seed in (31, 32, 33))
    near = lambda words, k: " ".join([*words[:-1], f"n{k}"])
    pairs = [(3, " ".join(base)), (7, near(base, 1)), (7, " ".join(other)), (9, near(other, 2)), (5, " ".join(third)), (5, near(third, 3))]
    pairs += [(None, "a text that no other row has"), (8, near(other, 2))]
    rows = sorted((r.doc_id or 0, r.n_shingles, r.class_id or 0, r.component_id or 0) for r in ngram_join.link_groups(make(pairs), 3, 90, 100).collect())
    assert rows == [(0, 5, 0, 0), (3, 58, 3, 3), (5, 58, 5, 5), (5, 58, 5, 5), (7, 58, 7, 3), (7, 58, 7, 7), (8, 58, 8, 7), (9, 58, 8, 7)]
    kept = ngram_join.drop_near_copies(make(pairs), 3, 90, 100)
    left = [(r.doc_id, r.text) for r in kept.collect()]
    assert kept.columns == make(pairs).columns and len(left) == 4
    assert {(3, " ".join(base)), (7, " ".join(other)), (None, pairs[6][1])} < set(left) and sum(i == 5 for i, _ in left) == 1


def test_long_text_and_its_near_copy(make, prose):
    words = prose(5, 60_000, 10**6)
    pairs = [(1, " ".join(words)), (2, " ".join(words[:-100])), (3, " ".join(words[30_000:])), (4, "z" * 3_000_000)]
    got = {r.doc_id: r.component_id for r in ngram_join.link_groups(make(pairs), 5, 80, 100).collect()}
    assert got == {1: 1, 2: 1, 3: 3, 4: 4}


def test_blocks_of_a_list_are_compared(make, prose, monkeypatch):
    monkeypatch.setattr(ngram_join, "BLOCK", 4)
    base = prose(9, 60)
    pairs = []
    for k in range(60):
        words = list(base)
        words[k] = f"n{k}"
        pairs.append((k, " ".join(words)))
    got = {r.component_id for r in ngram_join.link_groups(make(pairs), 1, 90, 100).collect()}
    assert got == {0}


@pytest.mark.parametrize("cut", [16 << 20, 20_000])
def test_texts_just_under_the_threshold_make_few_rows(make, prose, monkeypatch, cut):
    # Each two of 300 texts differ a little more than allowed; two pairs of them link.
    monkeypatch.setattr(ngram_join, "SET_BYTES", cut)
    rows = {}
    real = ngram_join.stored

    def counted(df, label):
        out = real(df, label)
        rows[label] = max(rows.get(label, 0), out.count())
        return out

    monkeypatch.setattr(ngram_join, "stored", counted)
    base, pairs = prose(21, 400), []
    for k in range(300):
        words = list(base)
        for at in range(4):
            words[(k + 97 * at) % 400] = f"n{k}x{at}"
        pairs.append((k, " ".join(words)))
    pairs += [(500, pairs[7][1] + " more"), (501, pairs[9][1] + " more")]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.link_groups(make(pairs), 3, 95, 100).collect()}
    assert got == brute(pairs, 3, 95, 100)
    assert len({c for _, c in got.values()}) > 250
    # Of 45,451 pairs nearly all pass the sketches; a class is put out once for each list, and part of a list, it is in.
    assert rows["pairs"] <= 302 and (cut < 10**6 or rows["near"] < 302 * 60)


def test_a_forest_joins_what_links_join():
    draw = random.Random(6)
    sets = [np.unique(np.array(draw.sample(range(30), draw.randrange(0, 25)), np.uint64)) for _ in range(60)]
    labels = np.array([draw.randrange(1000, 1030) for _ in sets])

    def joined(edges):
        root = {int(x): int(x) for x in labels}
        for a, b in edges:
            old, new = root[a], root[b]
            root = {k: new if v == old else v for k, v in root.items()}
        return sorted(sorted(k for k in root if root[k] == r) for r in set(root.values()))

    for sides in (np.zeros(60, int), np.array([draw.choice((1, 2)) for _ in sets]), np.array([draw.choice((0, 1, 2)) for _ in sets])):
        links = [
            (int(labels[i]), int(labels[j]))
            for i, j in combinations(range(60), 2)
            if labels[i] != labels[j] and (sides[i] != sides[j] or not sides[i])
            and len(b := np.intersect1d(sets[i], sets[j])) and 2 * len(b) >= len(np.union1d(sets[i], sets[j]))
        ]
        found = ngram_join.forest(labels, sides, sets, 1, 2)
        assert joined(found) == joined(links) and len(found) < len(set(labels.tolist())) and links


@pytest.mark.parametrize(("num", "den"), [(90, 100), (80, 100), (1, 2), (1, 1)])
def test_bands_hold_every_partner_in_the_next_one(num, den):
    lows = ngram_join.bands(num, den, 3000)
    band = np.searchsorted(lows, np.arange(1, 3000), "right") - 1
    for size in range(1, 2000 * num // den):
        assert band[size * den // num - 1] - band[size - 1] <= 1


def test_components(spark):
    chain = [(i, i + 1) for i in range(300)] + [(1000, 1000 + i) for i in range(1, 200)] + [(5000, 5000)]
    got = {r.node: r.root for r in components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert got == {**dict.fromkeys(range(301), 0), **dict.fromkeys(range(1000, 1200), 1000)}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0

from __future__ import annotations

import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from rondo.llm import packing

PATH = public_tokenizers.path("word_bpe_49k.json")
ALPHABET = "abcDE Éß'  \t\n\r\x0b\x0c\x1c\x85\xa0Σς́<|endoftext|>0123四猫😀don't,.;:!?İǅ "


def check(pairs, rows, capacity):
    tokenizer = Tokenizer.from_file(PATH)
    want = Counter()
    for doc_id, text in pairs:
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 1], "<u4")
        for piece, at in enumerate(range(0, len(ids), capacity)):
            own = ids[at : at + capacity]
            want[doc_id, piece, at, len(own), zlib.crc32(own.tobytes())] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == want
    spans = {}
    for r in rows:
        spans.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for own in spans.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= capacity
    return len(spans), sum(r.length for r in rows)


def test_pieces_and_places(make, prose):
    draw = random.Random(1)
    pairs = [(i, "".join(draw.choice(ALPHABET) for _ in range(draw.randrange(90)))) for i in range(300)]
    pairs += [(400, None), (401, ""), (402, " ".join(prose(1, 3000))), (403, "x" * 200_000), (None, "a b"), (5, "same"), (5, "same")]
    used, volume = check(pairs, packing.pack_documents(make(pairs), PATH, 64).collect(), 64)
    assert used == -(-volume // 64)


def test_empty_table(make):
    assert packing.pack_documents(make([]), PATH).count() == 0


def test_a_frequent_length_is_numbered_in_parts(make):
    pairs = [(i, "same words here" if i % 3 else f"word {i}") for i in range(7000)]
    check(pairs, packing.pack_documents(make(pairs), PATH, 64).collect(), 64)


def optimum(items, capacity):
    best = len(items)

    def place(i, bins):
        nonlocal best
        if len(bins) >= best:
            return
        if i == len(items):
            best = len(bins)
            return
        for k in {room: k for k, room in enumerate(bins)}.values():
            if bins[k] + items[i] <= capacity:
                bins[k] += items[i]
                place(i + 1, bins)
                bins[k] -= items[i]
        bins.append(items[i])
        place(i + 1, bins)
        bins.pop()

    items = sorted(items, reverse=True)
    place(0, [])
    return best


def test_bin_completion_is_optimal_on_small_sets():
    draw = random.Random(3)
    improved = 0
    cases = [(20, [draw.randint(3, 12) for _ in range(draw.randint(1, 13))]) for _ in range(250)]
    cases.append((10, [6, 5, 5, 4, 3, 3, 2, 2]))
    cases.append((100, [50, 3, 48, 53, 53, 4, 3, 41, 23, 20, 52, 49]))
    for capacity, items in cases:
        counts = Counter(items)
        patterns = packing.bin_completion(counts, capacity)
        held = Counter()
        for times, filling in patterns:
            assert sum(x * n for x, n in filling) <= capacity
            for x, n in filling:
                held[x] += times * n
        assert held == counts
        least = optimum(items, capacity)
        assert packing.lower_bound(counts, capacity) <= least
        assert sum(n for n, _ in patterns) == least
        improved += sum(n for n, _ in packing.best_fit(counts, capacity)) > least
    assert improved  # branch and bound was needed


def test_fillings_are_undominated():
    counts = {6: 1, 5: 1, 4: 2, 3: 1, 2: 2}
    found, whole = packing.fillings(6, counts, 10, 1000)
    assert found[0] == (0, Counter({4: 1})) and whole
    found, whole = packing.fillings(6, counts, 10, 1)
    assert found == [(0, Counter({4: 1}))] and not whole


def test_search_goes_beyond_best_fit_and_the_first_choices():
    draw = random.Random(1)
    gains, rounds = 0, 40
    for _ in range(rounds):
        items = [draw.randint(250, 550) for _ in range(40)]
        counts = Counter(items)
        few, many = (sum(n for n, _ in packing.bin_completion(counts, 1000, nodes=n)) for n in (1, 3000))
        assert packing.lower_bound(counts, 1000) <= many <= few
        gains += many < few
    assert gains > rounds // 4


def test_counts_of_any_size():
    counts = {x: 10**9 + x for x in range(1, 65)}
    patterns = packing.bin_completion(counts, 64, nodes=50)
    assert sum(n * sum(x * k for x, k in f) for n, f in patterns) == sum(x * n for x, n in counts.items())
    assert len(patterns) < 500

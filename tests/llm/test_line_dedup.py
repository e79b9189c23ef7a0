from __future__ import annotations

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from rondo.llm import line_dedup

SPACE = " \t\n\x0b\x0c\r"
LONG = "A passage of more than forty characters, number {}"


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def brute(pairs, least=5, length=40):
    """(doc_id, lines, dropped, checksum) of every row, by the rule as stated."""
    held = {}
    for i, t in pairs:
        for line in (t or "").split("\n"):
            held.setdefault(lower(line.strip(SPACE)), set()).add(i)
    last = {k: max((i for i in ids if i is not None), default=None) for k, ids in held.items()}
    out = []
    for i, t in pairs:
        lines = (t or "").split("\n")
        keys = [lower(x.strip(SPACE)) for x in lines]
        kept = [x for x, k in zip(lines, keys) if len(k) < length or len(held[k]) < least or last[k] == i]
        digest = hashlib.sha256("\n".join(kept).encode()).hexdigest()
        out.append((i, len(lines), len(lines) - len(kept), digest))
    return sorted(out, key=repr)


def found(docs, **kw):
    rows = line_dedup.line_dedup(docs, **kw).collect()
    return sorted(((r.doc_id, r.n_lines, r.n_dropped, r.kept_sha256) for r in rows), key=repr)


def mixed(seed, n):
    draw = random.Random(seed)
    lines = [LONG.format(k) for k in range(12)] + ["short", "", " \t", "É" * 40, "é" * 40, "x" * 39, "x" * 40]
    odd = [lambda s: s, str.upper, lambda s: f"\t{s} ", lambda s: f"{s}\r"]
    return [(i, "\n".join(draw.choice(odd)(draw.choice(lines)) for _ in range(draw.randrange(9)))) for i in range(n)]


def test_equals_brute_force(make):
    pairs = mixed(1, 80) + [(90, None), (91, ""), (92, "\n"), (93, "\n".join([LONG.format(1)] * 300)), (94, "y" * 200_000)]
    assert found(make(pairs)) == brute(pairs)


def test_fewest_documents_and_length_are_parameters(make):
    pairs = mixed(2, 60)
    for least, length in ((2, 40), (3, 5), (61, 40)):
        assert found(make(pairs), least=least, length=length) == brute(pairs, least, length)


def test_ids_null_and_shared(make):
    line = LONG.format(0)
    # Five documents: 1, 2, 3, 4 and the rows without an id; rows that share id 4 keep all their lines.
    pairs = [(1, line), (1, line), (2, line), (3, f"{line}\nx"), (4, line), (4, f"y\n{line}\n{line}"), (None, line), (None, line)]
    assert found(make(pairs)) == brute(pairs)
    assert sum(r[2] for r in found(make(pairs))) == 6
    assert sum(r[2] for r in found(make(pairs[:-2]))) == 0


def test_hot_lines_are_looked_up(make):
    # Both lines are in more rows than a task should take; the second is in two documents only.
    pairs = [(i, f"{LONG.format('hot')}\nown {i}") for i in range(1500)]
    pairs += [(2000 + i, "\n".join([LONG.format("rare")] * 600)) for i in range(2)]
    docs = make(pairs)
    rows = line_dedup.lines(docs)
    hot = {tuple(r)[2:] for r in line_dedup.hot_keys(rows, rows.count()).collect()}
    assert hot == {(1500, 1499), (2, 2001)}
    assert found(docs) == brute(pairs)


def test_bitmaps_list_only_words_with_dropped_lines(make):
    text = "\n".join([f"own {k}" for k in range(200)] + [LONG.format(1), "end"])
    pairs = [(i, f"{i}\n{text}") for i in range(5)]
    rows = {r.doc: r for r in line_dedup.keep_bitmaps(make(pairs)).collect()}
    assert set(rows) == {0, 1, 2, 3} and all(r.n_dropped == 1 and len(r.keep) == 1 for r in rows.values())
    word, bits = rows[0].keep[0]
    assert (word, bits) == (201 // 64, ~(1 << 201 % 64))


def test_apply_keeps_all_columns(make):
    docs = make(mixed(3, 40))
    out = line_dedup.apply(docs, line_dedup.keep_bitmaps(docs))
    assert out.columns == [*docs.columns, "n_lines", "n_dropped", "keep", "kept_text"] and out.count() == 40


def test_one_exchange_serves_the_pass_over_sorted_lines(make):
    gone = line_dedup.dropped_lines(make(mixed(4, 30)).transform(line_dedup.lines))
    plan = gone._jdf.queryExecution().executedPlan().toString()
    window = plan[: plan.index("hashpartitioning")] if "hashpartitioning" in plan else plan
    assert "rangepartitioning" in window and "Window" in window


@pytest.mark.parametrize("pairs", [[], [(1, None)], [(None, None)], [(1, "a")] * 3])
def test_small_tables(make, pairs):
    docs = make(pairs)
    assert found(docs) == brute(pairs)
    assert line_dedup.keep_bitmaps(docs).where(F.col("n_dropped") > 0).count() == 0

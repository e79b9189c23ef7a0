from __future__ import annotations

import re

import pyarrow as pa
import pytest

from rondo.llm import words


def plain(text):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


TEXTS = ["Foo bar  foo\tBAR", "", None, " x ", "a" * 100 + " b c", "é à É", "one two three " * 50, "foo", "\x1c\x85 \xa0z"]


@pytest.mark.parametrize("slice_", [8, 64, 1 << 20])
def test_equal_words_have_equal_hashes_and_others_differ(monkeypatch, slice_):
    monkeypatch.setattr(words, "SLICE", slice_)
    seen = {}
    for i, hashes, _ in words.word_hashes(pa.array(TEXTS)):
        own = plain(TEXTS[i])
        assert len(own) == len(hashes)
        for word, value in zip(own, hashes):
            assert seen.setdefault(word, value) == value
    assert len(set(seen.values())) == len(seen)


def test_sliced_input_and_prefixes():
    array = pa.array(["skip me", "Abcd abce", None, "ab"]).slice(1)
    got = {i: (h, [list(x) for x in e]) for i, h, e in words.word_hashes(array, (2, 3))}
    two, three = got[0][1]
    assert two[0] == two[1] and three[0] == three[1]
    assert got[2][1] == [[], []] and len(got[1][0]) == 0


@pytest.mark.parametrize("size", [1, 3, 5])
def test_shingle_sets_have_the_size_of_the_plain_sets(size):
    for text, found in zip(TEXTS, words.shingle_sets(pa.array(TEXTS), size)):
        own = plain(text)
        want = set(zip(*(own[i:] for i in range(size)))) or ({tuple(own)} if own else set())
        assert len(found) == len(want)


def test_fewer_words_than_a_shingle_never_equal_a_shingle():
    short, full = words.shingle_sets(pa.array(["a b", "a b c"]), 3)
    assert len(short) == 1 and not set(short) & set(full)

from __future__ import annotations

import hashlib
import re

from pyspark.sql import functions as F

from rondo.llm import bloom, exact_dedup

PAIRS = [(5, "a b"), (2, "a  b"), (9, "a\t\nb"), (3, " a b"), (4, "a b "), (7, None), (1, ""), (8, "c"), (None, "c"), (None, "d"),
         (6, "long " * 50_000), (10, "long " * 50_000 + "x")]


def normal(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


def test_marks_equal_brute_force(make):
    got = {(r.doc_id, r.text_sha256): (r.keep_id, r.group_size, r.kept) for r in exact_dedup.mark(make(PAIRS)).collect()}
    groups = {}
    for i, t in PAIRS:
        groups.setdefault(normal(t), []).append(i)
    for i, t in PAIRS:
        own = groups[normal(t)]
        first = min((x for x in own if x is not None), default=None)
        digest = hashlib.sha256(normal(t).encode()).hexdigest()
        assert got[i, digest] == (first, len(own), i == first)


def test_one_of_rows_repeated_in_full_stays(make):
    rows = exact_dedup.mark(make([(1, "a")] * 5 + [(None, "z")] * 3)).collect()
    assert sum(r.kept for r in rows) == 2 and {r.group_size for r in rows} == {5, 3}


def test_dedup_keeps_whole_rows(make):
    docs = make(PAIRS + [(1, "")] * 4)
    kept = exact_dedup.dedup(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id for r in kept.collect()), key=lambda x: (x is None, x or 0)) == [1, 2, 3, 4, 6, 8, 10, None]


def test_empty_table(make):
    assert exact_dedup.mark(make([])).count() == 0 and exact_dedup.dedup(make([])).count() == 0


def test_hot_group(make):
    rows = exact_dedup.mark(make([(i, "hot" if i % 3 else f"t{i}") for i in range(6000)])).collect()
    assert sum(r.kept for r in rows) == 2001 and max(r.group_size for r in rows) == 4000


def test_a_crowded_filter_misses_nothing(spark):
    # Far too few words: nearly all rows are suspects, and every repeated one must be.
    df = spark.range(4000).select((F.col("id") % 3000).alias("v"))
    hashed = F.xxhash64("v")
    for words in (1024, 1 << 12):
        found = bloom.probe(df, hashed, words, bloom.repeated(df, hashed, words))
        assert found.where("v < 1000 AND NOT _maybe").count() == 0


def test_joins_by_filter(spark):
    df, ids = spark.range(1000).withColumnRenamed("id", "k"), spark.range(0, 1000, 3).withColumnRenamed("id", "k")
    assert bloom.semi_join(df, ids, "k", 334).count() == 334
    assert sorted(r.k for r in bloom.anti_join(df, ids, "k", 334).collect()) == [i for i in range(1000) if i % 3]
    nulls = spark.sql("SELECT cast(null AS bigint) AS k")
    assert bloom.anti_join(df.unionByName(nulls), ids, "k", 334).count() == 667

from __future__ import annotations

import random

from pyspark.sql import functions as F

from rondo.operators import numbering
from rondo.operators.numbering import identity_ids, number_within


def test_numbers_within_hot_and_cold_groups(spark):
    rng = random.Random(3)
    data = [(i, 0 if rng.random() < 0.5 else rng.randrange(400), rng.randrange(10_000)) for i in range(3000)]
    df = spark.createDataFrame(data, "id int, g int, t int")
    got = number_within(df, ["g"], F.expr("t div 60"), ["t", "id"], "n")
    seen: dict[int, int] = {}
    want = {}
    for i, g, t in sorted(data, key=lambda r: (r[2], r[0])):
        want[i] = seen.get(g, 0)
        seen[g] = want[i] + 1
    assert {r.id: r.n for r in got.collect()} == want


def test_identity_is_consecutive_in_order(spark):
    df = spark.range(5000).selectExpr("(id * 7919) % 5000 AS k", "id % 7 AS v")
    got = identity_ids(df, ["v", "k"], "id", start=0).collect()
    ordered = sorted(got, key=lambda r: (r.v, r.k))
    assert [r.id for r in ordered] == list(range(5000))


def test_ranges_grow_in_number_not_in_size(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(numbering, "ROWS_PER_RANGE", 100, raising=False)
    monkeypatch.setattr(numbering, "scratch_path", lambda *_: str(tmp_path / "placed"))
    rows = spark.range(3000).select((F.col("id") * 7919 % 3001).alias("v"))
    got = identity_ids(rows, ["v"], "n")
    ranges = spark.read.parquet(str(tmp_path / "placed")).groupBy("_part").count().collect()
    assert len(ranges) >= 25 and max(r["count"] for r in ranges) < 400
    assert [r.n for r in got.orderBy("v").collect()] == list(range(3000))

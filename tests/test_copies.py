"""Identical copies of one play share a slice of the salted join; adaptive execution splits that slice."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

from rondo.operators.joins import skew_join


def test_copies_of_one_row_are_split_by_the_adaptive_join(spark):
    small = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "200k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.shuffle.partitions": "8",
    }
    before = {k: spark.conf.get(k, None) for k in small}
    for k, v in small.items():
        spark.conf.set(k, v)
    try:
        # A third of the rows is one row over and over; the rest are all different.
        same = F.pmod(F.xxhash64("id"), F.lit(3)) == 0
        # Its text is longer than a compressor looks back, so the copies stay large in the shuffle.
        text = "".join(random.Random(1).choices("0123456789abcdef", k=150_000))
        wide = F.when(~same, F.sha2(F.col("id").cast("string"), 512)).otherwise(text)
        left = spark.range(0, 900, 1, 16).select(
            F.when(same, -1).otherwise(F.col("id")).alias("k"), wide.alias("text")
        )
        right = spark.range(-1, 900).select(F.col("id").alias("r"), (F.col("id") * 2).alias("v"))
        joined = skew_join(left, right, [("k", "r")], "left", salt=True, rows=1 / 256)
        copies = left.filter("k = -1").count()
        spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        got = joined.groupBy((F.col("k") == -1).alias("copy")).agg(
            F.count(F.lit(1)).alias("n"), F.count("v").alias("hits"), F.max(F.length("text")).alias("longest")
        )
        counts = {r.copy: (r.n, r.hits) for r in got.collect()}
        assert counts == {True: (copies, copies), False: (900 - copies, 900 - copies)}
        assert "skew=true" in got._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)

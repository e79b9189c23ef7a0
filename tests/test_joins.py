"""The salted join against brute force, with hot keys, copies and nulls on both sides."""

from __future__ import annotations

import random
from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F

from rondo.operators.joins import TILE, hot_keys, skew_join, tiled_join
from rondo.queries import ORACLES, QUERIES


def brute(left, right, how):
    out = []
    for row in left:
        hits = [r for r in right if row[1] is not None and row[2] is not None and r[0] == row[1] and r[1] == row[2]]
        out += [(*row, *r) for r in hits]
        if not hits and how == "left":
            out.append((*row, None, None, None))
    return Counter(out)


def sides(seed):
    rng = random.Random(seed)
    left, right = [], []
    for i in range(600):
        title = "hot" if rng.random() < 0.4 else rng.choice(["a", "b", "c", "d", "lonely", None])
        left.append((i, title, rng.choice([1.5, 0.0, None]) if title != "hot" else 1.5))
    for i in range(150):
        title = rng.choice(["hot", "a", "a", "a", "b", "c", "unplayed", None])
        right.append((title, rng.choice([1.5, -0.0]), i // 3))
    return left, right


@pytest.mark.parametrize("how", ["inner", "left"])
@pytest.mark.parametrize("share", [1 / 256, 0.05, 0.2, 1_000_000])
def test_salted_join_equals_brute_force(spark, how, share):
    left, right = sides(int(share * 1000) % 1000)
    l = spark.createDataFrame(left, "id int, song string, length double")
    r = spark.createDataFrame(right, "title string, duration double, n int")
    joined = skew_join(
        l, r, [("song", "title"), ("length", "duration")], how, salt=True, rows=share
    )
    assert Counter(tuple(x) for x in joined.collect()) == brute(left, right, how)


@pytest.mark.parametrize("how", ["inner", "left"])
def test_salted_join_with_unique_right(spark, how):
    left, right = sides(5)
    unique = list({(t, abs(d)): (t, abs(d), n) for t, d, n in right if t}.values())
    l = spark.createDataFrame(left, "id int, song string, length double")
    r = spark.createDataFrame(unique, "title string, duration double, n int")
    joined = skew_join(
        l, r, [("song", "title"), ("length", "duration")], how, salt=True, rows=1 / 256, right_unique=True
    )
    assert Counter(tuple(x) for x in joined.collect()) == brute(left, unique, how)


def test_hot_key_list_is_bounded_and_finds_the_hot_key(spark):
    df = spark.range(9000).selectExpr("if(id % 3 = 0, -1, id) AS k")
    found = hot_keys(df, ["k"], 1 / 64).collect()
    assert len(found) == 1 and found[0]._slices >= 21


def test_the_limit_is_rows_per_task(spark):
    # A third of a percent of the rows is still cut if one task shouldn't take it.
    df = spark.range(300_000).selectExpr("if(id % 300 = 0, -1, id) AS k")
    found = hot_keys(df, ["k"], 100).collect()
    assert [(r.k, r._slices) for r in found] == [(-1, 10)]


def test_a_plain_join_is_left_to_the_planner(spark):
    left, right = spark.range(10).selectExpr("id AS k"), spark.range(10).selectExpr("id AS r")
    text = skew_join(left, right, [("k", "r")], "left")._jdf.queryExecution().optimizedPlan().toString()
    assert "_lsalt" not in text and "broadcast" not in text.lower()


def test_a_given_list_of_hot_keys_is_used(spark):
    left = spark.range(900).selectExpr("id", "if(id % 2 = 0, -1, id) AS k")
    right = spark.range(-1, 900).selectExpr("id AS r")
    hot = hot_keys(left, ["k"], 50)
    joined = skew_join(left, right, [("k", "r")], "left", right_unique=True, hot=hot)
    assert joined.count() == 900 and joined.where("k = r").count() == 900


def test_keys_whose_hashes_collide_lose_no_row(spark, monkeypatch):
    # Every content hash the same: slices collapse, but rows are looked up and matched by key.
    from pyspark.sql import functions as F

    monkeypatch.setattr(F, "xxhash64", lambda *c: F.lit(1).cast("long"))
    left, right = sides(7)
    l = spark.createDataFrame(left, "id int, song string, length double")
    r = spark.createDataFrame(right, "title string, duration double, n int")
    joined = skew_join(l, r, [("song", "title"), ("length", "duration")], "left", salt=True, rows=0.01)
    assert Counter(tuple(x) for x in joined.collect()) == brute(left, right, "left")


def test_keys_of_different_types_are_refused(spark):
    with pytest.raises(ValueError, match="type"):
        skew_join(spark.range(3), spark.range(3).selectExpr("cast(id AS int) AS r"), [("id", "r")])


@pytest.mark.parametrize("pairs, tile", [(20_000_000, 64), (500, 7), (1, 1)])
def test_tiled_join_equals_brute_force(spark, pairs, tile):
    left, right = sides(11)
    left, right = left + left[:50], right + right[:20] + [("hot", 1.5, None), ("a", None, 3)]
    l = spark.createDataFrame(left, "id int, song string, length double")
    r = spark.createDataFrame(right, "title string, duration double, n int")
    joined = tiled_join(l, r, [("song", "title"), ("length", "duration")], pairs, tile)
    assert joined.columns == ["id", "song", "length", "n"]
    want = Counter()
    for row, n in brute(left, right, "inner").items():
        want[(*row[:3], row[5])] += n
    assert Counter(tuple(x) for x in joined.collect()) == want


def test_tiled_join_of_no_rows(spark):
    l, r = spark.range(3).selectExpr("id", "id AS k"), spark.range(9).selectExpr("id AS r", "id * 2 AS v")
    for left, right in ((l.where("k > 5"), r), (l, r.where("r > 9")), (l.selectExpr("id", "cast(NULL AS bigint) AS k"), r)):
        assert tiled_join(left, right, [("k", "r")]).collect() == []
    with pytest.raises(ValueError, match="type"):
        tiled_join(l, r.selectExpr("cast(r AS int) AS r", "v"), [("k", "r")])
    with pytest.raises(ValueError, match="no column"):
        tiled_join(l, r.select("r"), [("k", "r")])


def test_nan_is_a_key_of_a_tiled_join(spark):
    nan = float("nan")
    left = spark.createDataFrame([(1, nan), (2, nan), (3, None), (4, 0.0)], "id int, k double")
    right = spark.createDataFrame([(nan, 7), (-0.0, 8), (None, 9)], "r double, v int")
    assert sorted((x.id, x.v) for x in tiled_join(left, right, [("k", "r")]).collect()) == [(1, 7), (2, 7), (4, 8)]


def test_a_hot_key_of_a_tiled_join_is_made_by_several_tasks(spark):
    left = spark.range(6000).selectExpr("id", "if(id < 5000, -1, id) AS k")
    right = spark.range(100).selectExpr("if(id < 90, -1, id + 5500) AS r", "id AS v")
    joined = tiled_join(left, right, [("k", "r")], 50_000)
    made = joined.where("k = -1").groupBy(F.spark_partition_id()).count().collect()
    assert sum(r["count"] for r in made) == 450_000
    assert len(made) >= 4 and max(r["count"] for r in made) <= 200_000
    assert joined.where("k <> -1").count() == 10


@pytest.mark.parametrize("name", ["join_inner_title", "join_inner_2key", "filter_in_join_on"])
def test_pairs_of_repeated_keys_lie_in_tiles(spark, tmp_path, name):
    """Tables repeated by shifted keys: every pair is there, and a song stands again at most a tile later, so files stay small."""
    n, views = 30, [f"CREATE VIEW {t} AS SELECT * FROM '/root/testdata/sf0.001/{t}.parquet'" for t in ("customer", "nation")]
    for table, key in (("events", "event_id"), ("part", "p_partkey")):
        once = spark.read.parquet(f"/root/testdata/sf0.001/{table}.parquet")
        copies = once.crossJoin(spark.range(n).withColumnRenamed("id", "_copy"))
        copies = copies.withColumn(key, F.col(key) + F.col("_copy") * once.count()).drop("_copy")
        copies.repartition(1).sortWithinPartitions(key).write.parquet(str(tmp_path / f"{table}.parquet"))
        views.append(f"CREATE VIEW {table} AS SELECT * FROM '{tmp_path}/{table}.parquet/*.parquet'")
    QUERIES[name](spark, str(tmp_path)).write.parquet(str(tmp_path / "out"))
    duck = duckdb.connect()
    for view in views:
        duck.sql(view)
    names = ", ".join(spark.read.parquet(str(tmp_path / "out")).columns)
    got = f"SELECT {names} FROM '{tmp_path}/out/*.parquet'"
    want = f"SELECT {names} FROM ({ORACLES[name]})"
    total = "SELECT count(*), sum(hash(t)) FROM ({}) t"
    assert duck.sql(total.format(got)).fetchall() == duck.sql(total.format(want)).fetchall()
    back = f"""SELECT file_row_number - lag(file_row_number) OVER (PARTITION BY filename, song_id ORDER BY file_row_number) AS n
               FROM read_parquet('{tmp_path}/out/*.parquet', filename = true, file_row_number = true)"""
    near, pairs = duck.sql(f"SELECT count(*) FILTER (n <= {TILE}), count(*) FROM ({back})").fetchall()[0]
    assert pairs > 100_000 and near > 0.9 * pairs

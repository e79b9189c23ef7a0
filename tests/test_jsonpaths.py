"""Staging by an outside JSONPaths document, and checks taken during a write."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructType

from rondo.operators.quality import WriteChecks, check_not_null, check_row_counts
from rondo.sources.jsonpaths import parse_path, read_paths, read_schema, require_found, stage_by_paths


@pytest.fixture
def stage(spark, tmp_path):
    def run(records, paths, ddl, **kw):
        (tmp_path / "in").mkdir(exist_ok=True)
        (tmp_path / "in" / "a.json").write_text("\n".join(r if isinstance(r, str) else json.dumps(r) for r in records))
        (tmp_path / "paths.json").write_text(json.dumps({"jsonpaths": paths}, indent=2) if isinstance(paths, list) else paths)
        return stage_by_paths(spark, str(tmp_path / "in"), str(tmp_path / "paths.json"), StructType.fromDDL(ddl), **kw)

    return run


def test_paths_are_names_and_places():
    assert parse_path("$.a.b") == parse_path("$['a']['b']") == parse_path('$["a"].b') == ["a", "b"]
    assert parse_path("$.a[0][12].b") == ["a", 0, 12, "b"] and parse_path("$['x y'].z_1") == ["x y", "z_1"]
    for wrong in ("", "$", "a.b", "$.", "$..a", "$.a[*]", "$.a[-1]", "$[0]", "$.a b", "$.a[", "$['a]"):
        with pytest.raises(ValueError, match="path"):
            parse_path(wrong)


def test_nested_and_array_paths(stage, rows):
    records = [
        {"u": {"id": "7", "n": ["Jo", "Roe"]}, "p": [{"t": 1}, {"t": 2}], "x": {"k": [1]}, "unused": {"a": 1}},
        {"u": {"id": "", "n": ["Al"]}, "p": []},
        {},
    ]
    paths = ["$.u.id", "$.u.n[1]", "$.p[1].t", "$.x", "$['u']['n'][0]"]
    df = stage(records, paths, "id string, last string, t long, x string, first string")
    assert rows(df) == sorted([("7", "Roe", 2, '{"k": [1]}', "Jo"), (None, None, None, None, "Al"), (None,) * 5], key=repr)
    kept = stage(records, paths, "id string, last string, t long, x string, first string", clean_text=False)
    assert kept.where("id = ''").count() == 1


def test_only_named_fields_are_parsed(stage):
    plan = stage([{"a": {"b": 1, "c": 2}, "d": 3}], ["$.a.b"], "b long")._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<a:struct<b:bigint>>" in plan


def test_what_stops_a_load(stage, spark, tmp_path):
    with pytest.raises(ValueError, match="2 paths for 1"):
        stage([{}], ["$.a", "$.b"], "a long")
    with pytest.raises(ValueError, match="no JSONPaths document"):
        stage([{}], "not json", "a long")
    with pytest.raises(ValueError, match="list of texts"):
        stage([{}], '{"jsonpaths": [1]}', "a long")
    with pytest.raises(ValueError, match="path"):
        stage([{}], ["$.a", "$.a.b"], "a long, b long")
    with pytest.raises(ValueError, match="path"):
        stage([{}], ["$.a.b", "$.a"], "a long, b long")
    with pytest.raises(ValueError, match="array and an object"):
        stage([{}], ["$.a.b", "$.a[0]"], "a long, b long")
    for broken in ('{"a": ', {"a": "text"}):
        with pytest.raises(Exception, match="(?i)malformed"):
            stage([broken], ["$.a"], "a long").collect()
    with pytest.raises(ValueError, match=r"\['b'\]"):
        require_found(stage([{"a": 1}, {"a": None}], ["$.a", "$.nowhere.b"], "a long, b long"))
    assert require_found(stage([], ["$.a"], "a long")).count() == 0
    assert read_paths(spark, str(tmp_path / "paths.json")) == ["$.a"]


def test_one_path_may_feed_two_columns():
    schema = read_schema([["a", "b"], ["a", "b"], ["a", "c"]], [LongType(), LongType(), StringType()])
    assert schema.simpleString() == "struct<a:struct<b:bigint,c:string>>"


def test_checks_of_a_write_read_nothing_again(spark, tmp_path, rows):
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    source = spark.range(1000).selectExpr("id", "IF(id % 4 = 0, NULL, id * 2) AS v").mapInArrow(counted, "id long, v long")
    check = WriteChecks(source, "t", ["id", "v"], ["id"])
    check.rows.write.parquet(str(tmp_path / "t"))
    stored = spark.read.parquet(str(tmp_path / "t"))
    assert rows(check.counts()) == rows(check_row_counts({"t": stored})) == [("t", 1000, True)]
    assert rows(check.nulls()) == rows(check_not_null(stored, "t", ["id", "v"])) == [("t", "id", 0), ("t", "v", 250)]
    assert check.bounds() == {"id": (0, 999)} and seen.value == 1000
    empty = WriteChecks(spark.range(0), "e", ["id"], ["id"])
    empty.rows.write.parquet(str(tmp_path / "e"))
    assert rows(empty.counts()) == [("e", 0, False)] and empty.bounds() == {"id": (None, None)}
    assert stored.agg(F.count("v")).first()[0] == 750

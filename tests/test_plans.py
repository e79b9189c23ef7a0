"""What the physical plans must and must not hold."""

from __future__ import annotations

import importlib.util
import re
from pathlib import Path

import pytest

from __spark_entry__ import oracle_sql, queries
from rondo.plans import star
from rondo.queries import ORACLES, QUERIES
from rondo.schemas import LOG_WITH_ID, PRIMARY_KEYS
from rondo.sources.views import staging_events, staging_songs

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("stored")
    staging_events(spark, SF).write.parquet(str(root / "events"))
    staging_songs(spark, SF).write.parquet(str(root / "songs"))
    return spark.read.parquet(str(root / "events")), spark.read.parquet(str(root / "songs"))


def test_filters_and_columns_reach_the_scan(stored):
    events, _ = stored
    text = plan(star.time_nextsong(events))
    assert "EqualTo(page,NextSong)" in text
    assert re.search(r"ReadSchema: struct<page:string,ts:bigint>", text)
    text = plan(star.users_distinct(events))
    assert "itemInSession" not in text and "userAgent" not in text


def test_small_catalogue_is_broadcast_and_plays_are_not_shuffled(stored):
    text = plan(star.songplays_left_md5(*stored))
    assert "BroadcastHashJoin" in text and "hashpartitioning" not in text


def test_time_is_distinct_before_its_parts(stored):
    text = plan(star.time_nextsong(stored[0]))
    assert text.index("hour(") < text.index("HashAggregate")


def test_one_row_per_key_is_limited_before_the_shuffle(stored):
    text = plan(star.songs_dim(stored[1]))
    final, partial = text.index("Final"), text.index("Partial")
    assert final < text.index("Exchange") < partial


def test_limit_is_top_k(spark):
    assert "TakeOrderedAndProject" in plan(queries()["limit_rows"](spark, SF))


def test_salted_join_reads_only_its_columns_and_has_no_single_task_step(stored):
    events, songs = stored
    text = plan(star.songplays_left_md5(events, songs, salt=True, rows=1 / 256))
    assert "registration" not in text and "firstName" not in text and "num_songs" not in text
    main = text.split("Subquery")[0]
    assert "SinglePartition" not in main and "CartesianProduct" not in text


NO_SINGLE_TASK = [
    name for name in queries()
    if name.startswith(("songplays_", "users_", "songs_", "artists_", "time_", "session_", "user_songs", "music_"))
    and "identity" not in name
]


@pytest.mark.parametrize("name", NO_SINGLE_TASK)
def test_builders_stay_in_the_jvm(spark, name):
    text = plan(queries()[name](spark, SF))
    assert "Python" not in text and "CartesianProduct" not in text and "NestedLoop" not in text


def test_the_library_stands_without_its_optional_subpackage(monkeypatch):
    known = importlib.util.find_spec
    monkeypatch.setattr(importlib.util, "find_spec", lambda name, *a: None if ".llm" in name else known(name, *a))
    assert set(queries()) == set(QUERIES) and set(oracle_sql()) == set(ORACLES)
    package = Path(star.__file__).parent.parent
    assert not [p for p in package.rglob("*.py") if "llm" not in p.parts and "rondo.llm" in p.read_text()]


def test_registry_is_consistent():
    assert set(ORACLES) == set(QUERIES)
    assert "event_id" in LOG_WITH_ID.names and set(PRIMARY_KEYS) >= {"songplays", "music_log"}

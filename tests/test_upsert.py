from __future__ import annotations

import itertools

from rondo.operators.reduce import first_per_key, last_per_key
from rondo.operators.upsert import (
    insert_ignore,
    key_state,
    merge_states,
    upsert_ignore,
    upsert_last_write,
    upsert_update,
)

SCHEMA = "k int, name string, level string, ts long, event_id long"
NEW = [
    (1, "late", "paid", 30, 3),
    (1, "early", "free", 10, 9),
    (1, "tie", "gold", 30, 4),
    (2, "once", "free", 20, 5),
    (None, "nobody", "free", 5, 1),
]
ORDER = ["ts", "event_id"]


def test_first_and_last_whole_rows_with_ties(spark, rows):
    df = spark.createDataFrame(NEW, SCHEMA)
    assert rows(first_per_key(df, ["k"], ORDER), "k", "name") == [(1, "early"), (2, "once"), (None, "nobody")]
    assert rows(last_per_key(df, ["k"], ORDER), "k", "name") == [(1, "tie"), (2, "once"), (None, "nobody")]


def test_stored_rows_win_and_a_second_load_changes_nothing(spark, rows):
    new = spark.createDataFrame([r for r in NEW if r[0]], SCHEMA)
    target = spark.createDataFrame([(2, "stored", "old", 99, 99)], SCHEMA)
    once = upsert_ignore(new, ["k"], ORDER, target)
    assert rows(once, "k", "name") == [(1, "early"), (2, "stored")]
    assert rows(upsert_ignore(new, ["k"], ORDER, once)) == rows(once)
    assert insert_ignore(new, ["k"], ORDER, once).count() == 0


def test_update_changes_one_column_only(spark, rows):
    new = spark.createDataFrame([r for r in NEW if r[0]], SCHEMA)
    target = spark.createDataFrame([(2, "stored", "old"), (3, "kept", "old")], "k int, name string, level string")
    once = upsert_update(new, ["k"], ORDER, ["level"], target)
    want = [(1, "early", "gold"), (2, "stored", "free"), (3, "kept", "old")]
    assert rows(once, "k", "name", "level") == want
    assert rows(upsert_update(new, ["k"], ORDER, ["level"], once), "k", "name", "level") == want


def test_a_new_null_replaces_the_stored_value(spark, rows):
    new = spark.createDataFrame([(2, "x", None, 1, 1)], SCHEMA)
    target = spark.createDataFrame([(2, "stored", "old")], "k int, name string, level string")
    assert rows(upsert_update(new, ["k"], ORDER, ["level"], target)) == [(2, "stored", None)]


def test_last_write_replaces_whole_rows(spark, rows):
    new = spark.createDataFrame([r for r in NEW if r[0]], SCHEMA)
    target = spark.createDataFrame([(1, "old", "x", 1, 1), (7, "kept", "x", 1, 1)], SCHEMA)
    once = upsert_last_write(new, ["k"], ORDER, target)
    assert rows(once, "k", "name") == [(1, "tie"), (2, "once"), (7, "kept")]
    assert rows(upsert_last_write(new, ["k"], ORDER, once)) == rows(once)


def test_a_null_key_is_loaded_once(spark):
    new = spark.createDataFrame(NEW, SCHEMA)
    once = insert_ignore(new, ["k"], ORDER)
    assert insert_ignore(new, ["k"], ORDER, once).count() == 0
    assert upsert_last_write(new, ["k"], ORDER, once).count() == 3
    users = upsert_update(new, ["k"], ORDER, ["level"])
    assert upsert_update(new, ["k"], ORDER, ["level"], users).count() == 3


def test_states_merge_in_any_sequence(spark, rows):
    keep, update = ["name"], ["level"]
    parts = [NEW[0:2], NEW[2:3], NEW[3:5]]
    whole = key_state(spark.createDataFrame(NEW, SCHEMA), ["k"], ORDER, keep, update)
    for sequence in itertools.permutations(parts):
        state = None
        for part in sequence:
            one = key_state(spark.createDataFrame(part, SCHEMA), ["k"], ORDER, keep, update)
            state = one if state is None else merge_states(state, one, ["k"], keep, update)
        assert rows(state) == rows(whole)

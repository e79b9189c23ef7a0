"""The size of the batches that go to Python workers."""

from __future__ import annotations

from rondo.llm.store import BATCH_ROWS, small_batches

ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def test_a_session_without_a_number_gets_small_batches(spark):
    own = spark.newSession()
    own.conf.unset(ROWS)
    small_batches(own)
    assert own.conf.get(ROWS) == str(BATCH_ROWS)
    most = own.range(0, 3 * BATCH_ROWS, 1, 1).mapInArrow(lambda batches: batches, "id long")
    assert most.count() == 3 * BATCH_ROWS


def test_a_number_of_the_session_stays(spark):
    own = spark.newSession()
    own.conf.set(ROWS, "77")
    small_batches(own)
    assert own.conf.get(ROWS) == "77"

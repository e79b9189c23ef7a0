from __future__ import annotations

import corpus_pipeline
import duckdb
import pytest

from rondo.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


def test_every_operator_has_one_query():
    assert sorted(int(q[2:].split("_")[0]) for q in QUERIES) == list(range(1, 14)) and set(ORACLES) <= set(QUERIES)


def test_stages_keep_the_columns_and_narrow_down(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, before = docs.columns, {r.doc_id for r in docs.collect()}
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF)
        assert docs.columns == columns
        now = {r.doc_id for r in docs.collect()}
        assert now < before
        before = now
    rows = corpus_pipeline.run(spark, SF).collect()
    assert {r.doc_id for r in rows} == before
    spans = {}
    for r in rows:
        spans.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for own in spans.values():
        assert sum(n for _, n in own) <= 4096 and len({o for o, _ in own}) == len(own)


def test_stages_take_an_empty_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, SF).count() == 0


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_queries_equal_their_sql(spark, name):
    duck = duckdb.connect()
    for table in ("documents", "pages", "embeddings", "benchmark"):
        duck.sql(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    df = QUERIES[name](spark, SF)
    want = duck.sql(ORACLES[name])
    at = [df.columns.index(c) for c in want.columns]
    got = sorted(tuple(repr(r[i]) for i in at) for r in df.collect())
    assert len(at) == len(df.columns) and got == sorted(tuple(map(repr, r)) for r in want.fetchall())


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_queries_give_every_document(spark, name):
    df = QUERIES[name](spark, SF)
    ids = {r.doc_id for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id").collect()}
    assert {r.doc_id for r in df.select("doc_id").collect()} == ids

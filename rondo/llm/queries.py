"""The operators as named queries over the given tables, with SQL equivalents where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rondo.llm import (
    collocations,
    exact_dedup,
    importance,
    line_dedup,
    mixing,
    ngram_join,
    packing,
    quality,
    sharding,
    token_counts,
    topk_search,
    toxicity,
    url_filter,
)
from rondo.llm.store import share_code, small_batches

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def _query(sql: str | None = None) -> Callable[[Query], Query]:
    def add(fn: Query) -> Query:
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLES[fn.__name__] = sql.strip()
        return fn

    return add


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    share_code(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@_query(
    r"""
WITH prints AS (
  SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256
  FROM documents)
SELECT doc_id, min(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = min(doc_id) OVER same AS kept, text_sha256
FROM prints WINDOW same AS (PARTITION BY text_sha256)
"""
)
def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the one that stays in its place."""
    return exact_dedup.mark(_table(spark, sf_dir, "documents"))


@_query()
def op2_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of documents whose sets of 3-word shingles overlap by 90 % or more."""
    small_batches(spark)
    return ngram_join.link_groups(_table(spark, sf_dir, "documents"), shingle=3, num=90, den=100)


@_query()
def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's toxicity score."""
    return toxicity.toxicity(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


@_query()
def op6_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's place in training sequences of 4096 tokens."""
    return packing.pack_documents(_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@_query()
def op3_virtual_slots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's shard and place among 24 shards of near equal bytes."""
    return sharding.shard(_table(spark, sf_dir, "documents"), 24)


def _url_sql() -> str:
    bounded = lambda term: f"regexp_matches(u, '(^|[^a-z0-9]){term}([^a-z0-9]|$)')"
    strict = " + ".join(f"CAST({bounded(t)} AS INTEGER)" for t in url_filter.STRICT)
    soft = " + ".join(f"{w} * CAST({bounded(t)} AS INTEGER)" for t, w in url_filter.SOFT.items())
    rules = sorted(url_filter.RULES, key=lambda r: -len(r[0] + r[1]))
    fits = [(f"(host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}')", h + p, v) for h, p, v in rules]
    return f"""
WITH parts AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest,
         CASE WHEN strpos(url, '://') > 0 THEN lower(url) ELSE '' END AS u
  FROM pages),
split AS (
  SELECT page_id, u,
         translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM parts),
hits AS (
  SELECT page_id, host, path, CAST({strict} AS INTEGER) AS strict_hits, CAST({soft} AS INTEGER) AS soft_weight FROM split)
SELECT page_id, host, path, CASE {" ".join(f"WHEN {c} THEN '{r}'" for c, r, _ in fits)} END AS rule,
       CASE {" ".join(f"WHEN {c} THEN '{v}'" for c, _, v in fits)}
            WHEN strict_hits > 0 OR soft_weight >= 2 THEN 'block' ELSE 'allow' END AS verdict,
       strict_hits, soft_weight
FROM hits"""


@_query(_url_sql())
def op8_url_vocabulary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page judged by its URL."""
    return url_filter.judge(_table(spark, sf_dir, "pages"))


@_query()
def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's number of tokens under a unigram vocabulary."""
    pieces = token_counts.vocabulary(public_tokenizers.path("piece_bpe_32k.model"))
    return token_counts.count_tokens(_table(spark, sf_dir, "documents"), pieces)


@_query()
def op9_ordinal_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's expected grade: 0 poor, 1 sound but toxic, 2 sound."""
    labels = _table(spark, sf_dir, "labels")
    grade = F.when(F.col("quality") == 1, F.when(F.col("toxic") == 1, 1).otherwise(2)).when(F.col("quality") == 0, 0)
    return quality.grade_documents(_table(spark, sf_dir, "documents"), labels.withColumn("grade", grade), least=1)


@_query(
    """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e
  FROM embeddings WHERE embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.e, c.e) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0),
ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""
)
def op1_threshold_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five best inner products of every fiftieth vector with all others."""
    return topk_search.search(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


@_query()
def op5_raked_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's cell, its probability under the target weights, and whether it is drawn."""
    return mixing.plan(_table(spark, sf_dir, "documents"), mixing.TARGETS, mixing.columns_of(), keep=0.5)


@_query(
    r"""
WITH split AS (
  SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents),
lines AS (
  SELECT doc_id, unnest(parts) AS line, unnest(range(len(parts))) AS pos FROM split),
keyed AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM lines),
shared AS (
  SELECT key, max(doc_id) AS last FROM keyed WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT doc_id) >= 5)
SELECT doc_id, count(*) AS n_lines, count(last) FILTER (WHERE doc_id <> last) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE last IS NULL OR doc_id = last), '')) AS kept_sha256
FROM keyed LEFT JOIN shared USING (key) GROUP BY doc_id
"""
)
def op11_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's lines, those dropped as repeated elsewhere, and the checksum of the rest."""
    return line_dedup.line_dedup(_table(spark, sf_dir, "documents"))


@_query()
def op12_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's weight under the benchmark's word distribution, and the tenth drawn by it."""
    return importance.resample(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


@_query(
    r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                   '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents),
split AS (
  SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
lengths AS (
  SELECT unnest(range(1, 6)) AS k),
runs AS (
  SELECT lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: list_slice(w, i, i + k - 1))) AS p
  FROM split, lengths WHERE len(w) >= k),
counts AS (
  SELECT lang, k, p, count(*) AS f FROM runs GROUP BY lang, k, p),
totals AS (
  SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM counts WHERE k = 1 GROUP BY lang),
frequent AS (
  SELECT * FROM counts WHERE f >= 100),
covered AS (
  SELECT DISTINCT s.lang, s.p FROM frequent s JOIN frequent g ON g.lang = s.lang AND g.k = s.k + 1
    AND (s.p = list_slice(g.p, 1, s.k) OR s.p = list_slice(g.p, 2, s.k + 1))
  WHERE g.f >= s.f),
cuts AS (
  SELECT c.lang, c.p, c.f AS a, x.f AS l, y.f AS r, n, x.k AS cut,
         CAST((CAST(1000 AS HUGEINT) * c.f * n) // (CAST(x.f AS HUGEINT) * y.f) AS BIGINT) AS score
  FROM frequent c JOIN frequent x ON x.lang = c.lang AND x.k < c.k AND x.p = list_slice(c.p, 1, x.k)
  JOIN frequent y ON y.lang = c.lang AND y.k = c.k - x.k AND y.p = list_slice(c.p, x.k + 1, c.k)
  JOIN totals t ON t.lang = c.lang WHERE c.k >= 2),
best AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY lang, p ORDER BY score, cut) AS i FROM cuts) WHERE i = 1),
spelled AS (
  SELECT b.*, array_to_string(b.p, ' ') AS phrase FROM best b ANTI JOIN covered d ON b.lang = d.lang AND b.p = d.p),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM spelled)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked WHERE rank <= 2000
"""
)
def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each language's best collocations of two to five words."""
    return collocations.collocations(_table(spark, sf_dir, "documents"))

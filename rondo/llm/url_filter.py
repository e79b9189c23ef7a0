"""URL filter: rules for hosts and paths, then a weighted vocabulary of strict and soft terms.

One Aho-Corasick automaton finds all terms in one pass over the lower-cased URL. A hit counts if it is bounded: no letter
or digit stands directly before or after it. A URL is blocked on one strict term, or if the weights of its distinct soft
terms add up to ``limit``. Rules (host, path) go first: a rule fits its host and all subdomains of it if the URL's path
starts with the rule's; the longest fitting rule decides.

The vocabulary is a parameter: the short list below, or a version of a table of terms (``read_vocabulary``), of up to
``MOST`` terms, which is what bounds the automaton; a larger one is refused, never cut. A worker builds it once.

Defined cases: a URL that is null or has no ``://`` has an empty host and path and no terms, and is allowed. A port or a user
name is part of the host. Repeated rows and ids are judged one by one. Extra columns are ignored. An empty table gives an
empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator, Mapping

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

STRICT = ("casino", "cheap-pills", "escort", "hardcore", "malware", "phishing", "porn", "spam-farm", "torrent", "viagra", "xxx")
SOFT = {
    "adult": 1, "bet": 1, "bonus": 1, "click": 1, "crack": 1, "dating": 1, "deal": 1, "download": 1, "free": 1,
    "loan": 1, "lottery": 1, "pills": 1, "poker": 1, "prize": 1, "promo": 1, "sex": 1, "spam": 1, "win": 1,
}
#: A term directly before or after one of these is part of a longer word.
INSIDE = frozenset("abcdefghijklmnopqrstuvwxyz0123456789")
RULES = (("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"))


def host_and_path(url: Column) -> tuple[Column, Column]:
    """What stands after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; from there up to ``?``, ``#`` or the end."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    host = F.coalesce(F.regexp_extract(rest, r"^[^/?#]*", 0), F.lit(""))
    path = F.coalesce(F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1), F.lit(""))
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(host, upper, upper.lower()), path


#: Terms of a vocabulary, at most: their automaton takes some 100 MB of a worker.
MOST = 500_000
VOCABULARY = "version int, term string, kind string, weight int"


def vocabulary_rows(spark: SparkSession, strict: Iterable[str], soft: Mapping[str, int], version: int) -> DataFrame:
    """A version of a vocabulary as rows to append to its table."""
    rows = [(version, t, "strict", None) for t in strict] + [(version, t, "soft", w) for t, w in soft.items()]
    return spark.createDataFrame(rows, VOCABULARY)


def read_vocabulary(terms: DataFrame, version: int | None = None) -> tuple[tuple[str, ...], dict[str, int]]:
    """The strict terms and the soft ones with their weights, of the newest version or the one asked for.

    Terms are lower-cased. A strict term is not soft as well; of a soft term given twice the larger weight counts, and a
    weight that is null is 1. Null and empty terms and other kinds are left out. A version without rows has no terms.
    """
    if version is None:
        version = terms.agg(F.max("version")).first()[0]
    own = terms.where(F.col("version") == F.lit(version)).select(F.lower("term").alias("term"), "kind", "weight")
    own = own.where("term <> '' AND kind IN ('strict', 'soft')")
    own = own.groupBy("term").agg(F.bool_or(F.col("kind") == "strict").alias("strict"), F.max(F.coalesce("weight", F.lit(1))).alias("weight"))
    rows = own.orderBy("term").limit(MOST + 1).collect()
    if len(rows) > MOST:
        raise ValueError(f"a vocabulary has at most {MOST} terms")
    return tuple(r.term for r in rows if r.strict), {r.term: r.weight for r in rows if not r.strict}


#: The last automaton of a Python worker, under the checksum of its terms.
_automata: dict[str, object] = {}


def known_automaton(terms: frozenset[str], checksum: str):
    if checksum not in _automata:
        import ahocorasick

        automaton = ahocorasick.Automaton()
        for term in terms:
            automaton.add_word(term, term)
        automaton.make_automaton()
        _automata.clear()
        _automata[checksum] = automaton
    return _automata[checksum]


def _terms(strict: tuple[str, ...], soft: Mapping[str, int]):
    """Strict hits and the weight of distinct soft hits of each URL."""
    hard, terms = frozenset(strict), frozenset({*strict, *soft})
    checksum = hashlib.sha256("\n".join(sorted(terms)).encode()).hexdigest()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = known_automaton(terms, checksum) if terms else None
        for batch in batches:
            strict_hits, weights = [], []
            for url in batch.column("_text").to_pylist():
                url = url or ""
                found = set()
                for end, term in automaton.iter(url) if terms else ():
                    start = end - len(term)
                    if (start < 0 or url[start] not in INSIDE) and (end + 1 == len(url) or url[end + 1] not in INSIDE):
                        found.add(term)
                strict_hits.append(len(found & hard))
                weights.append(sum(soft.get(term, 0) for term in found - hard))
            kept = [batch.column(i) for i in range(batch.num_columns - 1)]
            columns = [*kept, pa.array(strict_hits, pa.int32()), pa.array(weights, pa.int32())]
            yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names[:-1], "strict_hits", "soft_weight"])

    return run


def judge(
    pages: DataFrame,
    url: str = "url",
    page_id: str = "page_id",
    strict: tuple[str, ...] = STRICT,
    soft: Mapping[str, int] = SOFT,
    rules: tuple[tuple[str, str, str], ...] = RULES,
    limit: int = 2,
) -> DataFrame:
    """One row per page: page_id, host, path, rule, verdict, strict_hits, soft_weight."""
    host, path = host_and_path(F.col(url))
    lower = F.when(F.instr(F.col(url), "://") > 0, F.lower(F.col(url)))
    rows = pages.select(F.col(page_id).alias("page_id"), host.alias("host"), path.alias("path"), lower.alias("_text"))
    shape = rows.drop("_text").schema.simpleString()[len("struct<") : -1]
    hits = rows.mapInArrow(_terms(strict, soft), f"{shape},strict_hits:int,soft_weight:int")
    rule, decided = F.lit(None).cast("string"), F.lit(None).cast("string")
    # The longest rule is tried first.
    for name, start, verdict in sorted(rules, key=lambda r: len(r[0] + r[1])):
        fits = ((F.col("host") == name) | F.col("host").endswith("." + name)) & F.col("path").startswith(start)
        rule = F.when(fits, F.lit(name + start)).otherwise(rule)
        decided = F.when(fits, F.lit(verdict)).otherwise(decided)
    own = F.when((F.col("strict_hits") > 0) | (F.col("soft_weight") >= limit), "block").otherwise("allow")
    return hits.select(
        "page_id", "host", "path", rule.alias("rule"), F.coalesce(decided, own).alias("verdict"), "strict_hits", "soft_weight"
    )

"""Exact top-k search by Fagin's threshold algorithm over sorted lists per dimension.

Vectors of whole numbers are dealt into blocks. A block has a list per dimension, sorted by value. For a query each list is
walked from the end that favours the sign of the query's component, all lists to the same depth. Vectors met for the first
time get their full score. No vector not yet met can score more than the query's product with the values at the current
depth, so the walk stops as soon as this bound is below the k-th best score; a bound that equals it goes on, as a tie may
have the smaller id. Depths grow in steps and all queries of a block walk together, in numpy.

A first round searches each query in one block, the one its own vector lies in, and gives it a k-th best score that the
second round, over all other blocks, starts from: there most blocks are left early, many before the first step. Blocks hold
vectors with the same leading dimension, so their values are alike and bounds are tight.

Queries are a stated set, joined with all rows block by block; only a query's own row is left out. Memory is bounded by two
blocks. Defined cases: vectors that are null, or hold null or non-finite components, take no part, nor do null ids. Every row
counts: one that is repeated in full is searched once with its number of copies, and takes as many ranks. Rows that share a
query's id are one query, whose candidates are those of each of them, and are no candidates of it. Only vectors of equal length
are compared. Queries with fewer than k candidates get all of them. Extra columns are ignored. An empty table gives an empty
result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rondo.llm.store import stored

#: Rows of one block of vectors, and of queries, about.
BLOCK, QUERIES = 8192, 512
#: Products of components up to this size add up exactly in doubles, for any usual number of dimensions.
_SMALL = float(1 << 20)


def quantised(vector: Column, scale: float = 256.0) -> Column:
    """floor(scale * x) of every component as a double; null if the vector can't take part."""
    usable = vector.isNotNull() & ~F.exists(
        vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) == float("inf"))
    )
    return F.when(usable, F.transform(vector, lambda x: F.floor(x.cast("double") * scale).cast("double")))


def _products(queries: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Exact inner products as whole numbers."""
    largest = max(np.abs(queries).max(initial=0), np.abs(vectors).max(initial=0))
    if largest <= _SMALL:
        return (queries @ vectors.T).astype(np.int64)
    exact = np.array([[int(x) for x in row] for row in queries], object).reshape(queries.shape)
    against = np.array([[int(x) for x in row] for row in vectors], object).reshape(vectors.shape)
    return np.clip(exact @ against.T, -(1 << 63), (1 << 63) - 1).astype(np.int64)


class Block:
    """The vectors of a block with their sorted lists."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, copies: np.ndarray | None = None):
        order = np.argsort(ids, kind="stable")
        self.ids, self.vectors = ids[order], vectors[order]
        self.copies = np.ones(len(ids), np.int64) if copies is None else copies[order]
        self.lists = np.argsort(-self.vectors, axis=0, kind="stable")  # rows by value, falling, for each dimension

    def search(self, ids: np.ndarray, queries: np.ndarray, floor: np.ndarray, k: int) -> Iterator[tuple]:
        """(query place, ids, scores, copies) of the best k; candidates below a query's floor don't count."""
        n = len(self.ids)
        dimensions = np.arange(self.vectors.shape[1])
        up = queries >= 0
        places: list[np.ndarray] = [np.zeros(0, np.int64)] * len(ids)
        scores: list[np.ndarray] = [np.zeros(0, np.int64)] * len(ids)
        met = np.zeros((len(ids), n), bool)
        active, bar = np.flatnonzero(floor < np.inf), floor.copy()  # an infinite floor leaves the query out
        depth, step = 0, 1
        while len(active) and depth < n:
            # The bound from the values the lists show next: nothing deeper scores more.
            top = self.vectors[self.lists[depth, dimensions], dimensions]
            bottom = self.vectors[self.lists[n - 1 - depth, dimensions], dimensions]
            reach = np.where(up[active], top, bottom) * queries[active]
            bound = reach.sum(1) if np.abs(reach).max(initial=0) < _SMALL * _SMALL else np.full(len(active), np.inf)
            active = active[bound >= bar[active]]
            if not len(active):
                break
            end = min(n, depth + step)
            high = np.unique(self.lists[depth:end])
            low = np.unique(self.lists[n - end : n - depth])
            either = np.union1d(high, low)
            at = np.searchsorted(either, np.concatenate([self.lists[depth:end], self.lists[n - end : n - depth]]).T)
            found = np.zeros((len(dimensions), 2, len(either)), bool)
            for d in range(len(dimensions)):
                found[d, 0, at[d, : end - depth]] = found[d, 1, at[d, end - depth :]] = True
            # A query meets what the lists it walks downwards show from the top and the others from the bottom.
            side = up[active].astype(np.float32)
            shown = (side @ found[:, 0].astype(np.float32) + (1 - side) @ found[:, 1].astype(np.float32)) > 0
            new = shown & ~met[np.ix_(active, either)]
            got = _products(queries[active], self.vectors[either])
            new &= (got >= np.where(np.isfinite(bar[active]), bar[active], -np.inf)[:, None]) & (self.ids[either][None, :] != ids[active][:, None])
            met[np.ix_(active, either)] |= shown
            for row, q in enumerate(active):
                if new[row].any():
                    place = np.concatenate([places[q], either[new[row]]])
                    score = np.concatenate([scores[q], got[row][new[row]]])
                    best = np.lexsort((place, -score))[:k]  # places are in the order of ids
                    places[q], scores[q] = place[best], score[best]
                    if len(best) == k:
                        bar[q] = max(bar[q], score[best[-1]])
            depth, step = end, step * 2
        for q in range(len(ids)):
            if len(places[q]):
                yield q, self.ids[places[q]], scores[q], self.copies[places[q]]


def _matrix(values: pa.Scalar, rows: int) -> np.ndarray:
    return np.frombuffer(values.as_py(), np.float64).reshape(rows, -1)


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Vectors of one block, in order, as one row: block, ids, vectors, copies, floors, homes."""
    names, held, at = ["block", "ids", "vectors", "copies", "floors", "homes"], [], None

    def row() -> pa.RecordBatch:
        kinds = np.int64, np.float64, np.int64, np.float64, np.int64
        packed = [pa.array([np.array(c, k).tobytes()], pa.binary()) for c, k in zip(zip(*held), kinds)]
        return pa.RecordBatch.from_arrays([pa.array([at], pa.int64()), *packed], names)

    for batch in batches:
        columns = (batch.column(c).to_pylist() for c in ("block", "vec_id", "v", "copies", "floor", "home"))
        for block, vec_id, vector, copies, floor, home in zip(*columns):
            if held and (block != at or len(held) >= 2 * BLOCK):
                yield row()
                held = []
            at = block
            held.append((vec_id, vector, copies, -np.inf if floor is None else floor, _NOWHERE if home is None else home))
    if held:
        yield row()


#: The home of a query that no block is left out for.
_NOWHERE = -(1 << 63)
_PACKED = "block long, ids binary, vectors binary, copies binary, floors binary, homes binary"


def _packed(rows: DataFrame, blocks: int) -> DataFrame:
    return rows.repartition(blocks, "block").sortWithinPartitions("block").mapInArrow(_pack, _PACKED)


def _walk(k: int):
    """Each query block of a row searched in its vector block, but for queries that were searched there already.

    The lists of a block are kept while it stays the same.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, block = None, None
        for batch in batches:
            for i in range(batch.num_rows):
                columns = ("ids", "vectors", "copies", "q_ids", "q_vectors", "q_copies", "floors", "homes")
                ids, vectors, copies, q_ids, q_vectors, q_copies, floors, homes = (batch.column(c)[i] for c in columns)
                own = np.frombuffer(ids.as_py(), np.int64)
                if key is None or key != (own.tobytes(), vectors.as_py()):
                    key = own.tobytes(), vectors.as_py()
                    block = Block(own, _matrix(vectors, len(own)), np.frombuffer(copies.as_py(), np.int64))
                asked = np.frombuffer(q_ids.as_py(), np.int64)
                here = np.frombuffer(homes.as_py(), np.int64) == batch.column("block")[i].as_py()
                floor = np.where(here, np.inf, np.frombuffer(floors.as_py(), np.float64))
                times = np.frombuffer(q_copies.as_py(), np.int64)
                for q, found, scores, same in block.search(asked, _matrix(q_vectors, len(asked)), floor, k):
                    # More than k copies of a row take all k ranks, however many they are.
                    ranks = np.minimum(np.minimum(same, k) * min(times[q], k), k)
                    out = [np.full(len(found), asked[q]), found, scores, ranks]
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in out], ["query_id", "vec_id", "score", "copies"])

    return run


def _best(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def search(vectors: DataFrame, is_query: Column, k: int = 5, vector: str = "embedding", vec_id: str = "vec_id") -> DataFrame:
    """query_id, rank, vec_id, score: the k best of all rows but its own, for every row that ``is_query`` is true of."""
    rows = vectors.withColumn("_query", F.coalesce(is_query, F.lit(False)))
    rows = rows.select(F.col(vec_id).cast("long").alias("vec_id"), quantised(F.col(vector)).alias("v"), "_query")
    rows = rows.where("vec_id IS NOT NULL AND v IS NOT NULL")
    rows = rows.groupBy("vec_id", "v").agg(F.max("_query").alias("_query"), F.count(F.lit(1)).alias("copies"))
    # Vectors with the same length and leading dimension are alike; of those, a hash makes blocks of a bounded size.
    sizes = F.transform("v", F.abs)
    lead = F.coalesce(F.array_position(sizes, F.array_max(sizes)), F.lit(0)).cast("int")
    rows = stored(rows.withColumn("dim", F.size("v")).withColumn("lead", lead), "vectors")
    counts = rows.groupBy("dim", "lead").count()
    rows = rows.join(counts, ["dim", "lead"])
    part = F.pmod(F.xxhash64("vec_id", "v"), F.floor((F.col("count") - 1) / BLOCK) + 1)
    rows = stored(rows.select("vec_id", "v", "copies", "_query", "dim", F.xxhash64("dim", "lead", part).alias("block")), "blocks")
    total = rows.count()
    tasks = max(1, -(-total // BLOCK))
    bare = {"floor": F.lit(None).cast("double"), "home": F.lit(None).cast("long")}
    whole = stored(_packed(rows.withColumns(bare), tasks), "packed").drop("floors", "homes")
    dims = rows.select("block", "dim").distinct()

    asked = rows.where("_query").drop("_query")
    found = _joined(whole, _packed(asked.withColumns(bare), tasks)).mapInArrow(_walk(k), _FOUND)
    first = stored(found, "first-round")
    floors = _best(first, k).where(F.col("rank") == k).select(F.col("query_id").alias("vec_id"), F.col("score").cast("double").alias("floor"))
    # Queries of the second round are packed anew, by a hash, with their floors, and meet every block but their own.
    groups = max(1, -(-asked.count() // QUERIES))
    second = asked.withColumn("home", F.col("block")).join(floors, "vec_id", "left")
    second = second.withColumn("group", F.xxhash64("dim", F.pmod(F.xxhash64("vec_id", "v"), F.lit(groups))))
    packed = _packed(second.select(F.col("group").alias("block"), "vec_id", "v", "copies", "floor", "home"), max(1, min(tasks, groups)))
    meets = second.select("group", "dim").distinct().join(dims, "dim").select("group", "block")
    packed = stored(packed, "asked").withColumnRenamed("block", "group").join(meets, "group").drop("group")
    rest = _joined(whole, packed).mapInArrow(_walk(k), _FOUND)
    best = _best(first.unionByName(rest), k)
    best = _best(best.withColumn("_copy", F.explode(F.sequence(F.lit(1), "copies"))), k)
    return best.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


_FOUND = "query_id long, vec_id long, score long, copies long"


def _joined(whole: DataFrame, asked: DataFrame) -> DataFrame:
    names = "ids", "vectors", "copies"
    asked = asked.select("block", *(F.col(c).alias(f"q_{c}") for c in names), "floors", "homes")
    return whole.join(asked, "block").select("block", *names, *(f"q_{c}" for c in names), "floors", "homes")

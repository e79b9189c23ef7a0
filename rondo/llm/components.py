"""Connected components of an edge table by repeated contraction.

Each round every node that still has an edge moves to the neighbour (or itself) that comes first in the round's order,
and edges between what is left are made distinct. The first rounds go by the ids, which ends stars at once; each later one
draws an order anew, so that the number of edges falls by a constant factor a round whatever the graph's shape, and chains
too end in a logarithmic number of rounds. Whether edges are left is all that reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rondo.llm.store import stored


#: Rounds that go by the ids.
PLAIN = 4


def components(edges: DataFrame) -> DataFrame:
    """(node, root): the smallest node of its component, for every node of ``edges`` (a, b)."""
    edges = stored(edges.select("a", "b").where("a != b").distinct(), "edges")
    nodes = edges.select(F.col("a").alias("node")).unionByName(edges.select(F.col("b").alias("node"))).distinct()
    moves, turn = [], 0
    while not edges.isEmpty():
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        key = lambda c: F.lit(0) if turn < PLAIN else F.xxhash64(F.lit(turn), F.col(c))  # noqa: B023, E731
        draw = lambda c: F.struct(key(c), F.col(c).alias("id"))  # noqa: B023, E731
        move = stored(
            both.groupBy("a").agg(F.min(F.least(draw("a"), draw("b"))).alias("_first")).select("a", "_first.id"),
            "moves",
        )
        left = edges.join(move, "a").select(F.col("id").alias("x"), F.col("b").alias("a"))
        moved = left.join(move, "a").select(F.col("x").alias("a"), F.col("id").alias("b"))
        low, high = F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")
        edges = stored(moved.where("a != b").select(low, high).distinct(), "edges")
        moves.append(move.where("a != id"))
        turn += 1
    out = nodes.withColumn("_at", F.col("node"))
    for move in moves:
        step = move.select(F.col("a").alias("_at"), F.col("id").alias("_to"))
        out = out.join(step, "_at", "left").select("node", F.coalesce("_to", "_at").alias("_at"))
    out = stored(out, "components")
    roots = out.groupBy("_at").agg(F.min("node").alias("root"))
    return out.join(roots, "_at").select("node", "root")

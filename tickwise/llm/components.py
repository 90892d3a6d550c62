"""Connected components of an edge table, by alternating star operations.

Each round hangs the neighbours of every node on its smallest neighbour: once
those that are larger than the node, once those that are smaller. The labels
settle in a number of rounds that is logarithmic in practice. A node with very
many edges is one key of a map-side minimum, and of a join that Spark splits.
Every round is stored in the shared folder, so a lost executor costs a round
at most and plans stay short; only two counts reach the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickwise.llm.common import stored


def _least(edges: DataFrame) -> DataFrame:
    # stored, so that both sides of the join are plain shuffles: only such a
    # join can be split where one node has very many edges
    least = stored(edges.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m")), "least")
    return edges.join(least, "u")


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select("v", "u"))
    return _least(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    joined = _least(down)
    own = joined.select("u", F.col("m").alias("v"))
    return joined.select(F.col("v").alias("u"), F.col("m").alias("v")).union(own).where("u <> v")


def _state(edges: DataFrame) -> tuple:
    r = edges.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x")).first()
    return r.n, r.x


def connected_components(edges: DataFrame) -> DataFrame:
    """``node, label`` for every node of ``edges(u, v)``; the label is the
    smallest node of the component. Loops, repeated edges and either direction
    are fine; an empty table gives no rows."""
    edges = edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    edges = stored(edges, "edges")
    state = _state(edges)
    while state[0]:
        large = stored(_large_star(edges).distinct(), "edges")
        edges = stored(_small_star(large).distinct(), "edges")
        after = _state(edges)
        if after == state:
            break
        state = after
    # settled: every edge points to the smallest node
    return edges.select(F.col("u").alias("node"), F.col("v").alias("label")).union(
        edges.select("v", "v").distinct()
    )

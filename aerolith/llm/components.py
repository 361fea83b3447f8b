"""Connected components of a table of links, by alternating large and small stars.

Each step replaces links by links to the least neighbour; the least comes from a partial and a final
aggregate, and the join back is an ordinary shuffled join whose hot keys Spark splits.  Every step is a
written table.  The driver sees two numbers a step.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aerolith.llm.common import discard, written


def _least(edges: DataFrame) -> DataFrame:
    return edges.groupBy(F.col("u").alias("__u")).agg(F.min("v").alias("__m"))


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the least of the node and its neighbours."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    near = both.join(_least(both), F.col("u") == F.col("__u")).where("v > u")
    return near.select(F.col("v").alias("u"), F.least("u", "__m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Every smaller neighbour of a node, and the node, are linked to the least of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    near = down.join(_least(down), F.col("u") == F.col("__u"))
    linked = near.select(F.col("v").alias("u"), F.col("__m").alias("v")).unionByName(near.select("u", F.col("__m").alias("v")))
    return linked.where("u <> v").distinct()


#: Links that one task writes.
TASK_LINKS = 200_000


def components(links: DataFrame) -> DataFrame:
    """u, root for every node of ``links`` (u, v: longs, u <> v) but the roots; a root is its component's least node."""
    edges = written(links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v").distinct(), "links")
    state = None
    while True:
        now = edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()
        if now == state or not now[0]:
            return edges.select("u", F.col("v").alias("root"))
        state, last = now, edges
        edges = written(_small_star(_large_star(last)).coalesce(max(1, now[0] // TASK_LINKS)), "links")
        discard(last)

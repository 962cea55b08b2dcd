"""Connected components of a table of links, by alternating star operations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from profileloom.llm.shared import stored


def _nearest(edges: DataFrame) -> DataFrame:
    """The smaller of each node ``u`` and its least neighbour ``v``; pre-aggregated before the shuffle."""
    return edges.groupBy("u").agg(F.min("v").alias("v0")).select("u", F.least("u", "v0").alias("low"))


def connected(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (a, b): root is the least node reachable.

    Large-star and small-star steps alternate until the links no longer change:
    every node then hangs on its root. The number of rounds grows with the logarithm
    of the longest path. Each round is stored, so its input is never worked out twice,
    and hubs are joined with stored minima, which Spark broadcasts or splits by skew.
    Links of a node with itself and null ends are ignored; no links, no rows.
    """
    edges = links.filter("a <> b").select(
        F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")
    ).distinct()
    edges, before = stored(edges, "links"), None
    while True:
        state = edges.agg(F.count("*"), F.expr("bit_xor(xxhash64(u, v))")).first()
        if state == before or not state[0]:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        before = state
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = stored(_nearest(both), "low")
        large = both.join(low, "u").filter("v > u").select(F.col("v").alias("u"), F.col("low").alias("v"))
        large = stored(large.distinct(), "large")
        low = stored(_nearest(large), "low")
        small = large.join(low, "u").select(
            F.explode(F.array(F.struct(F.col("u"), F.col("low").alias("v")), F.struct(F.col("v").alias("u"), F.col("low").alias("v")))).alias("e")
        )
        edges = stored(small.select("e.*").filter("u <> v").distinct(), "links")

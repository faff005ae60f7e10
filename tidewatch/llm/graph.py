"""Connected components of a link table, by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written


def components(links: DataFrame, label: str = "components") -> DataFrame:
    """(node, component) of every node of ``links`` (a, b): component is its smallest reachable node.

    Large-star links every larger neighbour of a node to the smallest one around,
    small-star every smaller neighbour; both shrink the graph to stars.  Each round
    is written to the shared folder; only a count and a checksum come to the driver.
    """
    edges = links.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    edges = written(edges, f"{label}-0")
    mark = _state(edges)
    step = 0
    while mark[0]:
        step += 1
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        # a hub's rows may be many; the join is on plain rows, which AQE splits when skewed
        large = both.join(low, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(
            F.explode(F.array(F.struct(F.col("u"), F.col("m").alias("v")),
                              F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
        small = small.select("e.u", "e.v").filter("u <> v").distinct()
        edges = written(small, f"{label}-{step}")
        new = _state(edges)
        if new == mark:
            break
        mark = new
    nodes = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return nodes.unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())


def _state(edges: DataFrame) -> tuple[int, int]:
    n, h = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").bitwiseAND((1 << 40) - 1))).first()
    return n, h or 0

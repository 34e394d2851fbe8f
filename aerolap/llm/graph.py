"""Connected components of an edge list by alternating large and small stars.

Each step is one grouped minimum per node (partial before the shuffle) and a
join back; a node with very many neighbours is split by AQE's skew join. Minima and
rounds are written to the shared folder, so lineage stays short.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aerolap.llm.common import spool


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Hook each node's larger (or smaller) neighbours to its least one."""
    if large:
        both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        both = edges
    least = (both.groupBy("u").agg(F.min("v").alias("m"))
             .select("u", F.least("u", "m").alias("m")))
    if large:
        # stored: both sides of the join are plain shuffles then, and AQE can
        # split the edges of a node with very many neighbours
        least = spool(least, "least")
    joined = both.join(least, "u")
    if large:
        out = joined.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = (joined.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
               .union(least.select("u", F.col("m").alias("v"))))
    return out.where("u <> v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (u, v: bigint); the
    component is the smallest node reachable. Order and repeats of edges and
    self loops do not matter; no edges give no rows."""
    edges = spool(edges.where("u <> v")
                  .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(),
                  "edges")
    before = None
    while True:
        edges = spool(_star(_star(edges, True), False), "edges")
        now = edges.agg(F.count("*"), F.sum(F.col("v").cast("decimal(38,0)")),
                        F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component"))

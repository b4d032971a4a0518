"""Connected components of an edge table by alternating stars.

Large star: every node hands its larger neighbours to its smallest neighbour.
Small star: every node hands its smaller neighbours (and itself) to the
smallest of them.  Both keep the components and only group by node, so the
work per round is linear in the edges; a node with very many edges is
pre-aggregated (its minimum) before the join.  The rounds end when the edge
set no longer changes; it is then one star per component.  Every round's edges
are written to the shared checkpoint folder, which cuts the lineage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimsdq.llm.common import staged


def _mark(edges: DataFrame):
    """Order-free signature of an edge set."""
    r = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)")).alias("h")).first()
    return r["n"], r["h"]


def _with_minimum(nbrs: DataFrame, include_self: bool) -> DataFrame:
    low = nbrs.groupBy("u").agg(F.min("v").alias("m"))
    if include_self:
        low = low.withColumn("m", F.least("u", "m"))
    return nbrs.join(low, "u")


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return _with_minimum(both, True).filter("v > u") \
        .select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u != v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    low = _with_minimum(down, False)
    return low.select(F.col("v").alias("u"), F.col("m").alias("v")) \
        .unionByName(low.select("u", F.col("m").alias("v"))).filter("u != v").distinct()


def connected_components(edges: DataFrame, max_rounds: int = 100) -> DataFrame:
    """``node, root`` for every node that has an edge; ``root`` is the smallest
    node of its component.  ``edges``: two columns of one orderable type."""
    u, v = edges.columns
    edges = staged(edges.select(F.col(u).alias("u"), F.col(v).alias("v")).filter("u != v").distinct(),
                   "cc-edges")
    seen = _mark(edges)
    for _ in range(max_rounds):
        if not seen[0]:
            break
        edges = staged(_small_star(_large_star(edges)), "cc-edges")
        now = _mark(edges)
        if now == seen:
            break
        seen = now
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")) \
        .unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("root"))).distinct()

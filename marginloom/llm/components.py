"""Connected components of a graph given as a table of edges, by randomised contraction.

In each round every node picks the least of itself and its neighbours in an order that is drawn anew (a hash
of the round and the node); picked nodes stand for the nodes that picked them, edges are moved to them, and
edges within one node and repeated edges vanish. The expected number of nodes falls by a constant factor each
round, whatever the graph looks like, so long chains don't take long. No list of neighbours is ever gathered:
a node's choice is a minimum (combined before the shuffle), and moving edges is a join of two written tables,
of which adaptive execution splits the rows of a hot node.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .scratch import Scratch


def components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """``node`` and ``root`` for every node of ``edges`` (columns a, b of one type, direction ignored).

    Nodes have the same root exactly if a path joins them. Loops, repeated edges and edges with a null end
    are ignored. Which node is the root is fixed by the edges alone.
    """
    a, b = F.col("a"), F.col("b")
    links = edges.select(a, b).where(a != b)
    links = scratch.table(links.unionAll(links.select(b, a)).distinct(), "edges")
    picks: list[DataFrame] = []
    while not links.isEmpty():
        drawn = lambda x, k=len(picks): F.struct(F.xxhash64(F.lit(k), x).alias("h"), x.alias("x"))
        least = links.groupBy("a").agg(F.min(drawn(b)).alias("m"))
        pick = F.when(drawn(a) < F.col("m"), a).otherwise(F.col("m.x"))
        picks.append(scratch.table(least.select(a.alias("node"), pick.alias("pick")), "picks"))
        left, right = (picks[-1].toDF(end, f"pick_{end}") for end in ("a", "b"))
        moved = links.join(left, "a").join(right, "b").where("pick_a != pick_b")
        links = scratch.table(moved.select(F.col("pick_a").alias("a"), F.col("pick_b").alias("b")).distinct(), "edges")
    if not picks:
        return links.select(a.alias("node"), b.alias("root"))
    roots = picks[-1].toDF("node", "root")
    for earlier in reversed(picks[:-1]):
        later = roots.toDF("pick", "later")
        joined = earlier.join(later, "pick", "left")
        roots = scratch.table(joined.select("node", F.coalesce("later", "pick").alias("root")), "roots")
    return roots

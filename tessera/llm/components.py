"""Connected components of a graph given as an edge table: distributed union-find.

Each round hooks every node onto its smallest neighbour that is smaller than itself, follows the hooks to
their roots by pointer doubling, and contracts the edges to those roots. Every node that is no local minimum
goes in a round, so there are at most logarithmically many rounds; a star around its smallest node takes one.
All steps are joins and grouped minima over written tables in the shared folder, so a lost executor costs a
re-read, and a hub (a node with a large part of all edges) is only ever the key of a join between written
tables, which Spark splits; it is never the key of a grouped minimum, because hooks are grouped by the larger
end of an edge.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.session import cut_lineage


def components(edges: DataFrame) -> DataFrame:
    """``(node, component)`` for every node of ``edges(a, b)`` but the smallest of each component, which is the
    component's id. Loops, repeated and null edges are harmless; without edges the result is empty."""
    a, b = F.least("a", "b"), F.greatest("a", "b")
    left = cut_lineage(edges.where("a <> b").select(a.alias("a"), b.alias("b")).distinct())
    rounds = []
    while not left.isEmpty():
        parent = cut_lineage(left.groupBy(F.col("b").alias("node")).agg(F.min("a").alias("root")))
        while True:
            up = parent.select(F.col("node").alias("_n"), F.col("root").alias("_r"))
            parent = cut_lineage(parent.join(up, F.col("root") == F.col("_n"), "left")
                                 .select("node", F.coalesce("_r", "root").alias("root"), F.col("_r").isNotNull().alias("moved")))
            if parent.where("moved").isEmpty():
                break
            parent = parent.drop("moved")
        parent = parent.drop("moved")
        rounds.append(parent)
        pa = parent.select(F.col("node").alias("a"), F.col("root").alias("_ra"))
        pb = parent.select(F.col("node").alias("b"), F.col("root").alias("_rb"))
        to_roots = cut_lineage(left.join(pa, "a", "left").select(F.coalesce("_ra", "a").alias("a"), "b"))
        ends = to_roots.join(pb, "b", "left").select("a", F.coalesce("_rb", "b").alias("b")).where("a <> b")
        left = cut_lineage(ends.select(a.alias("a"), b.alias("b")).distinct())
    if not rounds:
        return edges.where(F.lit(False)).select(F.col("a").alias("node"), F.col("a").alias("component"))
    out = rounds.pop().select("node", F.col("root").alias("component"))
    while rounds:  # a root of an earlier round may have been hooked in a later one
        later = out.select(F.col("node").alias("_n"), F.col("component").alias("_c"))
        out = cut_lineage(rounds.pop().join(later, F.col("root") == F.col("_n"), "left")
                          .select("node", F.coalesce("_c", "root").alias("component")).unionByName(out))
    return out

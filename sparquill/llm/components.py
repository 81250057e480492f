"""Connected components of a distributed edge list by contraction.

Each round every vertex takes its smallest neighbour as parent, parents are followed to the roots by pointer jumping,
and the edges between roots make the next, at most half as large, graph. Minima are pre-aggregated before the shuffle,
so a vertex with very many edges costs one row a task; every step is a table in the shared folder.

Defined results: edges with a null end and loops are no edges; repeated edges count once; without edges there is no vertex.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparquill.llm.common import drop_staged, stage


def _roots(edges: DataFrame) -> DataFrame:
    """(v, root) of one round: parents followed until they no longer change."""
    both = edges.select("a", "b").union(edges.select("b", "a"))
    parent = stage(both.groupBy(F.col("a").alias("v")).agg(F.least(F.col("v"), F.min("b")).alias("root")), "parents")
    while True:
        up = parent.select(F.col("v").alias("root"), F.col("root").alias("above"))
        jumped = stage(parent.join(up, "root").select("v", F.col("above").alias("root"), (F.col("above") != F.col("root")).alias("moved")), "jump")
        moved = not jumped.filter("moved").isEmpty()
        drop_staged(parent.sparkSession, parent)
        parent = jumped.drop("moved")
        if not moved:
            return parent


def connected_components(edges: DataFrame) -> DataFrame:
    """(v, root) for every vertex of edges (a, b), both bigint; root is the same within a component."""
    edges = stage(edges.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges")
    found = None
    while not edges.isEmpty():
        roots = _roots(edges)
        if found is None:
            found = roots
        else:
            new = roots.select(F.col("v").alias("root"), F.col("root").alias("above"))
            found = stage(found.join(new, "root", "left").select("v", F.coalesce("above", "root").alias("root")), "found")
        a, b = roots.select(F.col("v").alias("a"), F.col("root").alias("ra")), roots.select(F.col("v").alias("b"), F.col("root").alias("rb"))
        left = edges.join(a, "a").join(b, "b").filter("ra <> rb").select(F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b")).distinct()
        edges = stage(left, "edges")
    return edges.select(F.col("a").alias("v"), F.col("b").alias("root")) if found is None else found

"""Connected components of an undirected graph."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.session import cut_lineage


def _settled(parent: DataFrame) -> DataFrame:
    """Follow ``node -> parent`` to the roots by doubling: each step halves the depth of the trees."""
    while True:
        up = parent.select(F.col("node").alias("parent"), F.col("parent").alias("above"))
        parent = cut_lineage(parent.join(up, "parent").select("node", F.col("above").alias("parent"), (F.col("above") < F.col("parent")).alias("moved")))
        if parent.where("moved").isEmpty():
            return parent.select("node", "parent")
        parent = parent.select("node", "parent")


def components(edges: DataFrame) -> DataFrame:
    """``node, component`` for the nodes of the edge table ``u, v``; a component is named by its smallest node.

    In each round every node hangs on its smallest neighbour, trees are flattened and then contracted to their roots, which
    at least halves the nodes that still have an edge. Only minima are aggregated, never neighbour lists; each join reads
    written tables, so that adaptive execution can split the rows of a hub. Loops on a node and nulls are left out.
    """
    ends = [F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")]
    now = cut_lineage(edges.where("u <> v").select(*ends).distinct())
    known = now.select(F.col("u").alias("node"), F.col("v").alias("component")).limit(0)
    first = True
    while not now.isEmpty():
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        hung = both.groupBy("u").agg(F.min("v").alias("low")).select(F.col("u").alias("node"), F.least("u", "low").alias("parent"))
        parent = _settled(cut_lineage(hung))
        up = {c: parent.select(F.col("node").alias(c), F.col("parent").alias(f"{c}_root")) for c in ("u", "v")}
        rooted = cut_lineage(now.join(up["u"], "u").select("v", "u_root")).join(up["v"], "v").where("u_root <> v_root")
        now = cut_lineage(rooted.select(F.greatest("u_root", "v_root").alias("u"), F.least("u_root", "v_root").alias("v")).distinct())
        if first:
            known = parent.select("node", F.col("parent").alias("component"))
        else:
            up = parent.select(F.col("node").alias("component"), "parent")
            known = cut_lineage(known.join(up, "component", "left").select("node", F.coalesce("parent", "component").alias("component")))
        first = False
    return known

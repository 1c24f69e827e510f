"""Agglomerative clustering with Ward's criterion.

Ward's distance is reducible: merging two clusters that are each other's nearest never brings the result
closer to a third than both were. All such pairs can therefore be merged in the same round, and the tree is
that of the one-pair-at-a-time algorithm. Each round finds nearest neighbours tile by tile: the clusters are
cut into blocks, every pair of blocks is one task of bounded size, and only the best partner per cluster
leaves it.
"""

from __future__ import annotations

from collections.abc import Sequence
from math import ceil

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.operators.components import components
from tallyloom.session import cut_lineage

# Clusters per block; a tile compares two blocks.
BLOCK = 2048


def _best_partners(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
    """For each left cluster the right one with the least (distance, mix, id).

    ``mix`` scrambles the two ids, the same from both sides. Equal distances are frequent on coded data, and
    a scrambled order among them gives many mutual pairs per round where an order by id gives long chains.
    """
    ida, idb = left["cid"].to_numpy(), right["cid"].to_numpy()
    wa, wb = left["w"].to_numpy(), right["w"].to_numpy()
    a, b = np.stack(left["centre"].to_numpy()), np.stack(right["centre"].to_numpy())
    gap = np.zeros((len(a), len(b)))
    for j in range(a.shape[1]):
        gap += (a[:, j, None] - b[None, :, j]) ** 2
    cost = gap * (wa[:, None] * wb[None, :] / (wa[:, None] + wb[None, :]))
    cost[ida[:, None] == idb[None, :]] = np.inf
    least = cost.min(axis=1)
    rows, cols = np.nonzero(cost == least[:, None])
    low, high = np.minimum(ida[rows], idb[cols]), np.maximum(ida[rows], idb[cols])
    mix = (low * 6364136223846793005 + high) * 1442695040888963407
    mix = (mix ^ (mix >> 29)) & np.iinfo(np.int64).max
    tied = pd.DataFrame({"cid": ida[rows], "partner": idb[cols], "cost": least[rows], "mix": mix})
    tied = tied[np.isfinite(tied["cost"])]
    return tied.sort_values(["cid", "mix", "partner"]).drop_duplicates("cid")


def _nearest(clusters: DataFrame, blocks: int) -> DataFrame:
    """``cid, partner, cost`` of the nearest other cluster."""
    block = F.pmod(F.xxhash64("cid"), F.lit(blocks)).cast("int")
    every = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
    left = clusters.select("*", block.alias("i")).select("*", every.alias("j"))
    right = clusters.select("*", block.alias("j")).select("*", every.alias("i"))
    tiles = left.groupBy("i", "j").cogroup(right.groupBy("i", "j"))

    def tile(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        if a.empty or b.empty:
            return pd.DataFrame({"cid": [], "partner": [], "cost": [], "mix": []})
        return _best_partners(a, b)

    options = tiles.applyInPandas(tile, "cid long, partner long, cost double, mix long")
    rank = F.struct("cost", "mix", F.least("cid", "partner").alias("lo"), F.greatest("cid", "partner").alias("hi"), "partner")
    best = options.groupBy("cid").agg(F.min(rank).alias("b"))
    return best.select("cid", F.col("b.partner").alias("partner"), F.col("b.cost").alias("cost"))


def merge_tree(clusters: DataFrame, block: int = BLOCK) -> DataFrame:
    """``lo, hi, cost, round``: all merges of the clusters ``cid, w, centre`` down to one.

    A merged cluster goes by the smaller id of the two.
    """
    spark = clusters.sparkSession
    now = cut_lineage(clusters)
    left = now.count()
    merges = None
    rounds = 0
    while left > 1:
        near = cut_lineage(_nearest(now, ceil(left / block)))
        mutual = near.alias("x").join(near.alias("y"), (F.col("x.cid") == F.col("y.partner")) & (F.col("x.partner") == F.col("y.cid")))
        pairs = mutual.where(F.col("x.cid") < F.col("y.cid")).select(
            F.col("x.cid").alias("lo"), F.col("y.cid").alias("hi"), F.col("x.cost").alias("cost"), F.lit(rounds).alias("round")
        )
        pairs = cut_lineage(pairs)
        target = pairs.select(F.col("hi").alias("cid"), F.col("lo").alias("to"))
        moved = now.join(target, "cid", "left").withColumn("cid", F.coalesce("to", "cid")).drop("to")
        # At most two rows meet per cluster.
        total = F.sum("w")
        dims = now.select(F.size("centre")).first()[0]
        mean = F.array(*[F.sum(F.col("centre")[i] * F.col("w")) / total for i in range(dims)])
        now = cut_lineage(moved.groupBy("cid").agg(total.alias("w"), mean.alias("centre")))
        merges = pairs if merges is None else merges.unionByName(pairs)
        left = now.count()
        rounds += 1
    return merges if merges is not None else spark.createDataFrame([], "lo long, hi long, cost double, round int")


def ward(df: DataFrame, id_col: str, cols: Sequence[str], k: int, block: int = BLOCK) -> DataFrame:
    """``id, cluster``: k clusters, numbered by their smallest id. Ids must be whole numbers.

    Equal rows merge at no cost, so the tree starts from distinct points with weights; exact while there are
    at least k of those. Comparing all pairs of points is quadratic work, as in the method itself.
    """
    points = df.select(F.col(id_col).cast("long").alias("id"), *[F.col(c).cast("double").alias(c) for c in cols])
    distinct = points.groupBy(*cols).agg(F.count("*").cast("double").alias("w"), F.min("id").alias("cid"))
    distinct = cut_lineage(distinct.withColumn("centre", F.array(*cols)))
    merges = merge_tree(distinct.select("cid", "w", "centre"), block)
    # The last k - 1 merges by cost are undone; a parent never costs less than its children.
    undone = merges.orderBy(F.desc("cost"), F.desc("round"), F.desc("lo")).limit(k - 1).select("lo", "hi", "round")
    kept = merges.join(undone, ["lo", "hi", "round"], "left_anti")
    named = components(kept.select(F.col("hi").alias("u"), F.col("lo").alias("v")))
    rooted = distinct.join(named.withColumnRenamed("node", "cid"), "cid", "left").withColumn("root", F.coalesce("component", "cid"))
    roots = rooted.select("root").distinct()
    ordered = F.array_sort(F.collect_list("root"))
    # k values at most.
    numbers = roots.agg(ordered.alias("all")).select(F.posexplode("all").alias("cluster", "root"))
    labelled = rooted.join(numbers, "root").select(*cols, "cluster")
    return points.join(labelled, list(cols)).select("id", "cluster")

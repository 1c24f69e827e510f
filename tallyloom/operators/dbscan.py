"""Density clustering on a hierarchical grid.

Cells are so small that all points of a cell lie within ``eps`` of each other. A cell that holds
``min_samples`` rows is therefore all core points, without looking at any pair. The other cells hold fewer
than ``min_samples`` distinct points each. Which occupied cells lie within reach of each other is found from coarse
cells down to fine ones, by the boxes around their points, so empty cells cost nothing and any number of columns
will do. Points and crowded cells, or two crowded cells, are compared by boxes that are split only where they must.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from math import ceil, log, sqrt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.operators.components import components
from tallyloom.operators.order import enumerate_rows
from tallyloom.session import cut_lineage

# A cell of one level is so many cells of the next wide.
FACTOR = 8
# Boxes of up to so many points are opened at once.
FEW = 32


def _gap(a: str, b: str, cols: Sequence[str]) -> Column:
    """Square of the distance between two boxes ``<side>_lo_<col>``, ``<side>_hi_<col>``."""
    out = F.lit(0.0)
    for c in cols:
        apart = F.greatest(F.col(f"{a}_lo_{c}") - F.col(f"{b}_hi_{c}"), F.col(f"{b}_lo_{c}") - F.col(f"{a}_hi_{c}"), F.lit(0.0))
        out = out + apart * apart
    return out


def _cells_in_reach(cells: DataFrame, cols: Sequence[str], eps: float, side: float) -> DataFrame:
    """``ca, cb``: different occupied cells whose boxes are within ``eps``, both ways round.

    ``cells``: ``cell, lo_<col>, hi_<col>``. Pairs of coarse cells in reach are opened into pairs of their parts.
    """
    ends = cells.agg(*[F.min(f"lo_{c}").alias(f"a{i}") for i, c in enumerate(cols)], *[F.max(f"hi_{c}").alias(f"b{i}") for i, c in enumerate(cols)]).first()
    width = max((ends[f"b{i}"] - ends[f"a{i}"] for i in range(len(cols)) if ends[f"a{i}"] is not None), default=0.0)
    levels = max(1, ceil(log(width / side + 1, FACTOR)))
    grids = [cells]
    for _ in range(levels):
        up = F.transform("cell", lambda v: F.floor(v / FACTOR))
        boxes = [F.min(f"lo_{c}").alias(f"lo_{c}") for c in cols] + [F.max(f"hi_{c}").alias(f"hi_{c}") for c in cols]
        grids.append(cut_lineage(grids[-1].groupBy(up.alias("cell")).agg(*boxes)))

    def sided(df: DataFrame, tag: str, up: Column) -> DataFrame:
        return df.select(up.alias(f"{tag}_up"), *[F.col(c).alias(f"{tag}_{c}") for c in df.columns])

    # The coarsest cells are at most a few for each column; all of them are parts of one.
    root = F.array(F.lit(0).cast("long"))
    pairs = cells.sparkSession.range(1).select(root.alias("ca"), root.alias("cb"))
    for n in range(levels, -1, -1):
        up = root if n == levels else F.transform("cell", lambda v: F.floor(v / FACTOR))
        a, b = sided(grids[n], "a", up), sided(grids[n], "b", up)
        met = pairs.join(a, F.col("ca") == F.col("a_up")).join(b, F.col("cb") == F.col("b_up"))
        # Of the two orders of a pair within one coarse cell only one goes on.
        once = (F.col("ca") != F.col("cb")) | (F.col("a_cell") <= F.col("b_cell"))
        near = met.where(once & (_gap("a", "b", cols) <= F.lit(float(eps) ** 2)))
        pairs = cut_lineage(near.select(F.col("a_cell").alias("ca"), F.col("b_cell").alias("cb")))
    different = pairs.where("ca <> cb")
    return different.unionByName(different.select(F.col("cb").alias("ca"), F.col("ca").alias("cb")))


def _boxes(points: DataFrame, cols: Sequence[str], side: float, level: int | None) -> DataFrame:
    """Boxes around the points of each part of a cell: ``cell, sub, up``, number of points ``m`` and of rows ``n``.

    Parts are half as wide at each ``level``; without one, every point is a box of its own.
    """
    at = lambda k: F.array(*[F.floor(F.col(c) / F.lit(side / 2**k)) for c in cols])
    ends = [F.col(c).alias(f"t_{e}_{c}") for c in cols for e in ("lo", "hi")]
    if level is None:
        return points.select("cell", F.lit(None).cast("array<bigint>").alias("sub"), "n", F.lit(1).cast("long").alias("m"), *ends)
    boxes = [F.min(c).alias(f"t_lo_{c}") for c in cols] + [F.max(c).alias(f"t_hi_{c}") for c in cols]
    return points.groupBy("cell", at(level).alias("sub"), at(max(level - 1, 0)).alias("up")).agg(F.sum("n").alias("n"), F.count("*").alias("m"), *boxes)


def _rows_in_reach(seek: DataFrame, around: DataFrame, targets: DataFrame, cols: Sequence[str], eps: float, side: float) -> DataFrame:
    """``pid, cb, n``: rows of ``targets`` (``cell, <cols>, n``) in a neighbour cell within ``eps`` of a point of ``seek``
    (``pid, ca, h_<col>``). A box that is in reach as a whole counts at once, one that is out of reach is dropped.
    """
    limit = F.lit(float(eps) ** 2)
    place = ["pid", *[f"h_{c}" for c in cols]]
    todo, found, level = seek.join(around, "ca").select(*place, "cb"), None, 0
    targets = cut_lineage(targets)
    while True:
        boxes = _boxes(targets, cols, side, level)
        on = F.col("cb") == F.col("cell")
        if level:
            on = on & (F.col("s") == F.col("up"))
        near, far = F.lit(0.0), F.lit(0.0)
        for c in cols:
            here, lo, hi = F.col(f"h_{c}"), F.col(f"t_lo_{c}"), F.col(f"t_hi_{c}")
            apart, span = F.greatest(lo - here, here - hi, F.lit(0.0)), F.greatest(hi - here, here - lo)
            near, far = near + apart * apart, far + span * span
        judged = todo.join(boxes, on).withColumns({"near": near, "far": far}).where(F.col("near") <= limit)
        judged = cut_lineage(judged.select(*place, "cb", "sub", "n", "m", (F.col("far") <= limit).alias("whole")))
        parts = [judged.where("whole").select("pid", "cb", "n")]
        rest = judged.where("NOT whole")
        few = rest.where(F.col("m") <= FEW).select(*place, "cb", F.col("sub").alias("s")).distinct()
        points = targets.withColumn("sub", F.array(*[F.floor(F.col(c) / F.lit(side / 2**level)) for c in cols]))
        gap = F.lit(0.0)
        for c in cols:
            gap = gap + (F.col(f"h_{c}") - F.col(c)) * (F.col(f"h_{c}") - F.col(c))
        met = few.join(points, (F.col("cb") == F.col("cell")) & (F.col("s") == F.col("sub"))).where(gap <= limit)
        parts.append(met.select("pid", "cb", "n"))
        found = reduce(DataFrame.unionByName, parts if found is None else [found, *parts])
        todo = rest.where(F.col("m") > FEW).select(*place, "cb", F.col("sub").alias("s"))
        if todo.isEmpty():
            return found.groupBy("pid", "cb").agg(F.sum("n").alias("n"))
        level += 1


def _touching(core: DataFrame, pairs: DataFrame, cols: Sequence[str], eps: float, side: float) -> DataFrame:
    """The cell pairs ``ca < cb`` with two core points within ``eps``.

    Boxes around the core points of each cell are compared: too far apart ends a pair, close enough (by their
    farthest corners or by one sample point each) joins it, anything else goes on with boxes half the size.
    """
    limit = F.lit(float(eps) ** 2)

    def boxes(level: int) -> DataFrame:
        sub = F.array(*[F.floor(F.col(c) / F.lit(side / 2**level)) for c in cols])
        up = F.array(*[F.floor(F.col(c) / F.lit(side / 2 ** max(level - 1, 0))) for c in cols])
        return core.groupBy("cell", sub.alias("sub"), up.alias("up")).agg(
            *[F.min(c).alias(f"lo_{c}") for c in cols],
            *[F.max(c).alias(f"hi_{c}") for c in cols],
            *[F.min_by(c, "pid").alias(f"at_{c}") for c in cols],
        )

    def sided(df: DataFrame, tag: str) -> DataFrame:
        return df.select(*[F.col(c).alias(f"{tag}_{c}") for c in df.columns])

    joined = None
    open_pairs = pairs.select("ca", "cb")
    level = 0
    while True:
        b = boxes(level)
        left, right = sided(b, "a"), sided(b, "b")
        on_a, on_b = F.col("ca") == F.col("a_cell"), F.col("cb") == F.col("b_cell")
        if level:
            on_a, on_b = on_a & (F.col("sa") == F.col("a_up")), on_b & (F.col("sb") == F.col("b_up"))
        met = open_pairs.join(left, on_a).join(right, on_b)
        near, far, sample = F.lit(0.0), F.lit(0.0), F.lit(0.0)
        for c in cols:
            apart = F.greatest(
                F.col(f"a_lo_{c}") - F.col(f"b_hi_{c}"), F.col(f"b_lo_{c}") - F.col(f"a_hi_{c}"), F.lit(0.0)
            )
            span = F.greatest(F.col(f"a_hi_{c}"), F.col(f"b_hi_{c}")) - F.least(F.col(f"a_lo_{c}"), F.col(f"b_lo_{c}"))
            gap = F.col(f"a_at_{c}") - F.col(f"b_at_{c}")
            near, far, sample = near + apart * apart, far + span * span, sample + gap * gap
        judged = met.where(near <= limit).select(
            "ca", "cb", F.col("a_sub").alias("sa"), F.col("b_sub").alias("sb"), ((far <= limit) | (sample <= limit)).alias("hit")
        )
        judged = cut_lineage(judged)
        hits = judged.where("hit").select("ca", "cb").distinct()
        joined = hits if joined is None else joined.unionByName(hits)
        open_pairs = judged.where("NOT hit").join(hits, ["ca", "cb"], "left_anti").select("ca", "cb", "sa", "sb")
        if open_pairs.isEmpty():
            return joined
        level += 1


def dbscan(df: DataFrame, id_col: str, cols: Sequence[str], eps: float, min_samples: int) -> DataFrame:
    """``id, cluster, core``: noise is -1, clusters are numbered by their first core row in id order.

    ``min_samples`` counts the point itself; a border point joins the first cluster with a core point in reach.
    Rows with a value that is null, NaN or infinite are noise.
    """
    cols = list(cols)
    side = eps / sqrt(len(cols))
    cell = F.array(*[F.floor(F.col(c) / F.lit(side)) for c in cols])
    points = df.select(id_col, *[F.col(c).cast("double").alias(c) for c in cols])
    # Rows without a place are noise: null, NaN and infinite values are not below infinity.
    placed = points.where(reduce(Column.__and__, [F.abs(F.col(c)) < F.lit(float("inf")) for c in cols]))
    distinct = placed.groupBy(*cols).agg(F.count("*").alias("n"), F.min(id_col).alias("pid")).withColumn("cell", cell)
    distinct = cut_lineage(distinct)
    boxes = [F.min(c).alias(f"lo_{c}") for c in cols] + [F.max(c).alias(f"hi_{c}") for c in cols]
    cells = cut_lineage(distinct.groupBy("cell").agg(F.sum("n").alias("weight"), *boxes))
    around = cut_lineage(_cells_in_reach(cells.drop("weight"), cols, eps, side))

    sparse = distinct.join(cells.where(F.col("weight") < min_samples).select("cell", "weight"), "cell")
    seekers = cut_lineage(sparse.select("pid", "weight", F.col("cell").alias("ca"), *[F.col(c).alias(f"h_{c}") for c in cols]))
    counted = _rows_in_reach(seekers, around, distinct.select("cell", *cols, "n"), cols, eps, side).groupBy("pid").agg(F.sum("n").alias("m"))
    sparse_core = seekers.join(counted, "pid", "left").where(F.col("weight") + F.coalesce("m", F.lit(0)) >= min_samples)
    dense_core = distinct.join(cells.where(F.col("weight") >= min_samples), "cell", "left_semi").select("pid")
    core_ids = cut_lineage(dense_core.unionByName(sparse_core.select("pid")))
    core = cut_lineage(distinct.join(core_ids, "pid", "left_semi"))

    core_cells = cut_lineage(core.groupBy("cell").agg(F.min("pid").alias("root")))
    left = core_cells.select(F.col("cell").alias("ca"), F.col("root").alias("u"))
    right = core_cells.select(F.col("cell").alias("cb"), F.col("root").alias("v"))
    pairs = around.where(F.col("ca") < F.col("cb")).join(left, "ca").join(right, "cb")
    touching = _touching(core, pairs, cols, eps, side)
    edges = touching.join(left, "ca").join(right, "cb").select("u", "v")
    merged = components(edges)
    # The name of a component is its smallest core id, as roots are the smallest ids of their cells.
    by_cell = core_cells.join(merged.withColumnRenamed("node", "root"), "root", "left").select(
        "cell", F.coalesce("component", "root").alias("component")
    )
    numbers = enumerate_rows(by_cell.select("component").distinct(), "component", name="cluster")
    by_cell = cut_lineage(by_cell.join(numbers, "component").select("cell", "cluster"))

    core_labels = core.join(by_cell, "cell").select("pid", "cluster", F.lit(True).alias("core"))
    loose = seekers.join(core_ids, "pid", "left_anti")
    reached = _rows_in_reach(loose, around, core.select("cell", *cols, "n"), cols, eps, side)
    reached = reached.join(by_cell.withColumnRenamed("cell", "cb"), "cb")
    own = loose.join(by_cell.withColumnRenamed("cell", "ca"), "ca").select("pid", "cluster")
    border = reached.select("pid", "cluster").unionByName(own).groupBy("pid").agg(F.min("cluster").alias("cluster"))
    labels = core_labels.unionByName(border.withColumn("core", F.lit(False)))
    labelled = distinct.join(labels, "pid", "left").select(*cols, "cluster", "core")
    return points.join(labelled, cols, "left").select(
        F.col(id_col).alias("id"), F.coalesce("cluster", F.lit(-1)).alias("cluster"), F.coalesce("core", F.lit(False)).alias("core")
    )

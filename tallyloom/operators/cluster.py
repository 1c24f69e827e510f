"""k-means in its variants, and how good the clusters are."""

from __future__ import annotations

import time
from collections.abc import Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import inheritable_thread_target
from pyspark.ml.clustering import KMeans
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallyloom.functions.colour import hex_colour
from tallyloom.operators.features import _first_by_hash
from tallyloom.operators.order import enumerate_rows
from tallyloom.session import cut_lineage
from tallyloom.sources.generate import unit_hash

Centres = Sequence[Sequence[float]]


def nearest(cols: Sequence[str], centres: Centres) -> Column:
    """``struct<d, i>``: squared distance to, and index of, the nearest centre (ties: first one)."""
    options = []
    for i, centre in enumerate(centres):
        gaps = [(F.col(c) - F.lit(float(v))) * (F.col(c) - F.lit(float(v))) for c, v in zip(cols, centre)]
        options.append(F.struct(sum(gaps[1:], gaps[0]).alias("d"), F.lit(i).alias("i")))
    return F.array_min(F.array(*options))


@dataclass(frozen=True)
class CentreFit:
    """Centres over named columns, with the sum of squared distances they reached."""

    cols: tuple[str, ...]
    centres: tuple[tuple[float, ...], ...]
    inertia: float

    def assign(self, df: DataFrame, name: str = "cluster") -> DataFrame:
        return df.withColumn(name, nearest(self.cols, self.centres)["i"])

    def table(self, df: DataFrame) -> DataFrame:
        """``cluster`` and one column per coordinate."""
        rows = [(i, *map(float, c)) for i, c in enumerate(self.centres)]
        return df.sparkSession.createDataFrame(rows, "cluster int, " + ", ".join(f"{c} double" for c in self.cols))


def weighted_points(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Distinct points with their number ``n``: exact for k-means, and far fewer rows for colours or codes."""
    points = df.select(*[F.col(c).cast("double").alias(c) for c in cols]).dropna()
    return points.groupBy(*cols).agg(F.count("*").cast("double").alias("n"))


def fit_kmeans(df: DataFrame, cols: Sequence[str], k: int, n_init: int = 1, seed: int = 0, max_iter: int = 20) -> CentreFit:
    """k-means, best of ``n_init`` starts by inertia."""
    return _fit_many(df, cols, [k], n_init, seed, max_iter)[0]


def _fit_many(
    df: DataFrame, cols: Sequence[str], ks: Sequence[int], n_init: int, seed: int, max_iter: int, parallel: int = 3
) -> list[CentreFit]:
    points = cut_lineage(weighted_points(df, cols), spread=True)
    made = VectorAssembler(inputCols=list(cols), outputCol="features").transform(points)
    # Not cached here: each fit caches its own unpacked vectors, which is much faster to iterate over.
    data = made.select("features", "n")

    def fit(k: int) -> CentreFit:
        best = None
        for start in range(n_init):
            model = KMeans(k=k, seed=seed + start, maxIter=max_iter, weightCol="n").fit(data)
            if best is None or model.summary.trainingCost < best.summary.trainingCost:
                best = model
        centres = sorted(tuple(float(v) for v in c) for c in best.clusterCenters())
        return CentreFit(tuple(cols), tuple(centres), float(best.summary.trainingCost))

    # The fits are independent: the waits between the many short jobs of one are filled by others.
    with ThreadPoolExecutor(parallel) as pool:
        return list(pool.map(inheritable_thread_target(fit), ks))


def elbow(df: DataFrame, cols: Sequence[str], ks: Sequence[int], n_init: int = 1, seed: int = 0, max_iter: int = 20) -> DataFrame:
    """``k, inertia`` for several k; the points are read and reduced once."""
    fits = _fit_many(df, cols, ks, n_init, seed, max_iter)
    return df.sparkSession.createDataFrame([(k, f.inertia) for k, f in zip(ks, fits)], "k int, inertia double")


def lloyd_step(df: DataFrame, cols: Sequence[str], centres: Centres) -> DataFrame:
    """One step from given centres: ``cluster``, the new coordinates and ``n``."""
    placed = df.select(*cols, nearest(cols, centres)["i"].alias("cluster"))
    return placed.groupBy("cluster").agg(*[F.avg(c).alias(c) for c in cols], F.count("*").alias("n"))


def inertia(df: DataFrame, cols: Sequence[str], centres: Centres) -> DataFrame:
    """Sum of squared distances to the nearest centre."""
    return df.agg(F.sum(nearest(cols, centres)["d"]).alias("inertia"))


def cluster_sizes(df: DataFrame, label: str) -> DataFrame:
    """``cluster, n, share``."""
    rows = df.agg(F.count("*")).scalar()
    sizes = df.groupBy(F.col(label).alias("cluster")).agg(F.count("*").alias("n"))
    return sizes.withColumn("share", F.col("n") / rows)


def compare_centres(a: DataFrame, b: DataFrame, cols: Sequence[str]) -> DataFrame:
    """For each centre of ``a`` the nearest of ``b`` and its distance: ``cluster, nearest, distance``.

    Both are tables ``cluster, <cols>`` of a few rows; ``b`` is packed into one value.
    """
    other = b.agg(F.array_sort(F.collect_list(F.struct("cluster", *cols)))).scalar()

    def gap(o: Column) -> Column:
        parts = [(F.col(c) - o[c]) * (F.col(c) - o[c]) for c in cols]
        return F.struct(F.sqrt(sum(parts[1:], parts[0])).alias("d"), o["cluster"].alias("cluster"))

    best = F.array_min(F.transform("_other", gap))
    found = a.withColumn("_other", other).select("cluster", best.alias("_b"))
    return found.select("cluster", F.col("_b.cluster").alias("nearest"), F.col("_b.d").alias("distance"))


def extract_palette(px: DataFrame, n_colors: int = 5, n_init: int = 2, seed: int = 0) -> DataFrame:
    """``colour, n, share`` of the predominant colours, most frequent first."""
    bands = ["r", "g", "b"]
    counts = px.groupBy(*bands).agg(F.count("*").alias("n"))
    fit = fit_kmeans(px, bands, n_colors, n_init, seed)
    sizes = fit.assign(counts).groupBy("cluster").agg(F.sum("n").alias("n"))
    all_px = counts.agg(F.sum("n")).scalar()
    table = fit.table(px).join(sizes, "cluster")
    colour = hex_colour(*[F.col(b) for b in bands]).alias("colour")
    return table.select(colour, "n", (F.col("n") / all_px).alias("share")).orderBy(F.desc("n"), "colour")


def fit_kmeans_grouped(
    df: DataFrame,
    group: str,
    cols: Sequence[str],
    ks: Sequence[int],
    n_init: int = 1,
    seed: int = 0,
    max_iter: int = 10,
    tol: float = 1e-4,
) -> DataFrame:
    """k-means within every group, for every k, all at once: ``group, k, cluster, <cols>, n, inertia``.

    Points are reduced to distinct ones with weights and packed into blocks of one group. Each round joins the
    blocks with the centres of their group, adds up new centres for all models block by block, and then over all
    blocks. ``inertia`` is that of the model; the best of ``n_init`` starts is kept. A null group has no model.
    """
    points = df.select(group, *[F.col(c).cast("double").alias(c) for c in cols]).dropna()
    points = cut_lineage(points.groupBy(group, *cols).agg(F.count("*").alias("n")))
    sizes = points.where(F.col(group).isNotNull()).groupBy(group).agg(F.count("*").alias("_size"))
    # Groups of any type go by their number.
    groups = cut_lineage(enumerate_rows(sizes, group, name="_g"))
    centre = F.array(*cols)
    starts = None
    for start in range(n_init):
        pick = F.row_number().over(W.partitionBy(group).orderBy(unit_hash(*[F.col(c) for c in cols], seed=seed + start), *cols))
        ranked = points.select(group, centre.alias("centre"), pick.alias("rank")).where(F.col("rank") <= max(ks))
        ranked = ranked.withColumn("k", F.explode(F.array(*[F.lit(k) for k in ks]))).where(F.col("rank") <= F.col("k"))
        rows = ranked.join(groups, group).select("_g", "k", F.lit(start).alias("start"), (F.col("rank") - 1).alias("cluster"), "centre")
        starts = rows if starts is None else starts.unionByName(rows)
    centres = cut_lineage(starts)
    blocks = _point_blocks(points, groups, group, cols)
    key = ["_g", "k", "start", "cluster"]

    for _ in range(max_iter):
        moved = _sums(blocks, centres, len(cols)).select(*key, F.transform("sums", lambda v: v / F.col("n")).alias("to"))
        step = cut_lineage(centres.join(moved, key, "left"))
        gaps = F.zip_with("centre", F.coalesce("to", "centre"), lambda a, b: (a - b) * (a - b))
        shift = step.agg(F.max(F.array_max(gaps))).first()[0]
        centres = step.select(*key, F.coalesce("to", "centre").alias("centre"))
        if shift is None or shift <= tol * tol:
            break
    found = cut_lineage(_sums(blocks, centres, len(cols)).select(*key, "n", "cost"))
    cost = found.groupBy("_g", "k", "start").agg(F.sum("cost").alias("inertia"))
    best = cost.groupBy("_g", "k").agg(F.min(F.struct("inertia", "start")).alias("_b"))
    best = best.select("_g", "k", F.col("_b.start").alias("start"), F.col("_b.inertia").alias("inertia"))
    table = centres.join(best, ["_g", "k", "start"]).join(found.drop("cost"), key, "left").fillna(0, ["n"]).join(groups, "_g")
    return table.select(group, "k", "cluster", *[F.col("centre")[i].alias(c) for i, c in enumerate(cols)], "n", "inertia")


def _point_blocks(points: DataFrame, groups: DataFrame, group: str, cols: Sequence[str], block: int = 256) -> DataFrame:
    """``_g, x, w``: about ``block`` points of one group, coordinate by coordinate, and their weights."""
    part = F.pmod(F.xxhash64(*cols), F.ceil(F.col("_size") / block)).alias("_part")
    dealt = points.join(groups, group).select("_g", part, F.struct(*[F.col(c).alias(f"x{i}") for i, c in enumerate(cols)], "n").alias("p"))
    packed = dealt.groupBy("_g", "_part").agg(F.collect_list("p").alias("p"))
    x = F.concat(*[F.col(f"p.x{i}") for i in range(len(cols))])
    return cut_lineage(packed.select("_g", x.alias("x"), F.col("p.n").alias("w")), spread=True)


def _closest(gap: np.ndarray) -> np.ndarray:
    """Index of the smallest number of each row (ties: first one); NaN, the gap of infinite numbers, is the largest."""
    best = gap.argmin(axis=1)
    for i in np.flatnonzero(np.isnan(gap[np.arange(len(gap)), best])):
        best[i] = min(range(gap.shape[1]), key=lambda j: (np.isnan(gap[i, j]), gap[i, j]))
    return best


def _sums(blocks: DataFrame, centres: DataFrame, width: int) -> DataFrame:
    """``_g, k, start, cluster, n, cost, sums``: blocks of points meet one row of all centres of their group."""
    models = centres.groupBy("_g").agg(F.sort_array(F.collect_list(F.struct("k", "start", "cluster", "centre"))).alias("m"))
    models = models.select("_g", F.col("m.k").alias("k"), F.col("m.start").alias("start"), F.col("m.cluster").alias("cluster"), F.flatten("m.centre").alias("c"))

    def add(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            made = []
            for p in frame.itertuples(index=False):
                x, w, c = np.asarray(p.x, float).reshape(width, -1), np.asarray(p.w, float), np.asarray(p.c, float).reshape(-1, width)
                with np.errstate(invalid="ignore", over="ignore"):
                    gap = (x[0][:, None] - c[None, :, 0]) ** 2
                    for i in range(1, width):
                        gap += (x[i][:, None] - c[None, :, i]) ** 2
                    first = np.flatnonzero(np.r_[True, (np.diff(p.k) != 0) | (np.diff(p.start) != 0)])
                    at = np.stack([lo + _closest(gap[:, lo:hi]) for lo, hi in zip(first, np.r_[first[1:], len(c)])])
                    slot = at.ravel()

                    def total(values: np.ndarray, slot: np.ndarray = slot, n: int = len(c)) -> np.ndarray:
                        return np.bincount(slot, values.ravel(), n)

                    each = np.broadcast_to(w, at.shape)
                    cost = total(gap[np.arange(len(w)), at] * w)
                    sums = [total(np.broadcast_to(x[i] * w, at.shape)) for i in range(width)]
                n = total(each)
                some = n > 0
                made.append((np.full(some.sum(), p[0]), *(np.asarray(v)[some] for v in (p.k, p.start, p.cluster, n, cost, *sums))))
            if made:
                yield pd.DataFrame({name: np.concatenate(v) for name, v in zip(names, zip(*made))})

    names = ["_g", "k", "start", "cluster", "n", "cost", *[f"s{i}" for i in range(width)]]
    kinds = "_g long, k int, start int, cluster int, n long, cost double, " + ", ".join(f"s{i} double" for i in range(width))
    found = blocks.join(models, "_g").select("_g", "x", "w", "k", "start", "cluster", "c").mapInPandas(add, kinds)
    return found.groupBy("_g", "k", "start", "cluster").agg(
        F.sum("n").alias("n"), F.sum("cost").alias("cost"), F.array(*[F.sum(f"s{i}") for i in range(width)]).alias("sums")
    )


def minibatch_step(
    centres: np.ndarray, counts: np.ndarray, batch: DataFrame, cols: Sequence[str], weight: str | None = None
) -> tuple[np.ndarray, np.ndarray]:
    """Move centres towards a batch: each becomes the running mean of all points it has been given, ``weight`` times."""
    n = F.col(weight) if weight else F.lit(1)
    placed = batch.select(*cols, n.alias("_w"), nearest(cols, centres.tolist())["i"].alias("cluster"))
    sums = placed.groupBy("cluster").agg(*[F.sum(F.col(c) * F.col("_w")).alias(c) for c in cols], F.sum("_w").alias("n")).where("n > 0").collect()
    centres, counts = centres.copy(), counts.copy()
    for row in sums:
        i, n = row["cluster"], row["n"]
        counts[i] += n
        centres[i] += (np.array([row[c] for c in cols]) / n - centres[i]) * (n / counts[i])
    return centres, counts


def draw_batches(df: DataFrame, cols: Sequence[str], batch: int, steps: int, seed: int = 0) -> DataFrame:
    """``<cols>, step, drawn``: how often each different point is in each of ``steps`` batches of about ``batch`` rows.

    A point that occurs n times is expected n * batch / rows times in a batch: the whole part is certain, the rest is drawn by a
    hash of the point and the step. So batches come out even whichever rows are equal, and do not depend on the layout.
    """
    points = cut_lineage(weighted_points(df, cols))
    rows = points.agg(F.sum("n")).scalar()
    each = points.withColumn("step", F.explode(F.sequence(F.lit(0), F.lit(steps - 1)))).withColumn("_e", F.col("n") * F.least(F.lit(1.0), F.lit(float(batch)) / rows))
    more = unit_hash(*[F.col(c) for c in cols], F.col("step"), seed=seed) < F.col("_e") - F.floor("_e")
    return each.select(*cols, "step", (F.floor("_e") + more.cast("long")).alias("drawn")).where("drawn > 0")


def fit_minibatch_kmeans(
    df: DataFrame, cols: Sequence[str], k: int, batch: int = 1024, steps: int = 10, seed: int = 0
) -> CentreFit:
    """Mini-batch k-means: the different points are counted once, and batches are drawn among them by their weight."""
    drawn = cut_lineage(draw_batches(df, cols, batch, steps, seed + 1))
    spread = drawn.select(*cols).distinct().orderBy(unit_hash(*[F.col(c) for c in cols], seed=seed), *cols).limit(k)
    centres = np.array([[float(v) for v in r] for r in spread.collect()])
    counts = np.zeros(len(centres))
    for step in range(steps):
        centres, counts = minibatch_step(centres, counts, drawn.where(F.col("step") == step), cols, "drawn")
    ordered = tuple(sorted(tuple(float(v) for v in c) for c in centres))
    points = df.select(*[F.col(c).cast("double").alias(c) for c in cols]).dropna()
    return CentreFit(tuple(cols), ordered, float(inertia(points, cols, ordered).first()["inertia"]))


def as_array(cols: Sequence[str] | str) -> Column:
    """Several numeric columns, or one array column, as an array of doubles."""
    return F.col(cols).cast("array<double>") if isinstance(cols, str) else F.array(*[F.col(c).cast("double") for c in cols])


def _distances(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Euclidean distances of all rows of ``x`` to all rows of ``y``.

    A matrix product gives them but for pairs so close, or so odd, that it loses digits: these are compared once more.
    """
    whole = x[np.isfinite(x).all(axis=1)]
    middle = whole.mean(axis=0) if len(whole) else np.zeros(x.shape[1])
    with np.errstate(invalid="ignore", over="ignore"):
        p, q = x - middle, y - middle
        size = (p * p).sum(axis=1)[:, None] + (q * q).sum(axis=1)
        gap = p @ q.T
        gap *= -2
        gap += size
        size *= 1e-4
        rows, cols = np.nonzero(~(gap > size))
        for lo in range(0, len(rows), 8192):
            r, c = rows[lo : lo + 8192], cols[lo : lo + 8192]
            gap[r, c] = ((x[r] - y[c]) ** 2).sum(axis=1)
        return np.sqrt(gap, out=gap)


def silhouette_values(df: DataFrame, id_col: str, cols: Sequence[str] | str, label: str, block: int = 256, wide: int | None = None) -> DataFrame:
    """``id, label, a, b, silhouette`` of every row with Euclidean distances to all others.

    Rows are cut into wide blocks; each pair of them is one task row that adds up the distances per row and cluster, for the
    rows of both, ``block`` rows at a time, so the pairs of rows are never rows of a table. A wide block is a 16th of the rows,
    within bounds that keep a pair in a task's memory. The work is quadratic by nature. A row alone in its cluster, or with
    no other cluster, scores 0; rows without a label or a vector take no part.
    """
    rows = df.select(F.col(id_col).alias("id"), F.col(label).alias("label"), as_array(cols).alias("v")).dropna()
    kinds = cut_lineage(enumerate_rows(rows.groupBy("label").agg(F.count("*").alias("size")), "label", name="kind"))
    placed = cut_lineage(enumerate_rows(rows.join(kinds.select("label", "kind"), "label"), ["id", "label"], name="n"))
    last = placed.agg(F.max("n")).first()[0] or 0
    wide = wide or min(32768, max(2048, last // 16 + 1))
    held = F.sort_array(F.collect_list(F.struct("n", "kind", "v")))
    packed = placed.groupBy(F.floor(F.col("n") / wide).alias("a")).agg(held.alias("r"))
    packed = cut_lineage(packed.select("a", F.col("r.kind").alias("a_kinds"), F.flatten("r.v").alias("a_v")))
    other = packed.toDF("b", "b_kinds", "b_v")
    count = last // wide + 1
    # Each pair of blocks once, and few of them in a task.
    pairs = packed.withColumn("b", F.explode(F.sequence("a", F.lit(count - 1).cast("bigint")))).join(other, "b")
    tasks = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), df.sparkSession.sparkContext.defaultParallelism, count * (count + 1) // 2)

    def add(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for p in frame.itertuples():
                (x, own), (y, far) = ((np.asarray(v, float).reshape(len(k), -1), np.unique(k, return_inverse=True)) for v, k in ((p.a_v, p.a_kinds), (p.b_v, p.b_kinds)))
                mine, theirs = ((at[:, None] == np.arange(len(there))).astype(float) for there, at in (own, far))
                back = np.zeros((len(y), len(own[0])))
                for lo in range(0, len(x), block):
                    part = slice(lo, lo + block)
                    gap = _distances(x[part], y)
                    sums = gap @ theirs
                    n = p.a * wide + lo + np.arange(len(sums))
                    yield pd.DataFrame({"n": np.repeat(n, len(far[0])), "other": np.tile(far[0], len(sums)), "total": sums.ravel()})
                    if p.a != p.b:
                        back += gap.T @ mine[part]
                if p.a != p.b:
                    n = p.b * wide + np.arange(len(y))
                    yield pd.DataFrame({"n": np.repeat(n, len(own[0])), "other": np.tile(own[0], len(y)), "total": back.ravel()})

    sums = pairs.repartition(tasks, "a", "b").mapInPandas(add, "n long, other long, total double")
    sums = sums.groupBy("n", "other").agg(F.sum("total").alias("total")).join(kinds.select(F.col("kind").alias("other"), "size"), "other")
    sums = sums.join(placed.select("n", "id", "label", "kind"), "n")
    own = F.col("other") == F.col("kind")
    a = F.max(F.when(own & (F.col("size") > 1), F.col("total") / (F.col("size") - 1)))
    b = F.min(F.when(~own, F.col("total") / F.col("size")))
    found = sums.groupBy("n", "id", "label").agg(a.alias("a"), b.alias("b"))
    score = F.coalesce(F.try_divide(F.col("b") - F.col("a"), F.when(F.col("a").isNotNull() & F.col("b").isNotNull(), F.greatest("a", "b"))), F.lit(0.0))
    return found.select("id", "label", "a", "b", score.alias("silhouette"))


def silhouette(df: DataFrame, id_col: str, cols: Sequence[str] | str, label: str) -> DataFrame:
    """Mean silhouette of all rows."""
    return silhouette_values(df, id_col, cols, label).agg(F.avg("silhouette").alias("silhouette"))


def silhouette_sample(df: DataFrame, id_col: str, cols: Sequence[str] | str, label: str, n: int, seed: int = 0) -> DataFrame:
    """``silhouette, rows_used``: mean silhouette of a seeded sample of at most ``n`` rows, compared with each other."""
    rows = df.select(F.col(id_col).alias("id"), F.col(label).alias("label"), as_array(cols).alias("v")).dropna()
    rows = rows.where(_first_by_hash(rows, "id", {0: n}, F.lit(0), seed))
    return silhouette_values(rows, "id", "v", "label").agg(F.avg("silhouette").alias("silhouette"), F.count("*").alias("rows_used"))


def silhouette_squared(df: DataFrame, cols: Sequence[str] | str, label: str) -> DataFrame:
    """Mean silhouette over all rows with squared Euclidean distances, which need no pairs."""
    rows = df.select(array_to_vector(as_array(cols)).alias("features"), F.col(label).cast("int").alias("prediction"))
    value = ClusteringEvaluator(featuresCol="features", predictionCol="prediction").evaluate(rows)
    return df.sparkSession.createDataFrame([(float(value),)], "silhouette double")


def quality_table(
    df: DataFrame, id_col: str, cols: Sequence[str], ks: Sequence[int], n_init: int = 1, seed: int = 0, sample: int = 10_000
) -> DataFrame:
    """``k, inertia, silhouette, rows_used, seconds``: one fit per k with its quality (of a sample) and duration."""
    rows = []
    for k in ks:
        begun = time.perf_counter()
        fit = fit_kmeans(df, cols, k, n_init, seed)
        seconds = time.perf_counter() - begun
        score = silhouette_sample(fit.assign(df), id_col, cols, "cluster", sample, seed).first()
        rows.append((k, fit.inertia, float(score["silhouette"]), score["rows_used"], seconds))
    return df.sparkSession.createDataFrame(rows, "k int, inertia double, silhouette double, rows_used long, seconds double")

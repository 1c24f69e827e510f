"""Density and Ward clustering against plain textbook versions on small data."""

import numpy as np
import pandas as pd
import pytest

from tallyloom.operators.dbscan import dbscan
from tallyloom.operators.ward import ward


def plain_dbscan(points, eps, min_samples):
    gap = np.sqrt(((points[:, None, :] - points[None, :, :]) ** 2).sum(axis=2))
    near = gap <= eps
    core = near.sum(axis=1) >= min_samples
    labels = np.full(len(points), -1)
    cluster = 0
    for start in range(len(points)):
        if not core[start] or labels[start] != -1:
            continue
        stack = [start]
        while stack:
            p = stack.pop()
            if labels[p] != -1:
                continue
            labels[p] = cluster
            if core[p]:
                stack.extend(np.flatnonzero(near[p] & (labels == -1)))
        cluster += 1
    return labels, core


@pytest.mark.parametrize(
    "dims, eps, min_samples, whole",
    [(2, 0.05, 5, False), (2, 1.0, 2, True), (3, 0.15, 4, False), (1, 0.004, 6, False), (8, 0.2, 5, False)],
)
def test_dbscan_equals_plain_version(spark, dims, eps, min_samples, whole):
    rng = np.random.default_rng(dims)
    blobs = [rng.normal(rng.random(dims), 0.03, (90, dims)) for _ in range(4)]
    points = np.vstack([*blobs, rng.random((60, dims))])
    if whole:
        points = np.floor(points * 12)
    names = [f"x{i}" for i in range(dims)]
    pdf = pd.DataFrame(points, columns=names)
    pdf["id"] = np.arange(len(pdf))
    found = dbscan(spark.createDataFrame(pdf), "id", names, eps, min_samples).toPandas().sort_values("id")
    labels, core = plain_dbscan(points, eps, min_samples)
    assert found["core"].tolist() == core.tolist()
    assert found["cluster"].tolist() == labels.tolist()


def test_dbscan_around_a_crowded_cell(spark):
    """Most points in one cell, loose ones around it: boxes are split, and rows without a place stay noise."""
    rng = np.random.default_rng(9)
    points = np.vstack([rng.normal(0, 0.05, (400, 2)), rng.uniform(-1, 1, (60, 2)), np.zeros((30, 2))])
    pdf = pd.DataFrame(points, columns=["x", "y"])
    pdf["id"] = np.arange(len(pdf))
    odd = [(float("nan"), 0.0, 1000), (None, 0.0, 1001), (float("inf"), 0.0, 1002)]
    df = spark.createDataFrame(pdf).unionByName(spark.createDataFrame(odd, "x double, y double, id long"))
    found = dbscan(df, "id", ["x", "y"], 0.3, 4).toPandas().sort_values("id")
    labels, core = plain_dbscan(points, 0.3, 4)
    assert found["core"].tolist() == core.tolist() + [False] * 3
    assert found["cluster"].tolist() == labels.tolist() + [-1] * 3


def test_dbscan_of_no_rows(spark):
    assert dbscan(spark.createDataFrame([], "id long, x double"), "id", ["x"], 1.0, 2).count() == 0


def plain_ward(points, k):
    clusters = [[i] for i in range(len(points))]
    while len(clusters) > k:
        best = None
        for i in range(len(clusters)):
            for j in range(i):
                a, b = points[clusters[i]], points[clusters[j]]
                cost = len(a) * len(b) / (len(a) + len(b)) * ((a.mean(axis=0) - b.mean(axis=0)) ** 2).sum()
                if best is None or cost < best[0]:
                    best = (cost, i, j)
        _, i, j = best
        clusters[j] += clusters.pop(i)
    return {frozenset(c) for c in clusters}


@pytest.mark.parametrize("k, block", [(3, 2048), (5, 16)])
def test_ward_equals_naive_merging(spark, k, block):
    points = np.random.default_rng(k).random((50, 2))
    points[10:14] = points[10]
    pdf = pd.DataFrame(points, columns=["x", "y"])
    pdf["id"] = np.arange(len(pdf))
    found = ward(spark.createDataFrame(pdf), "id", ["x", "y"], k, block).toPandas()
    sets = {frozenset(g["id"]) for _, g in found.groupby("cluster")}
    assert sets == plain_ward(points, k)
    firsts = found.groupby("cluster")["id"].min().tolist()
    assert firsts == sorted(firsts)

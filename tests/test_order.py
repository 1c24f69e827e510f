"""The block paths for very long series must agree with plain windows."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tallyloom.operators import order
from tallyloom.operators.components import components
from tallyloom.operators.quantiles import exact_quantiles


@pytest.fixture(scope="module")
def series(spark):
    rng = np.random.default_rng(0)
    key = np.where(rng.random(400) < 0.6, 0, rng.integers(1, 6, 400))
    pdf = pd.DataFrame({"k": key, "t": rng.permutation(400), "kind": rng.choice(list("ab"), 400), "v": rng.integers(0, 50, 400)})
    return spark.createDataFrame(pdf).cache()


def rows(df, *cols):
    return sorted(tuple(map(str, r)) for r in df.select(*cols).collect())


@pytest.mark.parametrize("block", [7, 64])
def test_running_sum(series, block):
    plain = order.running_sum(series, ["k"], "t", "v")
    cut = order.running_sum(series, ["k"], "t", "v", block_rows=block)
    assert rows(plain, "k", "t", "running") == rows(cut, "k", "t", "running")


@pytest.mark.parametrize("block", [7, 64])
def test_consecutive_groups(series, block):
    plain = order.consecutive_groups(series, ["k"], "t", "kind")
    cut = order.consecutive_groups(series, ["k"], "t", "kind", block_rows=block)
    assert rows(plain, "k", "run", "kind", "n") == rows(cut, "k", "run", "kind", "n")


@pytest.mark.parametrize("block", [7, 64])
def test_sliding_window(series, block):
    plain = order.sliding_window(series, ["k"], "t", "v", 4)
    cut = order.sliding_window(series, ["k"], "t", "v", 4, block_rows=block)
    assert rows(plain, "k", "t", "window") == rows(cut, "k", "t", "window")


def test_enumerate_with_one_repeated_key(spark):
    df = spark.range(1000).select((F.col("id") % 3 == 0).alias("hot"), "id")
    placed = order.enumerate_rows(df, [F.desc("hot"), "id"], start=5).orderBy("position").collect()
    assert [r["position"] for r in placed] == list(range(5, 1005))
    assert [r["id"] for r in placed[:3]] == [0, 3, 6]


def test_quantiles(spark):
    rng = np.random.default_rng(1)
    pdf = pd.DataFrame({"a": rng.integers(-4, 9, 501).astype(float), "b": rng.normal(size=501), "c": np.where(rng.random(501) < 0.9, 7.5, rng.normal(0, 1e9, 501))})
    probs = [0.0, 0.1, 0.25, 0.5, 0.9, 1.0]
    df = spark.createDataFrame(pdf).repartition(4).withColumn("none", F.lit(None).cast("double"))
    got = exact_quantiles(df, ["a", "b", "c", "none"], probs).collect()
    found = {(r["column"], r["prob"]): r["value"] for r in got}
    assert len(found) == 18
    for c in "abc":
        for p in probs:
            assert found[c, p] == pytest.approx(pdf[c].quantile(p), rel=1e-12, abs=1e-12)


def test_quantiles_of_odd_values(spark):
    inf, nan = float("inf"), float("nan")
    for values in ([-0.0, 0.0, 1.0], [nan, 1.0, 2.0, nan], [-inf, inf, 3.0], [5e-324, -5e-324, 1.7e308], [None, 4.0, None]):
        df = spark.createDataFrame([(v,) for v in values], "v double")
        for p in (0.0, 0.5, 1.0):
            want = df.agg(F.percentile("v", p)).first()[0]
            got = exact_quantiles(df, ["v"], [p]).first()["value"]
            assert got == want or (np.isnan(got) and np.isnan(want)), (values, p)
    assert exact_quantiles(spark.createDataFrame([], "v double"), ["v"], [0.5]).count() == 0


def test_components(spark):
    edges = [(1, 2), (2, 3), (9, 10), (7, 3), (20, 20), (11, 9)] + [(i, i + 1) for i in range(100, 140)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert {got[n] for n in (1, 2, 3, 7)} == {1}
    assert {got[n] for n in (9, 10, 11)} == {9}
    assert {got[n] for n in range(100, 141)} == {100}
    assert len(got) == 4 + 3 + 41

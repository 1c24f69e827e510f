import threading

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tallyloom.operators import classify, cluster, features, metrics, recommend, regress


def line(spark, fn):
    return spark.createDataFrame([(float(x), float(fn(x))) for x in range(1, 7)], ["x", "y"])


@pytest.mark.parametrize("fn, want", [(lambda x: x, [0, 1]), (lambda x: x + 2, [2, 1])])
def test_straight_lines(spark, fn, want):
    fit = regress.fit_linear(line(spark, fn), ["x"], "y")
    assert [fit.intercept, *fit.coefficients] == pytest.approx(want, abs=1e-8)


@pytest.mark.parametrize("fn, want", [(lambda x: x**2, [0, 0, 1, 0]), (lambda x: x**3, [0, 0, 0, 1]), (lambda x: x * x + x + 1, [1, 1, 1, 0])])
def test_polynomials(spark, fn, want):
    fit = regress.fit_poly(line(spark, fn), "x", "y", 3)
    assert fit.raw_coefficients() == pytest.approx(want, abs=1e-6)


def test_two_features(spark):
    df = spark.createDataFrame([(a, b, 2 * a + 3 * b + 3) for a, b in [(1.0, 2.0), (2.0, 1.0), (3.0, 5.0), (4.0, 4.0), (5.0, 0.0)]], ["a", "b", "y"])
    fit = regress.fit_linear(df, ["a", "b"], "y")
    assert [fit.intercept, *fit.coefficients] == pytest.approx([3, 2, 3], abs=1e-8)


def test_splits_are_exact_disjoint_and_repeatable(spark):
    df = spark.range(1003).withColumn("label", F.when(F.col("id") < 700, "a").otherwise("b"))
    train, test = features.split_random(df, "id", 0.2, seed=5)
    assert test.count() == 201 and train.count() == 802
    assert train.join(test, "id").isEmpty()
    again = features.split_random(df.repartition(5), "id", 0.2, seed=5)[1]
    assert again.exceptAll(test).isEmpty()
    first, rest = features.split_stratified(df, "id", "label", 0.7, seed=1)
    assert {r["label"]: r["count"] for r in first.groupBy("label").count().collect()} == {"a": 490, "b": 212}
    assert first.count() + rest.count() == 1003 and first.join(rest, "id").isEmpty()
    head, tail = features.split_at(df, "id", 40, legacy_gap=True)
    assert head.count() == 40 and tail.agg(F.min("id")).first()[0] == 41


def test_unseen_label_is_an_error(spark):
    _, codes = features.label_encode(spark.createDataFrame([("b",), ("a",)], ["c"]), ["c"])
    new = spark.createDataFrame([("z",)], ["c"])
    with pytest.raises(Exception, match="unseen value"):
        features.encode_with(new, "c", codes["c"]).collect()


@pytest.fixture(scope="module")
def blobs(spark):
    rng = np.random.default_rng(0)
    centres = np.array([[0, 0, 0, 0], [4, 0, 4, 0], [0, 4, 0, 4]])
    label = rng.integers(0, 3, 240)
    x = centres[label] + rng.normal(0, 0.5, (240, 4))
    pdf = pd.DataFrame(x, columns=list("abcd"))
    pdf["label"] = label
    pdf["id"] = np.arange(240)
    return spark.createDataFrame(pdf).cache()


MAKERS = {
    "perceptron": lambda df: classify.fit_perceptron(df, list("abcd"), "label", epochs=5),
    "linear": lambda df: classify.fit_svm(df, list("abcd"), "label"),
    "rbf": lambda df: classify.fit_svm(df, list("abcd"), "label", kernel="rbf", gamma=0.2, n_features=50),
    "poly": lambda df: classify.fit_svm(df, list("abcd"), "label", kernel="poly", degree=2),
    "mlp": lambda df: classify.fit_mlp(df, list("abcd"), "label", hidden=(8,), max_iter=60),
    "tree": lambda df: classify.fit_tree(df, list("abcd"), "label"),
    "forest": lambda df: classify.fit_forest(df, list("abcd"), "label"),
}


@pytest.mark.parametrize("name", MAKERS)
def test_classifiers_separate_clear_groups(blobs, name):
    train, test = features.split_stratified(blobs, "id", "label", 0.7, seed=1)
    score = metrics.accuracy(MAKERS[name](train).predict(test), "label", "prediction").first()[0]
    assert score > 0.9


def test_model_files(spark, blobs, tmp_path):
    fit = MAKERS["forest"](blobs)
    path = str(tmp_path / "model")
    classify.save_model(fit, path)
    again = classify.load_model(path, fit)
    assert fit.predict(blobs).exceptAll(again.predict(blobs)).isEmpty()
    assert classify.model_size(spark, path).first()["bytes"] > 0
    nodes = classify.tree_nodes(fit, spark)
    assert nodes.select("tree").distinct().count() == 10
    assert classify.importances(fit, blobs).agg(F.sum("importance")).first()[0] == pytest.approx(1.0)


def test_cross_validation(blobs):
    scores = classify.cross_validate(MAKERS["tree"], blobs, "id", "label", 3)
    assert scores.count() == 3 and classify.cv_summary(scores).first()["mean"] > 0.9


def two_columns(spark):
    return spark.createDataFrame([(x, y) for x in (1, 10) for y in range(1, 11)], ["x", "y"])


def test_kmeans_finds_two_columns(spark):
    df = two_columns(spark).withColumn("id", F.monotonically_increasing_id())
    fit = cluster.fit_kmeans(df, ["x", "y"], 2, n_init=3)
    assert [round(c[0], 6) for c in fit.centres] == [1.0, 10.0]
    assert fit.inertia == pytest.approx(165.0)
    assert cluster.inertia(df, ["x", "y"], fit.centres).first()[0] == pytest.approx(165.0)
    table = cluster.quality_table(df, "id", ["x", "y"], [2, 3]).collect()
    assert table[0]["inertia"] > table[1]["inertia"] and 0 < table[0]["silhouette"] < 1


def test_fits_of_an_elbow_run_side_by_side(spark, monkeypatch):
    met = threading.Barrier(2)

    class Meeting(cluster.KMeans):
        def fit(self, data):
            met.wait(60)
            return super().fit(data)

    monkeypatch.setattr(cluster, "KMeans", Meeting)
    found = cluster.elbow(two_columns(spark), ["x", "y"], [2, 3]).collect()
    assert [r["k"] for r in found] == [2, 3] and all(0 < r["inertia"] < 1000 for r in found)


def test_minibatch_comes_close(blobs):
    fit = cluster.fit_minibatch_kmeans(blobs, list("abcd"), 3, batch=100, steps=6, seed=2)
    whole = cluster.fit_kmeans(blobs, list("abcd"), 3, n_init=3)
    assert whole.inertia <= fit.inertia * 1.0001


def test_grouped_kmeans_reaches_a_fixed_point(blobs):
    rows = blobs.select((F.col("id") % 2).alias("g"), *"abcd")
    got = cluster.fit_kmeans_grouped(rows, "g", list("abcd"), [2, 3], n_init=2, max_iter=30).toPandas()
    assert got.groupby(["g", "k"])["n"].sum().tolist() == [120, 120, 120, 120]
    points = rows.toPandas()
    for (g, k), model in got.groupby(["g", "k"]):
        x, centres = points.loc[points["g"] == g, list("abcd")].to_numpy(), model.sort_values("cluster")[list("abcd")].to_numpy()
        gap = ((x[:, None, :] - centres[None]) ** 2).sum(axis=2)
        np.testing.assert_allclose([x[gap.argmin(axis=1) == i].mean(axis=0) for i in range(k)], centres, atol=1e-3)
        assert model["inertia"].iat[0] == pytest.approx(gap.min(axis=1).sum(), rel=1e-3)


def test_points_of_a_group_are_packed_into_blocks(spark):
    rng = np.random.default_rng(6)
    rows = pd.DataFrame({"g": rng.choice(["a", "b"], 900, p=[0.9, 0.1]), "x": rng.integers(0, 40, 900).astype(float), "y": rng.integers(0, 40, 900).astype(float)})
    df = spark.createDataFrame(rows).unionByName(spark.createDataFrame([(None, 1.0, 1.0), ("c", None, 2.0), ("d", 3.0, 4.0)], "g string, x double, y double"))
    points = df.dropna(subset=["x", "y"]).groupBy("g", "x", "y").agg(F.count("*").alias("n"))
    groups = spark.createDataFrame([("a", 0, 700), ("b", 1, 90), ("d", 2, 1)], "g string, _g long, _size long")
    blocks = cluster._point_blocks(points, groups, "g", ["x", "y"], 50).collect()
    assert len(blocks) <= 17 and max(len(b["w"]) for b in blocks) < 100
    found = sorted((b["_g"], *p) for b in blocks for p in zip(b["x"][: len(b["w"])], b["x"][len(b["w"]) :], b["w"]))
    want = points.join(groups, "g").select("_g", "x", "y", "n").collect()
    assert found == sorted(map(tuple, want))
    got = cluster.fit_kmeans_grouped(df, "g", ["x", "y"], [1, 3], n_init=2).toPandas()
    assert got.groupby(["g", "k"])["n"].sum().to_dict() == {(g, k): n for g, n in [*rows["g"].value_counts().items(), ("d", 1)] for k in (1, 3)}
    one = got[got["k"] == 1].set_index("g")
    np.testing.assert_allclose(one.loc[["a", "b"], ["x", "y"]], rows.groupby("g")[["x", "y"]].mean())


def test_a_gap_that_is_no_number_is_the_largest():
    nan, inf = float("nan"), float("inf")
    gaps = np.array([[nan, inf, inf], [nan, 2, 2], [nan, nan, nan], [3, 1, nan]])
    assert cluster._closest(gaps).tolist() == [1, 1, 0, 1]


def test_distances_keep_their_digits_far_from_zero():
    rng = np.random.default_rng(7)
    x = rng.normal(1e6, 1.0, (60, 5))
    y = np.vstack([rng.normal(1e6, 1.0, (70, 5)), x[:9], x[9:12] + 1e-7, np.full((1, 5), np.nan), [[np.inf, 0, 0, 0, 0]]])
    want = np.sqrt(((x[:, None, :] - y[None]) ** 2).sum(axis=2))
    np.testing.assert_allclose(cluster._distances(x, y), want, rtol=1e-9, atol=0)
    assert (cluster._distances(x, x).diagonal() == 0).all()


def test_svm_starts_from_few_parts_of_a_written_table(blobs, monkeypatch):
    seen = []
    whole = classify._fit_ml
    monkeypatch.setattr(classify, "_fit_ml", lambda df, *rest: seen.append(df) or whole(df, *rest))
    classify.fit_svm(blobs.repartition(40), list("abcd"), "label", kernel="rbf", max_iter=2)
    assert seen[0].rdd.getNumPartitions() <= 2 * blobs.sparkSession.sparkContext.defaultParallelism
    train, test = features.split_stratified(blobs, "id", "label", 0.7)
    for part in (train, test, features.kfold_assign(blobs, "id", "label", 3)):
        # The sizes of the labels are read from a table, which is the smaller side of the join.
        plan = part._jdf.queryExecution().optimizedPlan().toString()
        assert "Join" in plan and plan.count("Aggregate") <= 1


def plain_silhouette(x, label):
    gap = np.sqrt(((x[:, None, :] - x[None]) ** 2).sum(axis=2))
    out = []
    for i, own in enumerate(label):
        mine = label == own
        if mine.sum() == 1 or mine.all():
            out.append(0.0)
            continue
        a = gap[i, mine].sum() / (mine.sum() - 1)
        b = min(gap[i, label == o].mean() for o in set(label) if o != own)
        out.append((b - a) / max(a, b))
    return np.array(out)


def test_silhouette_of_all_rows_by_blocks(blobs, spark):
    pdf = blobs.toPandas()
    pdf.loc[0, "label"] = 9  # alone in its cluster
    want = plain_silhouette(pdf[list("abcd")].to_numpy(), pdf["label"].to_numpy())
    df = spark.createDataFrame(pdf).repartition(5)
    for block, wide in ((1024, 8192), (16, 50)):
        got = cluster.silhouette_values(df, "id", list("abcd"), "label", block, wide).toPandas().sort_values("id")
        np.testing.assert_allclose(got["silhouette"], want[np.argsort(pdf["id"])], atol=1e-12)
    assert cluster.silhouette_values(df.withColumn("label", F.lit(1)), "id", list("abcd"), "label").agg(F.max("silhouette")).first()[0] == 0
    assert cluster.silhouette(df.limit(0), "id", list("abcd"), "label").first()[0] is None
    full = cluster.silhouette(blobs, "id", list("abcd"), "label").first()[0]
    part = cluster.silhouette_sample(blobs, "id", list("abcd"), "label", 100).first()
    assert part["rows_used"] == 100 and part["silhouette"] == pytest.approx(full, abs=0.1)


def test_batches_are_even_when_most_rows_are_equal(spark):
    df = spark.range(20_000).select(F.when(F.col("id") < 18_000, 0).otherwise(F.col("id")).alias("x"), F.lit(1).alias("y"))
    for seed in range(3):
        sizes = cluster.draw_batches(df, ["x", "y"], 2000, 4, seed).groupBy("step").agg(F.sum("drawn").alias("n")).collect()
        assert len(sizes) == 4 and all(abs(r["n"] - 2000) < 100 for r in sizes)
    fits = [cluster.fit_minibatch_kmeans(df.repartition(n), ["x", "y"], 3, 500, 4) for n in (1, 6)]
    np.testing.assert_allclose(fits[0].centres, fits[1].centres, rtol=1e-9)


def test_peers_are_others_of_the_same_cluster(spark):
    df = spark.range(100).select(F.col("id").alias("item"), F.when(F.col("id") < 60, 0).when(F.col("id") < 62, 1).otherwise(F.col("id")).alias("c"))
    found = recommend.recommend_peers(df, "item", "c", 3, seed=1).toPandas()
    assert (found["item"] != found["peer"]).all() and not found.duplicated(["item", "peer"]).any()
    counts = found.groupby("item").size()
    assert (counts.loc[:59] == 3).all() and counts.loc[60] == counts.loc[61] == 1 and 70 not in counts.index
    assert ((found["item"] < 60) == (found["peer"] < 60)).all()
    assert recommend.recommend_for(df, "item", "c", 7, 3).count() == 3


def test_favourites(spark):
    rows = [(c, s, int(c == "red")) for c in ("red", "blue", "green") for s in ("big", "small")] * 5
    df = spark.createDataFrame(rows, ["color", "size", "label"])
    fit, coded, codes = recommend.fit_favourite(df, ["color", "size"], "label", model="tree")
    assert metrics.accuracy(fit.predict(coded), "label", "prediction").first()[0] == 1.0
    assert [r["value"] for r in codes["color"].orderBy("code").collect()] == ["blue", "green", "red"]

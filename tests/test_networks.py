import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tallyloom.operators import classify, metrics, networks
from tallyloom.session import scratch_path
from tallyloom.streaming import online

COLS = list("abc")


@pytest.fixture(scope="module")
def noisy(spark):
    """Three groups that overlap, in awkward scales, with repeated rows, nulls and a vector that is no number."""
    rng = np.random.default_rng(11)
    label = rng.integers(0, 3, 300)
    x = np.array([[0, 0, 0], [1.5, 0, 1], [0, 1.5, -1]])[label] + rng.normal(0, 0.6, (300, 3)) * [1, 1e-3, 30]
    pdf = pd.DataFrame(x, columns=COLS).assign(label=label, id=np.arange(300))
    df = spark.createDataFrame(pd.concat([pdf, pdf.head(60)]))
    odd = spark.createDataFrame([(1.0, None, 2.0, 1, 900), (float("nan"), 0.0, 0.0, 2, 901), (1.0, 1.0, 1.0, None, 902)], "a double, b double, c double, label long, id long")
    return df.unionByName(odd)


LAYOUTS = (lambda df: df.repartition(1), lambda df: df.repartition(7), lambda df: df.orderBy(F.desc("a")))


def test_perceptron_does_not_depend_on_the_layout(noisy):
    found = [classify.fit_perceptron(lay(noisy), COLS, "label", epochs=6, eta0=0.1).weights for lay in LAYOUTS]
    assert np.abs(found[0]).sum() > 0
    for other in found[1:]:
        np.testing.assert_allclose(other, found[0], rtol=0, atol=1e-9)


def test_network_does_not_depend_on_the_layout(noisy):
    found = [networks.fit_network(lay(noisy), COLS, "label", (0, 1, 2), 3, (5, 4), epochs=3).weights for lay in LAYOUTS]
    for other in found[1:]:
        np.testing.assert_allclose(other, found[0], rtol=0, atol=1e-9)


def test_perceptron_pass_against_plain_sums(spark):
    rng = np.random.default_rng(5)
    x, y = rng.normal(size=(40, 2)), rng.integers(0, 2, 40)
    rows = spark.createDataFrame([(int(b), a.tolist()) for a, b in zip(x, y)], "label int, v array<double>")
    start = rng.normal(size=(2, 3))
    got, wrong = networks.perceptron_pass([rows, rows.limit(0)], start, (0, 1))
    want, missed = start.copy(), 0
    for a, b in zip(np.c_[x, np.ones(40)], y):
        for k in (0, 1):
            sign = 1 if b == k else -1
            if sign * (start[k] @ a) <= 0:
                want[k] += sign * a / 40
                missed += 1
    np.testing.assert_allclose(got, want, atol=1e-12)
    assert wrong == missed


def test_gradient_against_differences():
    rng = np.random.default_rng(2)
    net = networks.Network((4, 5, 3, 2))
    flat = net.start(1) + rng.normal(0, 0.1, net.size)
    x, target = rng.normal(size=(7, 4)), np.eye(2)[rng.integers(0, 2, 7)]

    def loss(w):
        return -(target * np.log(net.scores(w, x)[-1])).sum()

    steps = [np.where(np.arange(net.size) == i, 1e-6, 0.0) for i in range(net.size)]
    want = [(loss(flat + e) - loss(flat - e)) / 2e-6 for e in steps]
    np.testing.assert_allclose(net.gradient(flat, x, target), want, atol=1e-5)


def test_several_networks_in_one_pass_learn_as_alone(noisy):
    rows = networks.labelled_vectors(noisy, COLS, "label").withColumn("u", F.when(F.col("v")[0] > 0, 0.2).otherwise(0.9))
    nets = [networks.Network((3, 4, 3)), networks.Network((3, 6, 3))]
    parts = networks.minibatches(rows, 3, 1)
    both = networks.network_pass(parts, nets, [networks.fresh(n, 0) for n in nets], (0, 1, 2), shares=(0.5, 1.0))
    for i, (net, share) in enumerate(zip(nets, (0.5, 1.0))):
        mine = [p.where(F.col("u") < share) for p in parts]
        alone = networks.network_pass(mine, [net], [networks.fresh(net, 0)], (0, 1, 2))
        np.testing.assert_allclose(both[i], alone[0], atol=1e-9)


def test_network_learns_what_a_line_cannot_separate(spark):
    rng = np.random.default_rng(8)
    x = rng.uniform(-1, 1, (400, 2))
    df = spark.createDataFrame(pd.DataFrame(x, columns=["a", "b"]).assign(label=(x.prod(axis=1) > 0).astype(int)))
    fit = networks.fit_network(df, ["a", "b"], "label", (0, 1), 2, (16,), epochs=25, batches=6, rate=0.05)
    assert metrics.accuracy(fit.predict(df), "label", "prediction").first()[0] > 0.9
    assert fit.predict(spark.createDataFrame([(None, 1.0)], "a double, b double")).first()["prediction"] is None


def test_online_network_applies_a_batch_once(spark, noisy):
    path = scratch_path(spark, "state")

    def learner():
        return online.OnlineMlp(spark, (0, 1, 2), COLS, "label", 3, path, hidden=(4,), steps=2)

    first = learner()
    first.update(noisy.where("id < 100"), 0)
    once = first.weights()
    learner().update(noisy.where("id < 100"), 0)
    np.testing.assert_array_equal(learner().weights(), once)
    learner().update(noisy.where("id >= 100").repartition(5), 1)
    assert np.abs(learner().weights() - once).max() > 0
    assert learner().state.last_batch() == 1
    assert [tuple(r) for r in learner().state.history().orderBy("batch").collect()] == [(0, 160), (1, 202)]


def test_a_failed_write_leaves_the_version_before(spark):
    state = online.VersionedState(spark, scratch_path(spark, "state"))
    assert state.load() is None and state.last_batch() == -1
    for batch in (0, 1, 4):  # batches may store nothing
        state.store(np.full(3, float(batch)), batch, 10)
    place = state._last()[1]
    spark.createDataFrame([], "at int, value double, rows long, batch long").write.mode("overwrite").parquet(f"{state.path}/place{1 - place}")
    assert state.last_batch() == 4 and state.load().tolist() == [4.0] * 3


def test_online_mlp_study(spark):
    rng = np.random.default_rng(1)
    label = rng.integers(0, 3, 600)
    x = np.eye(3)[label] * 3 + rng.normal(0, 0.5, (600, 3))
    df = spark.createDataFrame(pd.DataFrame(x, columns=COLS).assign(label=label, id=np.arange(600)))
    train, test = df.where("id < 450"), df.where("id >= 450")
    rows = online.online_mlp_study(train, test, "id", COLS, "label", (0, 1, 2), 3, ((8,), (6, 5)), (0.5, 1.0), batches=2, steps=6).collect()
    assert [(r["fraction"], r["hidden"]) for r in rows] == [(0.5, "8"), (0.5, "6, 5"), (1.0, "8"), (1.0, "6, 5")]
    assert rows[2]["rows"] == 450 and 180 < rows[0]["rows"] < 270
    for r in rows:
        assert r["batch_accuracy"] > 0.95 and r["online_accuracy"] > 0.5 and r["online_seconds"] > 0

"""Learners that take one micro-batch at a time and keep their state as a table with one version per batch."""

from __future__ import annotations

import time
from collections.abc import Sequence

import numpy as np
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from tallyloom.operators.classify import Features, LinearClassifier, fit_mlp
from tallyloom.operators.cluster import CentreFit, minibatch_step
from tallyloom.operators.metrics import accuracy
from tallyloom.operators.networks import (
    Network,
    NetworkClassifier,
    fresh,
    labelled_vectors,
    minibatches,
    network_pass,
    perceptron_pass,
)
from tallyloom.session import cut_lineage
from tallyloom.sources.generate import unit_hash


_STORED = "at int, value double, rows long, batch long"


class VersionedState:
    """A small matrix stored as ``at, value`` with the number of the batch that made it; a batch is applied once.

    There are two places, written in turn: a write that fails leaves the version before as it was, and what is read does not
    grow with the number of batches. ``<path>/log`` keeps the rows of each batch and is read by ``history`` only.
    """

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark = spark
        self.path = path

    def _read(self, place: str, schema: str) -> list[Row]:
        try:
            return self.spark.read.schema(schema).parquet(f"{self.path}/{place}").collect()
        except AnalysisException as err:
            if err.getCondition() != "PATH_NOT_FOUND":
                raise
            return []

    def _last(self) -> tuple[int, int, list[Row]]:
        """The last batch applied (-1 for none), its place, and its rows."""
        found = [(rows[0]["batch"], n, rows) for n in (0, 1) if (rows := self._read(f"place{n}", _STORED))]
        return max(found, key=lambda x: x[0], default=(-1, 1, []))

    def last_batch(self) -> int:
        return self._last()[0]

    def load(self) -> np.ndarray | None:
        rows = self._last()[2]
        return np.array([r["value"] for r in sorted(rows, key=lambda r: r["at"])]) if rows else None

    def store(self, values: np.ndarray, batch_id: int, rows: int) -> None:
        table = [(i, float(v), rows, batch_id) for i, v in enumerate(values.ravel())]
        place = 1 - self._last()[1]
        self.spark.createDataFrame(table[:1], _STORED).select("rows").write.mode("overwrite").parquet(f"{self.path}/log/batch={batch_id}")
        self.spark.createDataFrame(table, _STORED).coalesce(1).write.mode("overwrite").parquet(f"{self.path}/place{place}")

    def history(self) -> DataFrame:
        """``batch, rows``: rows seen per batch."""
        return self.spark.read.schema("rows long, batch long").parquet(f"{self.path}/log").select("batch", "rows")


class OnlinePerceptron:
    """Perceptron with a fixed list of classes, updated batch by batch."""

    def __init__(
        self,
        spark: SparkSession,
        classes: Sequence[int],
        features: Features,
        label: str,
        width: int,
        path: str,
        eta0: float = 1.0,
        steps: int = 4,
    ) -> None:
        self.classes = tuple(classes)
        self.features = features
        self.label = label
        self.width = width
        self.eta0 = eta0
        self.steps = steps
        self.state = VersionedState(spark, path)

    def weights(self) -> np.ndarray:
        stored = self.state.load()
        shape = (len(self.classes), self.width + 1)
        return np.zeros(shape) if stored is None else stored.reshape(shape)

    def update(self, batch: DataFrame, batch_id: int) -> None:
        """One pass over the batch; a batch already applied is skipped."""
        if batch_id <= self.state.last_batch():
            return
        rows = cut_lineage(labelled_vectors(batch, self.features, self.label))
        weights, _ = perceptron_pass(minibatches(rows, self.steps, batch_id), self.weights() / self.eta0, self.classes)
        self.state.store(self.eta0 * weights, batch_id, rows.count())

    def classifier(self) -> LinearClassifier:
        return LinearClassifier(self.features, self.classes, self.weights())


class OnlineMlp:
    """Multi-layer perceptron updated batch by batch: ``steps`` mini-batches of each, one step of Adam for each of them."""

    def __init__(
        self,
        spark: SparkSession,
        classes: Sequence[int],
        features: Features,
        label: str,
        width: int,
        path: str,
        hidden: Sequence[int] = (50,),
        steps: int = 4,
        rate: float = 0.01,
        seed: int = 0,
    ) -> None:
        self.classes = tuple(classes)
        self.features = features
        self.label = label
        self.steps = steps
        self.rate = rate
        self.seed = seed
        self.network = Network((width, *hidden, len(self.classes)))
        self.state = VersionedState(spark, path)

    def _load(self) -> np.ndarray:
        stored = self.state.load()
        return fresh(self.network, self.seed) if stored is None else stored

    def update(self, batch: DataFrame, batch_id: int) -> None:
        """One pass over the batch; a batch already applied is skipped."""
        if batch_id <= self.state.last_batch():
            return
        rows = cut_lineage(labelled_vectors(batch, self.features, self.label))
        parts = minibatches(rows, self.steps, batch_id)
        state = network_pass(parts, [self.network], [self._load()], self.classes, self.rate)[0]
        self.state.store(state, batch_id, rows.count())

    def weights(self) -> np.ndarray:
        return self._load()[: self.network.size]

    def classifier(self) -> NetworkClassifier:
        return NetworkClassifier(self.features, self.classes, self.network, self.weights())


class OnlineKMeans:
    """k-means that moves its centres towards each batch; each centre is the mean of all rows it was given."""

    def __init__(self, spark: SparkSession, cols: Sequence[str], k: int, path: str, seed: int = 0) -> None:
        self.cols = tuple(cols)
        self.k = k
        self.seed = seed
        self.state = VersionedState(spark, path)

    def _load(self) -> tuple[np.ndarray, np.ndarray] | None:
        stored = self.state.load()
        if stored is None:
            return None
        table = stored.reshape(-1, len(self.cols) + 1)
        return table[:, :-1], table[:, -1]

    def update(self, batch: DataFrame, batch_id: int) -> None:
        """Move the centres; batches also supply starting points until there are k different ones."""
        if batch_id <= self.state.last_batch():
            return
        rows = batch.select(*[F.col(c).cast("double").alias(c) for c in self.cols]).dropna().persist()
        centres, counts = self._load() or (np.zeros((0, len(self.cols))), np.zeros(0))
        if len(centres) < self.k:
            draw = unit_hash(*[F.col(c) for c in self.cols], seed=self.seed)
            start = [tuple(r) for r in rows.distinct().orderBy(draw, *self.cols).limit(self.k).collect()]
            there = {tuple(v) for v in centres.tolist()}
            more = [v for v in start if v not in there][: self.k - len(centres)]
            centres = np.concatenate([centres, np.array(more, dtype=float).reshape(-1, len(self.cols))])
            counts = np.concatenate([counts, np.zeros(len(more))])
        if len(centres):
            centres, counts = minibatch_step(centres, counts, rows, self.cols)
            self.state.store(np.column_stack([centres, counts]), batch_id, rows.count())
        rows.unpersist()

    def fit(self) -> CentreFit:
        """The centres so far (inertia is not known to a stream)."""
        centres, _ = self._load()
        return CentreFit(self.cols, tuple(tuple(float(v) for v in c) for c in centres), float("nan"))

    def counts(self) -> np.ndarray:
        return self._load()[1]


def online_study(
    train: DataFrame,
    test: DataFrame,
    id_col: str,
    features: Features,
    label: str,
    classes: Sequence[int],
    width: int,
    path: str,
    fractions: Sequence[float] = (0.25, 0.5, 0.75),
    batches: int = 4,
) -> DataFrame:
    """``fraction, rows, accuracy``: an online perceptron given growing shares of the training rows."""
    spark = train.sparkSession
    rows = []
    for fraction in fractions:
        part = train.where(unit_hash(F.col(id_col), seed=1) < fraction)
        learner = OnlinePerceptron(spark, classes, features, label, width, f"{path}/{fraction}")
        for i in range(batches):
            slot = F.floor(unit_hash(F.col(id_col), seed=2) * batches)
            learner.update(part.where(slot == i), i)
        score = accuracy(learner.classifier().predict(test, "_p"), label, "_p").first()["accuracy"]
        rows.append((float(fraction), part.count(), float(score)))
    return spark.createDataFrame(rows, "fraction double, rows long, accuracy double")


def online_mlp_study(
    train: DataFrame,
    test: DataFrame,
    id_col: str,
    features: Features,
    label: str,
    classes: Sequence[int],
    width: int,
    hidden: Sequence[Sequence[int]] = ((50,),),
    fractions: Sequence[float] = (0.25, 0.5, 0.75, 1.0),
    batches: int = 4,
    steps: int = 6,
    batch_iterations: int = 40,
    rate: float = 0.02,
    seed: int = 0,
) -> DataFrame:
    """``fraction, hidden, rows, online_accuracy, batch_accuracy, online_seconds, batch_seconds`` for growing shares of the
    training rows and each choice of hidden layers.

    Online: every row is seen once, in ``batches`` micro-batches of ``steps`` mini-batches; all networks share the passes, so
    the seconds are a share of them by the number of weights. Batch: fitted on all rows of the share, pass after pass. A row
    belongs to a share by a hash of its id.
    """
    spark, classes = train.sparkSession, tuple(classes)
    settings = [(float(f), tuple(h)) for f in fractions for h in hidden]
    networks = [Network((width, *h, len(classes))) for _, h in settings]
    states = [fresh(n, seed) for n in networks]
    marked = train.withColumns({"_u": unit_hash(F.col(id_col), seed=1), "_slot": F.floor(unit_hash(F.col(id_col), seed=2) * batches)})
    begun = time.perf_counter()
    for i in range(batches):
        rows = labelled_vectors(marked.where(F.col("_slot") == i), features, label, "_u").withColumnRenamed("_u", "u")
        states = network_pass(minibatches(rows, steps, i), networks, states, classes, rate, [f for f, _ in settings])
    online = (time.perf_counter() - begun) / sum(n.size for n in networks)
    out = []
    for (fraction, sizes), network, state in zip(settings, networks, states):
        part = marked.where(F.col("_u") < fraction)
        begun = time.perf_counter()
        fitted = fit_mlp(part, features, label, sizes, batch_iterations, seed)
        seconds = time.perf_counter() - begun
        mine = NetworkClassifier(features, classes, network, state[: network.size])
        scores = [float(accuracy(m.predict(test, "_p"), label, "_p").first()["accuracy"]) for m in (mine, fitted)]
        out.append((fraction, ", ".join(map(str, sizes)), part.count(), *scores, online * network.size, seconds))
    schema = "fraction double, hidden string, rows long, online_accuracy double, batch_accuracy double, online_seconds double, batch_seconds double"
    return spark.createDataFrame(out, schema)

"""Learners whose every step is a sum over rows: mini-batches are drawn by a hash of the row, tasks add up gradients as matrix
products, and the sums meet on the driver as one number per weight. The result does not depend on how rows are laid out."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from itertools import pairwise

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.operators.cluster import as_array
from tallyloom.session import scratch_path

Features = str | Sequence[str]
# Rows that a task turns into one matrix.
STRIP = 4096


def labelled_vectors(df: DataFrame, features: Features, label: str, *more: str) -> DataFrame:
    """``label, v`` and the columns ``more``, without rows that lack a label or a vector."""
    rows = df.select(F.col(label).cast("int").alias("label"), as_array(features).alias("v"), *more)
    return rows.where(F.col("label").isNotNull() & F.col("v").isNotNull())


def minibatches(rows: DataFrame, n: int, seed: int) -> list[DataFrame]:
    """``rows`` (with ``label, v``) in ``n`` parts by a hash of the row, written once so that each pass reads its own part.

    Equal rows are in one part, which may make it larger but never puts it into one task.
    """
    spark, path = rows.sparkSession, scratch_path(rows.sparkSession, "minibatches")
    slot = F.pmod(F.xxhash64("label", "v", F.lit(seed)), F.lit(n)).cast("int")
    rows.withColumn("slot", slot).write.partitionBy("slot").parquet(path)
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    stored = spark.read.schema(f"{kinds}, slot int").parquet(path)
    return [stored.where(F.col("slot") == i).drop("slot") for i in range(n)]


def sum_over(rows: DataFrame, size: int, step: Callable[[np.ndarray, pd.DataFrame], np.ndarray]) -> tuple[np.ndarray, int]:
    """The sum of ``step(x, frame)``, ``size`` numbers, over all rows with ``v`` of finite numbers, and how many these are.

    ``x`` holds the vectors of some rows, ``frame`` their other columns. A task sends one number per place.
    """

    def add(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total, seen = np.zeros(size), 0
        for frame in frames:
            for lo in range(0, len(frame), STRIP):
                part = frame.iloc[lo : lo + STRIP]
                x = np.array([np.asarray(v, float) for v in part["v"]])
                fine = np.isfinite(x).all(axis=1)
                if fine.any():
                    total += step(x[fine], part[fine])
                    seen += int(fine.sum())
        if seen:
            yield pd.DataFrame({"at": np.arange(-1, size), "value": np.r_[float(seen), total]})

    parts = rows.mapInPandas(add, "at int, value double")
    out = np.zeros(size + 1)
    for r in parts.groupBy("at").agg(F.sum("value").alias("value")).collect():
        out[r["at"] + 1] = r["value"]
    return out[1:], int(out[0])


def perceptron_pass(parts: Sequence[DataFrame], weights: np.ndarray, classes: Sequence[int]) -> tuple[np.ndarray, int]:
    """One epoch over mini-batches of ``label, v``: each adds the mean of its mistakes, one class against the rest.

    Returns the new weights and the number of mistakes.
    """
    order = np.array(classes)
    mistakes = 0
    for rows in parts:
        w = weights

        def step(x: np.ndarray, frame: pd.DataFrame) -> np.ndarray:
            x = np.hstack([x, np.ones((len(x), 1))])
            target = np.where(frame["label"].to_numpy()[:, None] == order, 1.0, -1.0)
            wrong = target * (x @ w.T) <= 0
            return np.r_[((target * wrong).T @ x).ravel(), wrong.sum()]

        total, seen = sum_over(rows, weights.size + 1, step)
        if seen:
            weights = weights + total[:-1].reshape(weights.shape) / seen
            mistakes += int(total[-1])
    return weights, mistakes


@dataclass(frozen=True)
class Network:
    """A multi-layer perceptron: rectified hidden layers, softmax over the classes, cross-entropy."""

    layers: tuple[int, ...]

    @property
    def size(self) -> int:
        return sum((a + 1) * b for a, b in pairwise(self.layers))

    def start(self, seed: int) -> np.ndarray:
        """First weights, uniform with a bound that keeps the variance over a layer; biases are zero."""
        rng = np.random.default_rng(seed)
        parts = []
        for a, b in pairwise(self.layers):
            bound = np.sqrt(6.0 / (a + b))
            parts.append(np.vstack([rng.uniform(-bound, bound, (a, b)), np.zeros((1, b))]).ravel())
        return np.concatenate(parts)

    def matrices(self, flat: np.ndarray) -> list[np.ndarray]:
        """One matrix a layer, its last row the biases."""
        out, at = [], 0
        for a, b in pairwise(self.layers):
            out.append(flat[at : at + (a + 1) * b].reshape(a + 1, b))
            at += (a + 1) * b
        return out

    def scores(self, flat: np.ndarray, x: np.ndarray) -> list[np.ndarray]:
        """What each layer gives, the input first and the probabilities last."""
        held = [x]
        matrices = self.matrices(flat)
        for n, w in enumerate(matrices):
            z = held[-1] @ w[:-1] + w[-1]
            if n + 1 < len(matrices):
                held.append(np.maximum(z, 0.0))
            else:
                z = np.exp(z - z.max(axis=1, keepdims=True))
                held.append(z / z.sum(axis=1, keepdims=True))
        return held

    def gradient(self, flat: np.ndarray, x: np.ndarray, target: np.ndarray) -> np.ndarray:
        """Back-propagated, summed over the rows; ``target`` has a one for the class of each row."""
        held, parts = self.scores(flat, x), []
        delta = held[-1] - target
        for w, given in zip(reversed(self.matrices(flat)), reversed(held[:-1])):
            parts.append(np.vstack([given.T @ delta, delta.sum(axis=0)]).ravel())
            delta = (delta @ w[:-1].T) * (given > 0)
        return np.concatenate(parts[::-1])


def adam(state: np.ndarray, gradient: np.ndarray, rate: float = 0.01, decay: tuple[float, float] = (0.9, 0.999)) -> np.ndarray:
    """One step of Adam (Kingma and Ba, 2015) on ``state``: weights, two moments and the number of steps."""
    n = len(gradient)
    w, m, v, t = state[:n], state[n : 2 * n], state[2 * n : 3 * n], state[3 * n] + 1
    m, v = decay[0] * m + (1 - decay[0]) * gradient, decay[1] * v + (1 - decay[1]) * gradient**2
    moved = w - rate * (m / (1 - decay[0] ** t)) / (np.sqrt(v / (1 - decay[1] ** t)) + 1e-8)
    return np.r_[moved, m, v, t]


def fresh(network: Network, seed: int) -> np.ndarray:
    return np.r_[network.start(seed), np.zeros(2 * network.size + 1)]


def network_pass(
    parts: Sequence[DataFrame],
    networks: Sequence[Network],
    states: Sequence[np.ndarray],
    classes: Sequence[int],
    rate: float = 0.01,
    shares: Sequence[float] | None = None,
) -> list[np.ndarray]:
    """One step of each network for each mini-batch of ``label, v``; all networks share a pass over the rows.

    With ``shares``, network i learns from the rows whose column ``u`` (uniform in [0, 1)) is below ``shares[i]``.
    Rows of other classes take no part.
    """
    order, sizes = np.array(classes), [n.size for n in networks]
    cuts = np.cumsum([0, *(s + 1 for s in sizes)])
    states = list(states)
    for rows in parts:
        weights = [s[:n] for s, n in zip(states, sizes)]

        def step(x: np.ndarray, frame: pd.DataFrame) -> np.ndarray:
            target = (frame["label"].to_numpy()[:, None] == order).astype(float)
            known = target.any(axis=1)
            out = []
            for i, network in enumerate(networks):
                use = known & (frame["u"].to_numpy() < shares[i]) if shares else known
                out.append(network.gradient(weights[i], x[use], target[use]) if use.any() else np.zeros(sizes[i]))
                out.append([use.sum()])
            return np.concatenate(out)

        total, _ = sum_over(rows, int(cuts[-1]), step)
        for i, lo in enumerate(cuts[:-1]):
            seen = total[lo + sizes[i]]
            if seen:
                states[i] = adam(states[i], total[lo : lo + sizes[i]] / seen, rate)
    return states


@dataclass(frozen=True)
class NetworkClassifier:
    """The class with the highest probability (ties: first class); null for a row without a vector of finite numbers."""

    features: Features
    classes: tuple[int, ...]
    network: Network
    weights: np.ndarray

    def predict(self, df: DataFrame, name: str = "prediction") -> DataFrame:
        network, weights, classes = self.network, self.weights, np.array(self.classes)

        @F.pandas_udf("int")
        def best(vectors: pd.Series) -> pd.Series:
            out = pd.Series([None] * len(vectors), dtype="Int32")
            width = network.layers[0]
            for lo in range(0, len(vectors), STRIP):
                part = vectors.iloc[lo : lo + STRIP]
                x = np.array([np.full(width, np.nan) if v is None else np.asarray(v, float) for v in part])
                fine = np.isfinite(x).all(axis=1)
                found = classes[network.scores(weights, x[fine])[-1].argmax(axis=1)]
                out.iloc[lo + np.flatnonzero(fine)] = found
            return out

        return df.withColumn(name, best(as_array(self.features)))


def fit_network(
    df: DataFrame,
    features: Features,
    label: str,
    classes: Sequence[int],
    width: int,
    hidden: Sequence[int] = (50,),
    epochs: int = 5,
    batches: int = 8,
    rate: float = 0.01,
    seed: int = 0,
) -> NetworkClassifier:
    """A multi-layer perceptron fitted in ``epochs`` passes over ``batches`` mini-batches."""
    network = Network((width, *hidden, len(classes)))
    parts = minibatches(labelled_vectors(df, features, label), batches, seed)
    states = [fresh(network, seed)]
    for _ in range(epochs):
        states = network_pass(parts, [network], states, classes, rate)
    return NetworkClassifier(features, tuple(classes), network, states[0][: network.size])

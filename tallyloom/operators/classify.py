"""Classifiers behind one small interface: fit on a table, predict on a table."""

from __future__ import annotations

import time
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from typing import Any

import numpy as np
import pandas as pd
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import (
    DecisionTreeClassifier,
    LinearSVC,
    MultilayerPerceptronClassifier,
    OneVsRest,
    RandomForestClassifier,
)
from pyspark.ml.feature import PolynomialExpansion
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.operators.cluster import as_array, nearest
from tallyloom.operators.features import kfold_assign
from tallyloom.operators.networks import labelled_vectors, minibatches, perceptron_pass
from tallyloom.session import cut_lineage, scratch_path

Features = str | Sequence[str]


@dataclass(frozen=True)
class MlFit:
    """A fitted Spark ML pipeline over ``features``."""

    features: Features
    model: PipelineModel
    prepare: Callable[[Column], Column] = lambda v: v

    def predict(self, df: DataFrame, name: str = "prediction") -> DataFrame:
        rows = df.withColumn("features", array_to_vector(self.prepare(as_array(self.features))))
        made = self.model.transform(rows)
        return made.select(*df.columns, F.col("prediction").cast("int").alias(name))

    @property
    def last(self) -> Any:
        return self.model.stages[-1]


def _fit_ml(
    df: DataFrame, features: Features, label: str, stages: Sequence[Any], prepare: Callable[[Column], Column] = lambda v: v
) -> MlFit:
    rows = df.select(
        array_to_vector(prepare(as_array(features))).alias("features"), F.col(label).cast("double").alias("label")
    )
    return MlFit(features, Pipeline(stages=list(stages)).fit(rows), prepare)


def _width(df: DataFrame, features: Features) -> int:
    if not isinstance(features, str):
        return len(features)
    return df.select(F.size(features)).first()[0]


def _classes(df: DataFrame, label: str) -> list[int]:
    """The different labels, a list as long as a classifier has classes."""
    return sorted(r[0] for r in df.select(F.col(label).cast("int").alias("c")).where("c IS NOT NULL").distinct().collect())


@dataclass(frozen=True)
class LinearClassifier:
    """One weight vector and bias per class; the highest score wins (ties: first class)."""

    features: Features
    classes: tuple[int, ...]
    weights: np.ndarray

    def predict(self, df: DataFrame, name: str = "prediction") -> DataFrame:
        weights, classes = self.weights, np.array(self.classes)

        @F.pandas_udf("int")
        def best(vectors: pd.Series) -> pd.Series:
            if not len(vectors):
                return pd.Series([], dtype="int32")
            x = np.stack(vectors.to_numpy())
            return pd.Series(classes[(x @ weights[:, :-1].T + weights[:, -1]).argmax(axis=1)])

        return df.withColumn(name, best(as_array(self.features)))


def fit_perceptron(
    df: DataFrame, features: Features, label: str, epochs: int = 10, batches: int = 8, eta0: float = 1.0, seed: int = 0
) -> LinearClassifier:
    """Perceptron, one against the rest, on mini-batches drawn by a hash of the row.

    ``eta0`` only scales the weights, as they start from zero. The weights do not depend on the layout of the rows.
    """
    classes = _classes(df, label)
    weights = np.zeros((len(classes), _width(df, features) + 1))
    parts = minibatches(labelled_vectors(df, features, label), batches, seed)
    for _ in range(epochs):
        weights, wrong = perceptron_pass(parts, weights, classes)
        if wrong == 0:
            break
    return LinearClassifier(features, tuple(classes), eta0 * weights)


def random_fourier(width: int, n_features: int, gamma: float, seed: int) -> Callable[[Column], Column]:
    """A map whose inner products approximate ``exp(-gamma |x - y|²)`` (Rahimi and Recht, 2007)."""
    rng = np.random.default_rng(seed)
    w = rng.normal(0.0, np.sqrt(2 * gamma), (width, n_features))
    b = rng.uniform(0.0, 2 * np.pi, n_features)

    def lift(vector: Column) -> Column:
        @F.pandas_udf("array<double>")
        def run(vectors: pd.Series) -> pd.Series:
            if not len(vectors):
                return pd.Series([], dtype=object)
            return pd.Series(list(np.sqrt(2.0 / n_features) * np.cos(np.stack(vectors.to_numpy()) @ w + b)))

        return run(vector)

    return lift


def fit_svm(
    df: DataFrame,
    features: Features,
    label: str,
    kernel: str = "linear",
    C: float = 1.0,
    gamma: float = 0.1,
    degree: int = 3,
    n_features: int = 200,
    max_iter: int = 20,
    seed: int = 0,
) -> MlFit:
    """Support vector machine with a linear, ``rbf`` (random features) or ``poly`` (expanded) kernel.

    More than two classes are handled one against the rest. The fits pass over the rows some hundred times, and each task
    reports to the driver: so they start from a written table, not from the steps before, in a number of parts that
    depends on the cluster and not on the rows.
    """
    names = [features] if isinstance(features, str) else list(features)
    df = cut_lineage(df.select(*dict.fromkeys([*names, label])))
    df = df.repartition(2 * df.sparkSession.sparkContext.defaultParallelism)
    rows = df.count()
    svm = LinearSVC(maxIter=max_iter, regParam=1.0 / (C * max(rows, 1)))
    stages: list[Any] = []
    prepare: Callable[[Column], Column] = lambda v: v
    if kernel == "rbf":
        prepare = random_fourier(_width(df, features), n_features, gamma, seed)
    elif kernel == "poly":
        stages.append(PolynomialExpansion(degree=degree, inputCol="features", outputCol="expanded"))
        svm.setFeaturesCol("expanded")
    elif kernel != "linear":
        raise ValueError(f"unknown kernel {kernel!r}")
    if _classes(df, label) not in ([0, 1], [0], [1]):
        svm = OneVsRest(classifier=svm, parallelism=8, featuresCol=svm.getFeaturesCol())
    return _fit_ml(df, features, label, [*stages, svm], prepare)


def fit_mlp(
    df: DataFrame, features: Features, label: str, hidden: Sequence[int] = (100,), max_iter: int = 100, seed: int = 0
) -> MlFit:
    """Multi-layer perceptron; labels must be numbered from 0."""
    layers = [_width(df, features), *hidden, max(_classes(df, label)) + 1]
    return _fit_ml(df, features, label, [MultilayerPerceptronClassifier(layers=layers, maxIter=max_iter, seed=seed)])


def fit_tree(df: DataFrame, features: Features, label: str, max_depth: int = 5, seed: int = 0) -> MlFit:
    """Decision tree on Gini impurity."""
    return _fit_ml(df, features, label, [DecisionTreeClassifier(impurity="gini", maxDepth=max_depth, seed=seed)])


def fit_forest(df: DataFrame, features: Features, label: str, trees: int = 10, max_depth: int = 2, seed: int = 0) -> MlFit:
    """Random forest."""
    return _fit_ml(df, features, label, [RandomForestClassifier(numTrees=trees, maxDepth=max_depth, seed=seed)])


def importances(fit: MlFit, df: DataFrame) -> DataFrame:
    """``feature, importance`` of a tree or forest."""
    names = fit.features if not isinstance(fit.features, str) else None
    values = fit.last.featureImportances.toArray()
    rows = [(names[i] if names else f"f{i}", float(v)) for i, v in enumerate(values)]
    return df.sparkSession.createDataFrame(rows, "feature string, importance double")


def tree_nodes(fit: MlFit, spark: SparkSession) -> DataFrame:
    """The nodes of a tree or forest: ``tree, id, prediction, impurity, gain, left, right, feature, threshold``.

    Read from the model's own file format; leaves have no children and feature -1.
    """
    path = scratch_path(spark, "model")
    fit.last.save(path)
    data = spark.read.parquet(path + "/data")
    node = data.select(F.col("treeID").alias("tree"), "nodeData.*") if "nodeData" in data.columns else data.withColumn("tree", F.lit(0))
    return node.select(
        "tree",
        "id",
        "prediction",
        "impurity",
        "gain",
        F.col("leftChild").alias("left"),
        F.col("rightChild").alias("right"),
        F.col("split.featureIndex").alias("feature"),
        F.get(F.col("split.leftCategoriesOrThreshold"), F.lit(0)).alias("threshold"),
    )


def nearest_centre(df: DataFrame, cols: Sequence[str], centres: Sequence[Sequence[float]], name: str = "prediction") -> DataFrame:
    """Give each row the index of its nearest centre."""
    return df.withColumn(name, nearest(cols, centres)["i"])


def save_model(fit: MlFit, path: str) -> None:
    fit.model.write().overwrite().save(path)


def load_model(path: str, like: MlFit) -> MlFit:
    """Read a saved pipeline; the feature columns are those of ``like``."""
    return MlFit(like.features, PipelineModel.load(path), like.prepare)


def model_size(spark: SparkSession, path: str) -> DataFrame:
    """``files, bytes`` of a saved model."""
    stored = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("length")
    return stored.agg(F.count("*").alias("files"), F.sum("length").alias("bytes"))


def _hit_rate(fit: Any, df: DataFrame, label: str) -> float:
    hits = fit.predict(df, "_p").agg(F.avg((F.col("_p") == F.col(label)).cast("double"))).first()[0]
    return float(hits if hits is not None else 0.0)


def cross_validate(
    make: Callable[[DataFrame], Any], df: DataFrame, id_col: str, label: str, k: int = 5, seed: int = 0
) -> DataFrame:
    """``fold, accuracy`` per stratified fold; ``make(train)`` fits a classifier."""
    folded = kfold_assign(df, id_col, label, k, seed, "_fold")
    rows = []
    for fold in range(k):
        fit = make(folded.where(F.col("_fold") != fold))
        rows.append((fold, _hit_rate(fit, folded.where(F.col("_fold") == fold), label)))
    return df.sparkSession.createDataFrame(rows, "fold int, accuracy double")


def cv_summary(scores: DataFrame) -> DataFrame:
    """Mean and population deviation of the fold accuracies."""
    return scores.agg(F.avg("accuracy").alias("mean"), F.stddev_pop("accuracy").alias("std"))


def grid_table(
    make: Callable[..., Any], params: Sequence[Mapping[str, Any]], train: DataFrame, test: DataFrame, label: str
) -> DataFrame:
    """``params, train_accuracy, test_accuracy, seconds``: one fit per setting."""
    rows = []
    for p in params:
        begun = time.perf_counter()
        fit = make(train, **p)
        seconds = time.perf_counter() - begun
        text = ", ".join(f"{k}={v}" for k, v in p.items())
        rows.append((text, _hit_rate(fit, train, label), _hit_rate(fit, test, label), seconds))
    return train.sparkSession.createDataFrame(rows, "params string, train_accuracy double, test_accuracy double, seconds double")

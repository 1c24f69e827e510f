"""Quality by random Fourier features of document statistics.

Cosines of random projections approximate a Gaussian kernel over standardised statistics of a text. The normal equations of a
ridge regression on them are summed over partitions; an isotonic step turns its scores into probabilities.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.toxicity import held_out
from tallyloom.session import cut_lineage

FEATURES = 256
RIDGE = 1e-2
# Scores are counted in steps of this size before the isotonic fit.
STEP = 1e-3
_CLASSES = np.zeros(256, "u1")
for _n, _chars in enumerate((b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b" ", b"\n", b".,;:?'\"-()", b"!", b"|", b"#$%&*@<>{}[]=+_~^/\\"), 1):
    _CLASSES[list(_chars)] = _n
_CLASSES[128:] = 10


def statistics(text: str | None) -> list[float]:
    """Numbers that describe a text; a null text counts as empty."""
    raw = (text or "").encode("utf-8", "replace")
    data = np.frombuffer(raw, "u1")
    n = max(1, len(data))
    kinds = np.bincount(_CLASSES[data], minlength=11) / n
    bytes_used = np.bincount(data, minlength=256) / n
    some = bytes_used[bytes_used > 0]
    words = raw.split()
    counts = Counter(words)
    m = max(1, len(words))
    pairs = len(set(zip(words, words[1:]))) / max(1, len(words) - 1)
    lengths = np.fromiter(map(len, words), "f8", len(words)) if words else np.zeros(1)
    lines = raw.split(b"\n")
    sentences = sum(raw.count(c) for c in (b". ", b".\n", b"? ", b"! "))
    return [
        *kinds.tolist(),
        float(np.log1p(len(data))),
        float(np.log1p(len(words))),
        float(-(some * np.log2(some)).sum()),
        len(counts) / m,
        len(counts) / m**0.8,
        pairs,
        max(counts.values(), default=0) / m,
        float(lengths.mean()),
        float(lengths.std()),
        len(set(lines)) / len(lines),
        float(np.log1p(len(data) / len(lines))),
        sentences / m,
        min(1.0, len(zlib.compress(raw, 1)) / n),
    ]


N_STATISTICS = len(statistics("x"))


@dataclass
class Model:
    centre: np.ndarray
    width: np.ndarray
    turn: np.ndarray
    phase: np.ndarray
    weights: np.ndarray
    at: np.ndarray
    value: np.ndarray

    def features(self, stats: np.ndarray) -> np.ndarray:
        x = np.clip((stats - self.centre) / self.width, -6, 6)
        return np.hstack([np.sqrt(2 / len(self.phase)) * np.cos(x @ self.turn + self.phase), np.ones((len(x), 1))])

    def raw(self, stats: np.ndarray) -> np.ndarray:
        return self.features(stats) @ self.weights

    def score(self, stats: np.ndarray) -> np.ndarray:
        return np.interp(self.raw(stats), self.at, self.value)


def isotonic(at: np.ndarray, value: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Weighted least squares over non-decreasing values, by pooling neighbours that are out of order."""
    blocks: list[list[float]] = []
    for x, y, w in zip(at, value, weight):
        blocks.append([x, x, y, w])
        while len(blocks) > 1 and blocks[-2][2] >= blocks[-1][2]:
            b, a = blocks.pop(), blocks.pop()
            blocks.append([a[0], b[1], (a[2] * a[3] + b[2] * b[3]) / (a[3] + b[3]), a[3] + b[3]])
    xs = np.array([x for b in blocks for x in b[:2]])
    return xs, np.array([b[2] for b in blocks for _ in range(2)])


def document_statistics(docs: DataFrame) -> DataFrame:
    """``doc_id, stats`` of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            stats = pa.array([statistics(t) for t in b.column(1).to_pylist()], pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([b.column(0), stats], ["doc_id", "stats"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, stats array<double>")


def _matrix(frame: pd.DataFrame) -> np.ndarray:
    return np.array(frame["stats"].tolist(), "f8").reshape(-1, N_STATISTICS)


def fit(stats: DataFrame, labels: DataFrame, seed: int = 3) -> Model:
    """Fit to all labelled rows of ``stats`` (``doc_id, stats``, a written table) that are not held out.

    ``labels`` has ``doc_id, quality``; null ids and labels other than 0 and 1 are left out; of several labels of an id the
    smallest counts. A quarter of the ids is kept from the regression for the isotonic step. Nothing but sums of
    (features + 1)^2 numbers and counts per score step comes to the driver. Without labels every score is 0.5.
    """
    usable = labels.where(F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1) & ~held_out())
    single = usable.groupBy("doc_id").agg(F.min("quality").alias("y"))
    rows = cut_lineage(stats.join(cut_lineage(single), "doc_id").withColumn("calibrate", F.pmod(F.xxhash64("doc_id"), F.lit(4)) == 0))
    moments = rows.select(
        *[f(F.get("stats", F.lit(i))).alias(f"{name}{i}") for i in range(N_STATISTICS) for name, f in (("m", F.avg), ("s", F.stddev_pop))]
    ).first()
    rng = np.random.default_rng(seed)
    centre, width = (np.array([moments[f"{c}{i}"] or 0.0 for i in range(N_STATISTICS)]) for c in "ms")
    # A Gaussian kernel as wide as the typical distance of two standardised points.
    turn = rng.standard_normal((N_STATISTICS, FEATURES)) / np.sqrt(N_STATISTICS)
    model = Model(centre, np.where(width > 1e-9, width, 1.0), turn, rng.uniform(0, 2 * np.pi, FEATURES), np.zeros(FEATURES + 1), np.zeros(1), np.full(1, 0.5))

    def equations(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        a, b, n = np.zeros((FEATURES + 1, FEATURES + 1)), np.zeros(FEATURES + 1), 0
        for f in frames:
            x = model.features(_matrix(f))
            a, b, n = a + x.T @ x, b + x.T @ f["y"].to_numpy("f8"), n + len(f)
        yield pd.DataFrame({"sums": [np.append(np.column_stack([a, b]).ravel(), n).tobytes()]})

    parts = rows.where(~F.col("calibrate")).select("stats", "y").mapInPandas(equations, "sums binary")
    # Partition sums are added in a tree on the executors.
    sums = parts.rdd.map(lambda r: np.frombuffer(r["sums"])).treeReduce(np.add, depth=3)
    table, n = sums[:-1].reshape(FEATURES + 1, FEATURES + 2), sums[-1]
    if not n:
        return model
    model.weights = np.linalg.solve(table[:, :-1] + RIDGE * np.eye(FEATURES + 1), table[:, -1])

    def score(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            step = np.clip(np.floor(model.raw(_matrix(f)) / STEP), -1 / STEP, 2 / STEP).astype("i8")
            yield pd.DataFrame({"step": step, "y": f["y"]})

    counted = rows.where("calibrate").select("stats", "y").mapInPandas(score, "step long, y int").groupBy("step")
    # At most 3000 steps.
    steps = counted.agg(F.avg("y").alias("y"), F.count("*").alias("n")).orderBy("step").toPandas()
    if len(steps):
        model.at, model.value = isotonic((steps["step"].to_numpy() + 0.5) * STEP, steps["y"].to_numpy("f8"), steps["n"].to_numpy("f8"))
    return model


def quality_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, score`` for every row of ``docs``: the probability that its quality is 1. Null texts count as empty."""
    stats = cut_lineage(document_statistics(docs))
    model = fit(stats, labels)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            yield pd.DataFrame({"doc_id": f["doc_id"], "score": model.score(_matrix(f))})

    return stats.mapInPandas(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, score double")

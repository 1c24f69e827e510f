"""Toxicity by subword-bag embeddings averaged into a linear softmax.

A word is the bag of its character n-grams, so that a misspelling shares most vectors with the word it comes from. The vectors
of all n-grams of a text are averaged and go through a linear softmax; vectors and softmax are trained together in numpy.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.texts import words_of
from tallyloom.session import cut_lineage

BUCKETS = 1 << 16
# Stripped from both ends of a word.
EDGES = b".,!?;:\"'()[]{}<>|*#%&$-_"
# A task keeps this many words at hand.
WORDS_KEPT = 400_000


def grams(word: bytes, shortest: int = 3, longest: int = 5) -> list[int]:
    """Buckets of the character n-grams of a word and of the word itself, its ends marked."""
    marked = b"<" + word + b">"
    parts = {marked[i : i + n] for n in range(shortest, longest + 1) for i in range(len(marked) - n + 1)} | {marked}
    return [zlib.crc32(p) % BUCKETS for p in sorted(parts)]


def bag(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of a text and their shares; the shares add up to 1 (no words: nothing)."""
    counts = Counter(w for w in (x.strip(EDGES) for x in words_of(text)) if w)
    ids, times = [], []
    for word, n in counts.items():
        own = grams(word)
        ids += own
        times += [n] * len(own)
    if not ids:
        return np.zeros(0, "i4"), np.zeros(0, "f4")
    total = np.bincount(ids, times)
    at = np.flatnonzero(total)
    return at.astype("i4"), (total[at] / total.sum()).astype("f4")


@dataclass
class Model:
    """``logit`` of class 1 over class 0 is ``bias`` + the average of ``gain`` over the n-grams of a text."""

    gain: np.ndarray
    bias: float

    def score(self, average: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.bias + average, -30, 30)))


def train(
    texts: list[str | None], labels: np.ndarray, dim: int = 4, epochs: int = 5, batch: int = 64, rate: float = 0.02, scale: float = 1500.0, decay: float = 1e-3, seed: int = 5
) -> Model:
    """Fit vectors (buckets x ``dim``) and softmax (``dim`` x 2) by Adam on the cross entropy.

    ``scale`` multiplies averages, as a few telling words are a small share of a long text. The order of the batches depends
    only on ``seed``. With labels of one class only, or none, every text gets the share of class 1 with one more label of
    each class and one more of class 0: 1/3 without labels, so that no text is rejected on no evidence.
    """
    found = np.array([np.sum(labels == c) for c in (0, 1)])
    if not found.all():
        return Model(np.zeros(BUCKETS, "f4"), float(np.log((found[1] + 1.0) / (found[0] + 2.0))))
    bags = [bag(t) for t in texts]
    rng = np.random.default_rng(seed)
    vectors = (rng.standard_normal((BUCKETS, dim)) * 0.01).astype("f4")
    soft = (rng.standard_normal((dim, 2)) * 0.3).astype("f4")
    bias = np.log(np.array([np.sum(labels == c) + 1.0 for c in (0, 1)])).astype("f4")
    state = [[np.zeros_like(p), np.zeros_like(p)] for p in (vectors, soft, bias)]
    steps = 0
    for epoch in range(epochs):
        order = rng.permutation(len(bags))
        for lo in range(0, len(order), batch):
            chosen = order[lo : lo + batch]
            ids = np.concatenate([bags[i][0] for i in chosen])
            share = np.concatenate([bags[i][1] for i in chosen]) * np.float32(scale)
            row = np.repeat(np.arange(len(chosen)), [len(bags[i][0]) for i in chosen])
            taken = vectors[ids]
            mean = np.stack([np.bincount(row, taken[:, d] * share, minlength=len(chosen)) for d in range(dim)], axis=1)
            logits = mean @ soft + bias
            logits -= logits.max(axis=1, keepdims=True)
            prob = np.exp(logits)
            prob /= prob.sum(axis=1, keepdims=True)
            prob[np.arange(len(chosen)), labels[chosen]] -= 1
            error = prob / len(chosen)
            back = error @ soft.T
            grad = np.stack([np.bincount(ids, back[row, d] * share, minlength=BUCKETS) for d in range(dim)], axis=1)
            steps += 1
            for p, g, (m, v) in zip((vectors, soft, bias), (grad + decay * vectors, mean.T @ error, error.sum(axis=0)), state):
                m += 0.1 * (g - m)
                v += 0.01 * (g * g - v)
                step = rate * (1 - epoch / epochs)
                p -= (step * (m / (1 - 0.9**steps)) / (np.sqrt(v / (1 - 0.99**steps)) + 1e-6)).astype("f4")
    return Model((vectors @ (soft[:, 1] - soft[:, 0]) * scale).astype("f4"), float(bias[1] - bias[0]))


def held_out(key: str | Column = "doc_id", folds: int = 5) -> Column:
    """True for rows whose labels no model may see: CRC-32 of the id as text, modulo ``folds``, is 0. A null id is empty text."""
    text = F.coalesce((F.col(key) if isinstance(key, str) else key).cast("string"), F.lit(""))
    return F.crc32(text.cast("binary")) % folds == 0


def fit(docs: DataFrame, labels: DataFrame, sample: int = 9000) -> Model:
    """Train on at most about ``sample`` labelled documents, chosen by a hash of the id, in one task.

    ``labels`` has ``doc_id, toxic``; null ids and labels other than 0 and 1 are left out, as are held-out rows; of several
    labels of an id the largest counts. With labels of one class only, or none, nothing tells texts apart: see ``train``.
    """
    usable = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1) & ~held_out())
    single = cut_lineage(usable.groupBy("doc_id").agg(F.max("toxic").alias("toxic")))
    share = min(1.0, sample / max(1, single.count()))
    chosen = single.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < F.lit(int(share * (1 << 30))))
    # About ``sample`` rows of 12 bytes, whatever the size of the table.
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select(F.xxhash64("doc_id", "text").alias("by"), "text", "toxic")

    def learn(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        all_rows = list(frames)
        f = pd.concat(all_rows).sort_values("by") if all_rows else pd.DataFrame({"text": [], "toxic": []})
        model = train(f["text"].tolist(), f["toxic"].to_numpy("i8"))
        yield pd.DataFrame({"gain": [model.gain.tobytes()], "bias": [model.bias]})

    got = cut_lineage(rows.repartition(1).mapInPandas(learn, "gain binary, bias double")).first()
    return Model(np.frombuffer(got["gain"], "f4"), got["bias"]) if got else train([], np.empty(0, "i8"))


def score(docs: DataFrame, model: Model, keep: list[str]) -> DataFrame:
    """The columns ``keep`` of ``docs`` and ``score``, the probability of class 1 for the whole text.

    A text without words, or null, gets the score of the bias alone.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[bytes, tuple[float, int]] = {}
        for b in batches:
            average = np.zeros(b.num_rows)
            for i, text in enumerate(b.column(b.num_columns - 1).to_pylist()):
                gain = total = 0
                for word, n in Counter(words_of(text)).items():
                    found = known.get(word)
                    if found is None:
                        core = word.strip(EDGES)
                        own = grams(core) if core else []
                        found = known[word] = (float(model.gain[own].sum()) if own else 0.0, len(own))
                    gain += n * found[0]
                    total += n * found[1]
                average[i] = gain / total if total else 0.0
                if len(known) > WORDS_KEPT:
                    known.clear()
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(model.score(average))], [*keep, "score"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*keep).schema)
    return docs.select(*keep, "text").mapInArrow(run, f"{schema}, score double")


def drop_toxic(docs: DataFrame, labels: DataFrame, threshold: float = 0.5) -> DataFrame:
    """The rows of ``docs`` that score below ``threshold``; same columns."""
    packed = docs.select(F.struct("*").alias("doc"), "text")
    return score(packed, fit(docs, labels), ["doc"]).where(F.col("score") < threshold).select("doc.*")

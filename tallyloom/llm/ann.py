"""Nearest neighbours by randomly rotated one-bit codes.

Unit vectors are turned by a fixed random rotation and kept as sign bits plus one scalar, the inner product of the vector with
its own code. Packed bits and that scalar estimate the inner product with a query, and the error bound of the estimate says
which vectors may be among the nearest; only those are compared exactly, on the original vectors.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallyloom.session import cut_lineage

BLOCK = 1024
# Levels of a query's quantised coordinates are 4 bits wide.
QUERY_BITS = 4


@lru_cache(maxsize=4)
def _rotation(dim: int, seed: int) -> np.ndarray:
    """A random orthogonal matrix for vectors padded to whole 64-bit words."""
    wide = -(-dim // 64) * 64
    q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((wide, wide)))
    return (q * np.sign(np.diag(r)))[:dim]


def encode(vectors: np.ndarray, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Packed sign bits (n x words) and the inner product of each rotated unit vector with its code."""
    turned = vectors / np.linalg.norm(vectors, axis=1)[:, None] @ _rotation(vectors.shape[1], seed)
    codes = np.packbits(turned > 0, axis=1, bitorder="little").view("<u8")
    return codes, np.abs(turned).sum(axis=1) / np.sqrt(turned.shape[1])


def estimate(query: np.ndarray, codes: np.ndarray, own: np.ndarray, seed: int, bound: float) -> tuple[np.ndarray, np.ndarray]:
    """Estimated cosine of one query with each coded vector, and the error that is exceeded only with small probability."""
    turned = query / np.linalg.norm(query) @ _rotation(len(query), seed)
    wide = len(turned)
    low = turned.min()
    step = max((turned.max() - low) / ((1 << QUERY_BITS) - 1), 1e-12)
    # Rounded up or down at random, by a generator of fixed seed, so that the rounding has no bias.
    level = np.floor((turned - low) / step + np.random.default_rng(seed).random(wide)).clip(0, (1 << QUERY_BITS) - 1).astype("u1")
    ones = np.bitwise_count(codes).sum(axis=1, dtype="i8")
    with_query = np.zeros(len(codes), "i8")
    for bit in range(QUERY_BITS):
        plane = np.packbits(level >> bit & 1, bitorder="little").view("<u8")
        with_query += np.bitwise_count(codes & plane).sum(axis=1, dtype="i8") << bit
    # The code has coordinates +-1/sqrt(wide); the query is low + step * level.
    inner = (2 * (low * ones + step * with_query) - (low * wide + step * level.sum(dtype="i8"))) / np.sqrt(wide)
    spread = np.sqrt(np.maximum(1 - own**2, 0)) / own * bound / np.sqrt(max(wide - 1, 1))
    return inner / own, spread + step * 0.5 * bound / own


def _exact(query: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Cosines in double precision, summed in the same order for each row, so that equal vectors tie."""
    return (vectors * query).sum(axis=1) / (np.sqrt((vectors * vectors).sum(axis=1)) * np.sqrt((query * query).sum()))


def _blocks(rows: DataFrame, size: int, names: list[str]) -> DataFrame:
    """``dim, block, ids, vectors``: rows dealt out by a hash of the id into blocks of about ``size``."""
    per = rows.groupBy("dim").agg(F.count("*").alias("n"))
    number = F.greatest(F.ceil(F.col("n") / size), F.lit(16)).cast("long")
    dealt = rows.join(cut_lineage(per), "dim").withColumn("block", F.pmod(F.xxhash64("id"), number))
    packed = dealt.groupBy("dim", "block", F.col("n")).agg(F.collect_list(F.struct("id", "vector")).alias("rows"))
    return packed.select(
        F.col("dim"), F.col("block").alias(names[0]), number.alias("blocks"), F.col("rows.id").alias(names[1]), F.flatten("rows.vector").alias(names[2])
    )


def build_index(vectors: DataFrame, k: int, seed: int = 7) -> DataFrame:
    """``dim, block, blocks, ids, codes, own, vectors``: the index, in blocks, written as a table.

    Takes ``vec_id, embedding``. Vectors that are null, zero, empty or hold null or non-finite components take no part, nor do
    null ids; repeated rows count once. Of equal vectors only the ``k`` + 1 smallest ids can ever be among the ``k`` nearest of
    anything, ties going to the smaller id, so the others are left out: exactly, and before any shuffle.
    """
    every = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    usable = vectors.where(F.col("vec_id").isNotNull() & every & F.exists("embedding", lambda x: x != 0))
    rows = usable.select(F.col("vec_id").alias("id"), F.col("embedding").cast("array<double>").alias("vector"), F.size("embedding").alias("dim"))
    # Some key of equal vectors may have a third of all rows; the limit on the rank works in each task first.
    same = W.partitionBy("vector").orderBy("id")
    few = rows.dropDuplicates(["id"]).withColumn("at", F.row_number().over(same)).where(F.col("at") <= k + 1).drop("at")

    def code(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            out = []
            for r in f.itertuples():
                v = np.array(r.vectors).reshape(-1, r.dim)
                codes, own = encode(v, seed)
                out.append((r.dim, r.block, r.blocks, np.array(r.ids, "<i8").tobytes(), codes.tobytes(), own.astype("<f8").tobytes(), v.astype("<f8").tobytes()))
            yield pd.DataFrame(out, columns=["dim", "block", "blocks", "ids", "codes", "own", "vectors"])

    blocks = _blocks(few, BLOCK, ["block", "ids", "vectors"]).repartition("dim", "block")
    return cut_lineage(blocks.mapInPandas(code, "dim int, block long, blocks long, ids binary, codes binary, own binary, vectors binary"))


def search(index: DataFrame, queries: DataFrame, k: int = 5, seed: int = 7, bound: float = 2.5) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` nearest by cosine for each query ``vec_id, embedding``, without itself.

    Every block of queries meets every block of the index of the same dimension. ``bound`` scales the error bound: a
    vector is compared exactly unless its estimate plus error is below the k-th best estimate minus error. Ties go to the
    smaller id; with fewer candidates than ``k``, all are returned. Unusable queries (see ``build_index``) have no rows.
    """
    every = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    usable = queries.where(F.col("vec_id").isNotNull() & every & F.exists("embedding", lambda x: x != 0)).dropDuplicates(["vec_id"])
    rows = usable.select(F.col("vec_id").alias("id"), F.col("embedding").cast("array<double>").alias("vector"), F.size("embedding").alias("dim"))
    asked = _blocks(rows, BLOCK, ["query_block", "query_ids", "query_vectors"]).drop("blocks")
    counts = index.groupBy("dim").agg(F.max("blocks").alias("n"))
    dealt = asked.join(counts, "dim").withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1))).drop("n")
    met = dealt.join(index.drop("blocks"), ["dim", "block"]).repartition("dim", "block", "query_block")

    def find(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            for r in f.itertuples():
                ids, own = np.frombuffer(r.ids, "<i8"), np.frombuffer(r.own, "<f8")
                codes = np.frombuffer(r.codes, "<u8").reshape(len(ids), -1)
                vectors = np.frombuffer(r.vectors, "<f8").reshape(len(ids), r.dim)
                out = []
                for qid, q in zip(r.query_ids, np.array(r.query_vectors).reshape(-1, r.dim)):
                    other = np.flatnonzero(ids != qid)
                    if len(other) > k:
                        guess, error = estimate(q, codes[other], own[other], seed, bound)
                        least = np.partition(guess - error, -k)[-k]
                        other = other[guess + error >= least]
                    score = _exact(q, vectors[other])
                    best = np.lexsort((ids[other], -score))[:k]
                    out.append(pd.DataFrame({"query_id": qid, "vec_id": ids[other][best], "score": score[best]}))
                yield pd.concat(out)

    near = met.mapInPandas(find, "query_id long, vec_id long, score double")
    order = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return near.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")

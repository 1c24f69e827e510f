"""Row generators."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Numbers that a task sieves at once.
SEGMENT = 1 << 19


def linspace(spark: SparkSession, start: float, stop: float, n: int) -> DataFrame:
    """``n`` evenly spaced values from ``start`` to ``stop``, both included: ``position, value``."""
    if n < 1:
        raise ValueError("n must be positive")
    step = (stop - start) / (n - 1) if n > 1 else 0.0
    inner = F.lit(float(start)) + F.col("id") * F.lit(step)
    value = F.when((F.col("id") == n - 1) & F.lit(n > 1), F.lit(float(stop))).otherwise(inner)
    return spark.range(n).select(F.col("id").alias("position"), value.alias("value"))


def zeros(spark: SparkSession, rows: int, cols: int) -> DataFrame:
    """A dense matrix of zeros as ``row, col, value``."""
    cell = spark.range(rows * cols)
    return cell.select(
        F.floor(F.col("id") / cols).alias("row"), (F.col("id") % cols).alias("col"), F.lit(0.0).alias("value")
    )


def int_range(spark: SparkSession, start: int, stop: int, step: int = 1) -> DataFrame:
    """Integers from ``start`` up to but not including ``stop``."""
    return spark.range(start, stop, step).select(F.col("id").alias("value"))


def unit_hash(*cols: Column, seed: int = 0) -> Column:
    """A value in [0, 1) that depends on the columns and the seed alone, whatever the partitioning."""
    return F.shiftrightunsigned(F.xxhash64(*cols, F.lit(seed)), 11) / F.lit(float(2**53))


def random_rows(spark: SparkSession, n: int, seed: int = 0, lo: float = 0.0, hi: float = 1.0) -> DataFrame:
    """``n`` repeatable pseudo-random values in [lo, hi): ``id, value``."""
    return spark.range(n).select("id", (F.lit(lo) + unit_hash(F.col("id"), seed=seed) * F.lit(hi - lo)).alias("value"))


def _sieve(lo: int, hi: int) -> np.ndarray:
    """Which numbers of [lo, hi) are primes, by striking out the multiples of the primes up to the root of ``hi``."""
    left = np.ones(max(hi - lo, 0), bool)
    left[: max(0, 2 - lo)] = False
    root = math.isqrt(max(hi - 1, 0))
    for at in range(2, root + 1, SEGMENT):  # the base primes are sieved in segments as well
        stop = min(at + SEGMENT, root + 1)
        for p in (at + np.flatnonzero(_sieve(at, stop))).tolist():
            left[max(p * p, -(-lo // p) * p) - lo :: p] = False
    return left


def primes_between(spark: SparkSession, lo: int, hi: int, parts: int | None = None) -> DataFrame:
    """``value``: the primes of [lo, hi), by a sieve of one segment after the other in every task."""
    lo = max(lo, 0)
    segments = spark.range(lo // SEGMENT, max(hi - 1, 0) // SEGMENT + 1, 1, parts or spark.sparkContext.defaultParallelism)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for k in frame["id"].tolist():
                start, stop = max(lo, k * SEGMENT), min(hi, (k + 1) * SEGMENT)
                yield pd.DataFrame({"value": start + np.flatnonzero(_sieve(start, stop))})

    return segments.mapInPandas(run, "value long")


def count_primes(spark: SparkSession, lo: int, hi: int, parts: int | None = None) -> DataFrame:
    """``primes``: how many primes lie in [lo, hi), counted by ``parts`` tasks."""
    return primes_between(spark, lo, hi, parts).agg(F.count("*").alias("primes"))

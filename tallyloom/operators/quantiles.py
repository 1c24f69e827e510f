"""Exact quantiles with linear interpolation between neighbours, by radix selection.

Doubles have an order-preserving image among the unsigned 64-bit numbers. Four passes count its digits of 16 bits: the
first over all rows, each further one among the rows that share the digits found so far. A pass adds up at most 65,536 counts
for each wanted position, however many rows or different values there are and whichever value is frequent.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from math import ceil, floor

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DIGIT = 16
_SIGN = np.uint64(1 << 63)


def image(values: np.ndarray) -> np.ndarray:
    """Unsigned numbers in the order of ``values``: -0.0 equals 0.0, NaN is largest."""
    plain = np.where(np.isnan(values), np.nan, values + 0.0)
    bits = plain.view("u8")
    return np.where(bits & _SIGN, ~bits, bits | _SIGN)


def value_of(bits: int) -> float:
    """The double of an image."""
    raw = bits ^ (1 << 63) if bits >> 63 else bits ^ ((1 << 64) - 1)
    return float(np.array([raw], "u8").view("f8")[0])


def _digits(wide: DataFrame, prefixes: list[list[int]], level: int) -> dict[tuple[int, int], np.ndarray]:
    """For each column (by number) and prefix the counts of the next digit."""
    shift = 64 - DIGIT * (level + 1)

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[tuple[int, int], np.ndarray] = {}
        for frame in frames:
            for c, wanted in enumerate(prefixes):
                column = frame.iloc[:, c]
                bits = image(column[frame.iloc[:, len(prefixes) + c]].to_numpy("f8"))
                above = bits >> np.uint64(shift + DIGIT) if level else np.zeros(len(bits), "u8")
                digit = (bits >> np.uint64(shift)).astype("i8") & ((1 << DIGIT) - 1)
                for p in wanted:
                    n = np.bincount(digit[above == np.uint64(p)], minlength=1 << DIGIT)
                    held[c, p] = held.get((c, p), 0) + n
        for (c, p), n in held.items():
            at = np.flatnonzero(n)
            yield pd.DataFrame({"c": c, "p": str(p), "digit": at, "n": n[at]})

    parts = wide.mapInPandas(count, "c int, p string, digit int, n long")
    out: dict[tuple[int, int], np.ndarray] = {}
    table = parts.groupBy("c", "p", "digit").agg(F.sum("n").alias("n")).toArrow().to_pandas()
    for (c, p), rows in table.groupby(["c", "p"]):
        out[c, int(p)] = np.zeros(1 << DIGIT, "i8")
        out[c, int(p)][rows["digit"]] = rows["n"]
    return out


def exact_quantiles(df: DataFrame, cols: Sequence[str], probs: Sequence[float]) -> DataFrame:
    """``column, prob, value`` for every column and probability; nulls are left out, NaN is the largest value.

    A column without values has no rows.
    """
    # Nulls and NaN are the same to pandas, so a flag tells them apart.
    wide = df.select(
        *[F.col(c).cast("double").alias(f"v{i}") for i, c in enumerate(cols)], *[F.col(c).isNotNull().alias(f"k{i}") for i, c in enumerate(cols)]
    )
    # A wanted position is known by its column and place; it holds the digits so far and its place among the rows that share them.
    spots: dict[tuple[int, int], tuple[int, int]] = {}
    wanted: dict[tuple[int, float], tuple[int, int, float]] = {}
    for level in range(64 // DIGIT):
        prefixes = [sorted({p for (k, _), (p, _) in spots.items() if k == c}) if level else [0] for c in range(len(cols))]
        counts = _digits(wide, prefixes, level)
        if not level:
            for (c, _), n in counts.items():
                for prob in probs:
                    spot = float(prob) * (int(n.sum()) - 1)
                    wanted[c, float(prob)] = floor(spot), ceil(spot), spot - floor(spot)
                    spots |= {(c, at): (0, at) for at in (floor(spot), ceil(spot))}
        for (c, place), (prefix, at) in spots.items():
            upto = np.cumsum(counts[c, prefix])
            digit = int(np.searchsorted(upto, at, "right"))
            spots[c, place] = (prefix << DIGIT | digit, at - int(upto[digit - 1]) if digit else at)
    rows = []
    for (c, prob), (low, high, share) in wanted.items():
        a, b = value_of(spots[c, low][0]), value_of(spots[c, high][0])
        rows.append((cols[c], prob, a if a == b or not share else a + (b - a) * share))
    return df.sparkSession.createDataFrame(rows, "column string, prob double, value double")

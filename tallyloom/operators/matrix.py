"""Matrices as coordinate tables ``row, col, value``; absent cells are zero."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyloom.session import cut_lineage

_AT = ["row", "col"]


def stack_sum(mats: Sequence[DataFrame]) -> DataFrame:
    """Sum of any number of matrices: one shuffle, with partial sums before it."""
    rows = mats[0].select(*_AT, "value")
    for m in mats[1:]:
        rows = rows.unionByName(m.select(*_AT, "value"))
    return rows.groupBy(*_AT).agg(F.sum("value").alias("value"))


def mat_scale(a: DataFrame, k: float) -> DataFrame:
    return a.select(*_AT, (F.col("value") * k).alias("value"))


def mat_add(a: DataFrame, b: DataFrame) -> DataFrame:
    return stack_sum([a, b])


def mat_sub(a: DataFrame, b: DataFrame) -> DataFrame:
    return stack_sum([a, mat_scale(b, -1)])


def stack_product(a: DataFrame, b: DataFrame) -> DataFrame:
    """Element-wise product; a cell absent from either side is zero and left out."""
    right = b.select(*_AT, F.col("value").alias("_v"))
    return a.join(right, _AT).select(*_AT, (F.col("value") * F.col("_v")).alias("value"))


def _blocks(m: DataFrame, at: tuple[str, str], kind: str, block: int) -> DataFrame:
    """One row for each occupied block: its numbers ``at``, and places and values of its cells."""
    cells = m.where(F.col("value").isNotNull())
    names = [F.floor(F.col(c) / block).cast("long").alias(n) for c, n in zip(_AT, at)]
    inside = [F.pmod(F.col(c), F.lit(block)).cast("int").alias(f"{c}_at") for c in _AT]
    row = F.struct(*[f"{c}_at" for c in _AT], "value")
    packed = cells.select(*names, *inside, F.col("value").cast(kind).alias("value")).groupBy(*at).agg(F.collect_list(row).alias("c"))
    side = "".join(at)
    return packed.select(*at, *[F.col(f"c.{c}").alias(f"{side}_{c}") for c in ("row_at", "col_at", "value")])


def _dense(rows: np.ndarray, cols: np.ndarray, values: np.ndarray, inner: np.ndarray, by_col: bool) -> tuple[np.ndarray, np.ndarray]:
    """A block over the outer lines that occur and the given inner ones; the outer lines."""
    outer, other = (rows, cols) if by_col else (cols, rows)
    keep = np.isin(other, inner)
    lines, at = np.unique(outer[keep], return_inverse=True)
    out = np.zeros((len(lines), len(inner)), values.dtype)
    np.add.at(out, (at, np.searchsorted(inner, other[keep])), values[keep])
    return out, lines


def mat_mul(a: DataFrame, b: DataFrame, block: int = 256) -> DataFrame:
    """A · B on a grid of (row block, inner block, column block).

    Each triple of blocks is one task row that gives partial sums of its result cells, so a dense inner index is dealt out as
    any other. Whole numbers stay whole (64 bits), all others are doubles; null cells count as absent.
    """
    whole = all(isinstance(m.schema["value"].dataType, T.IntegralType) for m in (a, b))
    kind = "long" if whole else "double"
    left, right = cut_lineage(_blocks(a, ("i", "k"), kind, block)), cut_lineage(_blocks(b, ("k", "j"), kind, block))
    # Numbers of blocks only: what is in them follows by its own block, not by the inner one.
    triples = cut_lineage(left.select("i", "k").join(right.select("k", "j"), "k"))
    met = triples.join(left, ["i", "k"]).join(right, ["k", "j"])
    tasks = max(int(a.sparkSession.conf.get("spark.sql.shuffle.partitions")), a.sparkSession.sparkContext.defaultParallelism)

    def product(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for p in frame.itertuples():
                ar, ac, br, bc = (np.asarray(x) for x in (p.ik_row_at, p.ik_col_at, p.kj_row_at, p.kj_col_at))
                inner = np.intersect1d(ac, br)
                if not len(inner):
                    continue
                number = "i8" if whole else "f8"
                x, rows = _dense(ar, ac, np.asarray(p.ik_value, number), inner, True)
                y, cols = _dense(br, bc, np.asarray(p.kj_value, number), inner, False)
                there = _dense(ar, ac, np.ones(len(ar)), inner, True)[0] @ _dense(br, bc, np.ones(len(br)), inner, False)[0].T > 0
                r, c = np.nonzero(there)
                yield pd.DataFrame({"row": p.i * block + rows[r], "col": p.j * block + cols[c], "value": (x @ y.T)[r, c]})

    parts = met.repartition(tasks, "i", "k", "j").mapInPandas(product, f"row long, col long, value {kind}")
    return parts.groupBy(*_AT).agg(F.sum("value").alias("value"))


def transpose(a: DataFrame) -> DataFrame:
    return a.select(F.col("col").alias("row"), F.col("row").alias("col"), "value")


def hsplit(a: DataFrame, at: int) -> tuple[DataFrame, DataFrame]:
    """Left part and right part; the right one starts again at column 0."""
    return a.where(F.col("col") < at), a.where(F.col("col") >= at).withColumn("col", F.col("col") - at)


def vsplit(a: DataFrame, at: int) -> tuple[DataFrame, DataFrame]:
    """Upper part and lower part; the lower one starts again at row 0."""
    return a.where(F.col("row") < at), a.where(F.col("row") >= at).withColumn("row", F.col("row") - at)


def reshape(a: DataFrame, cols: int, new_cols: int) -> DataFrame:
    """Row-major reshape from ``cols`` to ``new_cols`` columns."""
    at = F.col("row") * cols + F.col("col")
    return a.select(F.floor(at / new_cols).alias("row"), (at % new_cols).alias("col"), "value")


def keep_all_above(mats: DataFrame, threshold: float, mat: str = "m") -> DataFrame:
    """Ids of the matrices whose every entry exceeds the threshold."""
    return mats.groupBy(mat).agg(F.min("value").alias("_low")).where(F.col("_low") > threshold).select(mat)


def to_array_rows(a: DataFrame, cols: int) -> DataFrame:
    """One dense array per row, for matrices with few columns (numbered from 0)."""
    slots = [F.coalesce(F.sum(F.when(F.col("col") == j, F.col("value"))), F.lit(0)).cast(T.DoubleType()) for j in range(cols)]
    return a.groupBy("row").agg(F.array(*slots).alias("values"))

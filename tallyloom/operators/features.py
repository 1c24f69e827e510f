"""Encoding, scaling and repeatable splits."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from itertools import combinations_with_replacement
from math import ceil

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.operators.order import Order, enumerate_rows
from tallyloom.session import cut_lineage


def label_codes(df: DataFrame, col: str) -> DataFrame:
    """``value, code``: the distinct values in code-point order, numbered from 0."""
    values = df.where(F.col(col).isNotNull()).select(F.col(col).alias("value")).distinct()
    return enumerate_rows(values, "value", name="code")


def encode_with(df: DataFrame, col: str, codes: DataFrame, name: str | None = None, unseen: int | None = None) -> DataFrame:
    """Add the code of a column; a value without one gets ``unseen``, or raises when the row is computed. Null stays null."""
    keyed = codes.select(F.col("value").alias(col), F.col("code").alias("_code"))
    if unseen is not None:
        known = F.when(F.col(col).isNull(), F.lit(None)).otherwise(F.coalesce("_code", F.lit(unseen).cast("long")))
        return df.join(keyed, col, "left").withColumn(name or f"{col}_code", known).drop("_code")
    unknown = F.raise_error(F.concat(F.lit(f"unseen value in {col}: "), F.col(col).cast("string"))).cast("long")
    code = F.when(F.col("_code").isNotNull() | F.col(col).isNull(), F.col("_code")).otherwise(unknown)
    return df.join(keyed, col, "left").withColumn(name or f"{col}_code", code).drop("_code")


def label_encode(df: DataFrame, cols: Sequence[str]) -> tuple[DataFrame, dict[str, DataFrame]]:
    """Add ``<col>_code`` per column and return the code tables, for later data and for decoding."""
    codes = {c: label_codes(df, c) for c in cols}
    for c in cols:
        df = encode_with(df, c, codes[c])
    return df, codes


def decode(df: DataFrame, code_col: str, codes: DataFrame, name: str) -> DataFrame:
    """Turn codes back into values."""
    return df.join(codes.select(F.col("code").alias(code_col), F.col("value").alias(name)), code_col, "left")


def standardise(train: DataFrame, *others: DataFrame, cols: Sequence[str]) -> list[DataFrame]:
    """Mean 0 and population variance 1, learnt on the first table and applied to all.

    A constant column is only shifted.
    """
    stats = train.agg(*[f(c).alias(f"{n}_{c}") for c in cols for n, f in (("m", F.avg), ("s", F.stddev_pop))]).first()

    def scaled(c: str) -> Column:
        return (F.col(c) - F.lit(stats[f"m_{c}"])) / F.lit(stats[f"s_{c}"] or 1.0)

    return [df.withColumns({c: scaled(c) for c in cols}) for df in (train, *others)]


def minmax_scale(df: DataFrame, col: str, lo: float, hi: float, name: str | None = None) -> DataFrame:
    """Scale linearly onto [lo, hi]; a constant column becomes ``lo``."""
    ends = df.agg(F.min(col).alias("a"), F.max(col).alias("b")).first()
    span = (ends["b"] - ends["a"]) if ends["a"] is not None else 0
    value = F.lit(float(lo)) + (F.col(col) - F.lit(ends["a"])) * F.lit((hi - lo) / span if span else 0.0)
    return df.withColumn(name or col, value)


def poly_terms(cols: Sequence[str], degree: int) -> list[tuple[str, tuple[str, ...]]]:
    """Names and factors of all products up to a degree, the constant ``1`` first."""
    terms: list[tuple[str, tuple[str, ...]]] = [("1", ())]
    for d in range(1, degree + 1):
        for factors in combinations_with_replacement(cols, d):
            powers = {c: factors.count(c) for c in dict.fromkeys(factors)}
            terms.append((" ".join(c if p == 1 else f"{c}^{p}" for c, p in powers.items()), factors))
    return terms


def poly_features(df: DataFrame, cols: Sequence[str], degree: int) -> tuple[DataFrame, list[str]]:
    """Add one column per product of the given columns up to a degree; returns the names in order."""
    terms = poly_terms(cols, degree)
    added = {}
    for name, factors in terms:
        value = F.lit(1.0)
        for c in factors:
            value = value * F.col(c)
        if name not in cols:
            added[name] = value
    return df.withColumns(added), [name for name, _ in terms]


def split_at(
    df: DataFrame, order: Order | Sequence[Order], n: int, legacy_gap: bool = False
) -> tuple[DataFrame, DataFrame]:
    """First ``n`` rows in order, and the rest; ``legacy_gap`` leaves out the row at position n."""
    placed = enumerate_rows(df, order, name="_pos")
    rest = F.col("_pos") > n if legacy_gap else F.col("_pos") >= n
    return placed.where(F.col("_pos") < n).drop("_pos"), placed.where(rest).drop("_pos")


def _draw(id_col: str, seed: int) -> Column:
    return F.shiftrightunsigned(F.xxhash64(F.col(id_col), F.lit(seed)), 16)


def _first_by_hash(df: DataFrame, id_col: str, wanted: Mapping[object, int], label: Column, seed: int) -> Column:
    """True for the ``wanted[label]`` rows of each label that come first by a 48-bit hash of their id.

    The cut is found by counting hash prefixes, 16 bits at a time, so nothing is sorted and the driver sees
    at most 65 536 counts per label. Ids must be unique.
    """
    draw = _draw(id_col, seed)
    tests = []
    todo = {k: (n, None) for k, n in wanted.items()}
    for shift in (32, 16, 0):
        inside = F.lit(False)
        for key, (_, prefix) in todo.items():
            same = label.eqNullSafe(F.lit(key))
            inside = inside | (same if prefix is None else same & (F.shiftright(draw, shift + 16) == prefix))
        counts = df.where(inside).groupBy(label.alias("k"), F.shiftright(draw, shift).alias("p")).count().collect()
        per_key: dict[object, list] = {}
        for row in sorted(counts, key=lambda r: r["p"]):
            per_key.setdefault(row["k"], []).append((row["p"], row["count"]))
        for key, (need, _) in list(todo.items()):
            for prefix, n in per_key.get(key, []):
                if n > need:
                    todo[key] = (need, prefix)
                    break
                need -= n
            else:
                todo.pop(key)
                tests.append(label.eqNullSafe(F.lit(key)))
    for key, (need, prefix) in todo.items():
        same = label.eqNullSafe(F.lit(key))
        # Only ids with one and the same 48-bit hash get here.
        equal = df.where(same & (draw == prefix)).select(id_col).orderBy(id_col).limit(need).collect()
        tests.append(same & ((draw < prefix) | F.col(id_col).isin([r[0] for r in equal])))
    chosen = F.lit(False)
    for test in tests:
        chosen = chosen | test
    return chosen


def split_random(df: DataFrame, id_col: str, test: float, seed: int = 0) -> tuple[DataFrame, DataFrame]:
    """Train and test rows; the test part has exactly ``ceil(rows × test)`` of them."""
    n_test = ceil(df.count() * test - 1e-9)
    chosen = _first_by_hash(df, id_col, {0: n_test}, F.lit(0), seed)
    return df.where(~chosen), df.where(chosen)


def split_stratified(df: DataFrame, id_col: str, label: str, train: float, seed: int = 0) -> tuple[DataFrame, DataFrame]:
    """Train and test rows with the same share of every label, to within one row. Null is a label like any other.

    The rows of a label are numbered by a hash of their id, and the first of them are for training.
    """
    placed = enumerate_rows(df, [F.col(label), _draw(id_col, seed), F.col(id_col)], name="_pos")
    sizes = placed.groupBy(F.col(label).alias("_label")).agg(F.min("_pos").alias("_start"), F.bround(F.count("*") * F.lit(float(train))).alias("_train"))
    # Written, so that its size is known: else the rows may be the side that is sent to every task.
    dealt = placed.join(cut_lineage(sizes), F.col(label).eqNullSafe(F.col("_label")))
    first = F.col("_pos") - F.col("_start") < F.col("_train")
    return dealt.where(first).select(*df.columns), dealt.where(~first).select(*df.columns)


def kfold_assign(df: DataFrame, id_col: str, label: str, k: int, seed: int | None = None, name: str = "fold") -> DataFrame:
    """Deal the rows of each label out to k folds in turn, by id or, with a seed, by a hash of it."""
    key = F.col(id_col) if seed is None else _draw(id_col, seed)
    placed = enumerate_rows(df, [F.col(label), key, F.col(id_col)], name="_pos")
    starts = placed.groupBy(F.col(label).alias("_label")).agg(F.min("_pos").alias("_start"))
    # Null is a label like any other.
    dealt = placed.join(cut_lineage(starts), F.col(label).eqNullSafe(F.col("_label")))
    return dealt.withColumn(name, ((F.col("_pos") - F.col("_start")) % k).cast("int")).drop("_pos", "_start", "_label")

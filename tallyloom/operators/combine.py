"""Joins and combination by position."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.operators.order import Order, enumerate_rows


def join_on(a: DataFrame, b: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join on columns of the same name; the plan picks the strategy from the sizes it sees."""
    return a.join(b, list(keys), how)


def outer_fill(a: DataFrame, b: DataFrame, keys: Sequence[str], fill: int = 0) -> DataFrame:
    """Full outer join; numbers missing on one side become ``fill`` and keep their type."""
    joined = a.join(b, list(keys), "full")
    values = [c for c in joined.columns if c not in keys]
    return joined.select(*keys, *[F.coalesce(F.col(c), F.lit(fill).cast(joined.schema[c].dataType)).alias(c) for c in values])


def only_in(a: DataFrame, b: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Distinct keys of ``a`` that ``b`` lacks."""
    return a.select(*keys).distinct().join(b.select(*keys).distinct(), list(keys), "left_anti")


def keys_in_both(a: DataFrame, b: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Distinct keys found on both sides."""
    return a.select(*keys).distinct().join(b.select(*keys).distinct(), list(keys), "left_semi")


def zip_rows(
    a: DataFrame, b: DataFrame, order_a: Order | Sequence[Order], order_b: Order | Sequence[Order]
) -> DataFrame:
    """Pair rows by position; stops at the shorter side. Column names must differ."""
    left = enumerate_rows(a, order_a)
    return left.join(enumerate_rows(b, order_b), "position")


def year_summary(a: DataFrame, b: DataFrame, year_a: Column, year_b: Column) -> DataFrame:
    """``year, a_rows, b_rows``: rows per year of two tables, 0 where one has none."""
    left = a.groupBy(year_a.alias("year")).agg(F.count("*").alias("a_rows"))
    right = b.groupBy(year_b.alias("year")).agg(F.count("*").alias("b_rows"))
    return outer_fill(left, right, ["year"])

"""Set algebra on whole rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def set_union(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.union(b).distinct()


def _sides(a: DataFrame, b: DataFrame) -> DataFrame:
    """Each distinct row once, with ``_sides`` 1 (only in a), 2 (only in b) or 3.

    Both sides are shuffled once, after a partial aggregate that thins out repeated rows; nulls compare equal.
    """
    both = a.withColumn("_side", F.lit(1)).union(b.withColumn("_side", F.lit(2)))
    return both.groupBy(*a.columns).agg(F.bit_or("_side").alias("_sides"))


def set_intersect(a: DataFrame, b: DataFrame) -> DataFrame:
    """Distinct rows found in both."""
    return _sides(a, b).where("_sides = 3").select(*a.columns)


def set_difference(a: DataFrame, b: DataFrame) -> DataFrame:
    """Distinct rows of ``a`` not in ``b``."""
    return _sides(a, b).where("_sides = 1").select(*a.columns)


def set_symdiff(a: DataFrame, b: DataFrame) -> DataFrame:
    """Distinct rows in exactly one of the two."""
    return _sides(a, b).where("_sides < 3").select(*a.columns)


def is_superset(a: DataFrame, b: DataFrame) -> DataFrame:
    """One row ``superset``: whether ``a`` holds every row of ``b``."""
    return _sides(a, b).agg((F.count_if(F.col("_sides") == 2) == 0).alias("superset"))


def chain(*frames: DataFrame) -> DataFrame:
    """Concatenate; duplicates stay."""
    return reduce(lambda x, y: x.unionByName(y), frames)

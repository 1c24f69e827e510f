"""Python functions on columns and batches, and SQL on views."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def udf_century(year: Column) -> Column:
    """Century of a year as a vectorised Python function; the built-in ``century`` is faster."""

    @F.pandas_udf("long")
    def century_of(years: pd.Series) -> pd.Series:
        return (years // 100 + 1).astype("Int64")

    return century_of(year)


def batch_filter(df: DataFrame, keep: Callable[[pd.DataFrame], pd.Series]) -> DataFrame:
    """Filter with a pandas predicate, one Arrow batch at a time. Spark cannot push it down; prefer a Column."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield batch[keep(batch)]

    return df.mapInPandas(run, df.schema)


def apply_cell(df: DataFrame, col: str, fn: Callable[[object], object], dtype: str, name: str | None = None) -> DataFrame:
    """Apply a Python function to every cell of a column."""

    @F.pandas_udf(dtype)
    def run(values: pd.Series) -> pd.Series:
        return values.map(fn)

    return df.withColumn(name or col, run(col))


def sql_view(df: DataFrame, name: str, statement: str) -> DataFrame:
    """Register ``df`` as a temporary view and run a SQL statement on it."""
    df.createOrReplaceTempView(name)
    return df.sparkSession.sql(statement)

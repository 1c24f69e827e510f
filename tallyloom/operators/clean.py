"""Projection, filters, casts and repairs."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyloom.functions.numbers import decade
from tallyloom.operators.quantiles import exact_quantiles


def project(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.select(*cols)


def truthy(df: DataFrame, col: str) -> Column:
    """False for null, zero, NaN-free emptiness: 0, "", false, empty array or map."""
    value, kind = F.col(col), df.schema[col].dataType
    if isinstance(kind, T.StringType):
        full = value != ""
    elif isinstance(kind, T.BooleanType):
        full = value
    elif isinstance(kind, (T.ArrayType, T.MapType)):
        full = F.size(value) > 0
    elif isinstance(kind, T.NumericType):
        full = value != 0
    else:
        full = value.isNotNull()
    return F.coalesce(full, F.lit(False))


def drop_falsy(df: DataFrame, col: str) -> DataFrame:
    """Keep the rows whose value counts as true."""
    return df.where(truthy(df, col))


def cast_cols(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Cast several columns at once; a bad value raises."""
    return df.select(*[F.col(c).cast(types[c]).alias(c) if c in types else F.col(c) for c in df.columns])


def coerce_cols(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Cast several columns at once; a bad value becomes null."""
    return df.select(*[F.col(c).try_cast(types[c]).alias(c) if c in types else F.col(c) for c in df.columns])


def rename(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed(dict(names))


def null_counts(df: DataFrame) -> DataFrame:
    """``column, nulls`` for every column, counted in one pass."""
    counted = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    return counted.unpivot([], df.columns, "column", "nulls")


def fill_const(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    """Replace nulls by constants, column by column."""
    return df.fillna(dict(values))


def fill_median(df: DataFrame, col: str) -> DataFrame:
    """Replace nulls by the exact median of the column (two middle values are averaged)."""
    median = exact_quantiles(df, [col], [0.5]).select("value")
    return df.withColumn(col, F.coalesce(F.col(col).cast("double"), median.scalar()))


def validation_report(df: DataFrame, year: Column, name: Column, today: int) -> DataFrame:
    """One row: rows, negative years, years after ``today``, blank names."""
    return df.agg(
        F.count("*").alias("rows"),
        F.count_if(year < 0).alias("negative_year"),
        F.count_if(year > today).alias("future_year"),
        F.count_if(name.isNull() | (F.trim(name) == "")).alias("blank_name"),
    )


def decade_counts(df: DataFrame, year: Column) -> DataFrame:
    """Rows per decade."""
    return df.where(year.isNotNull()).groupBy(decade(year).alias("decade")).agg(F.count("*").alias("n"))


def top_decade(df: DataFrame, year: Column) -> DataFrame:
    """The decade with the most rows; the earlier name wins a tie."""
    return decade_counts(df, year).orderBy(F.desc("n"), "decade").limit(1)


def compose(*steps: Callable[[DataFrame], DataFrame]) -> Callable[[DataFrame], DataFrame]:
    """Chain table transformations, first one first."""
    return lambda df: reduce(lambda acc, step: acc.transform(step), steps, df)


def compose_columns(*steps: Callable[[Column], Column]) -> Callable[[Column], Column]:
    """Chain column functions, first one first."""
    return lambda col: reduce(lambda acc, step: step(acc), steps, col)

"""Text, CSV, JSON, ORC and Parquet files."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_CSV = {"quote": '"', "escape": '"', "encoding": "UTF-8"}


def as_struct(schema: T.StructType | str) -> T.StructType:
    """Accept a DDL string or a StructType."""
    return schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)


def read_table(
    spark: SparkSession, path: str, schema: T.StructType | str, sep: str = ",", header: bool = True
) -> DataFrame:
    """Read delimited text with a declared schema; a value that does not fit raises an error."""
    return spark.read.schema(as_struct(schema)).csv(path, sep=sep, header=header, mode="FAILFAST", **_CSV)


def read_table_tolerant(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str,
    fill: Mapping[str, object] | None = None,
    sep: str = ",",
    header: bool = True,
) -> DataFrame:
    """Read delimited text; a missing or unreadable cell takes its column's fill value (else null)."""
    fields = as_struct(schema).fields
    fill = fill or {}
    raw = spark.read.schema(T.StructType([T.StructField(f.name, T.StringType()) for f in fields]))
    rows = raw.csv(
        path,
        sep=sep,
        header=header,
        mode="PERMISSIVE",
        ignoreLeadingWhiteSpace=True,
        ignoreTrailingWhiteSpace=True,
        **_CSV,
    )

    def cell(field: T.StructField) -> Column:
        value = F.col(field.name).try_cast(field.dataType)
        if field.name in fill:
            value = F.coalesce(value, F.lit(fill[field.name]).cast(field.dataType))
        return value.alias(field.name)

    return rows.select(*[cell(f) for f in fields])


def flatten_structs(df: DataFrame, sep: str = ".") -> DataFrame:
    """Replace every struct column, at any depth, by one column per leaf named ``a.b``."""

    def leaves(schema: T.StructType, path: tuple[str, ...] = ()) -> Iterator[tuple[str, ...]]:
        for f in schema.fields:
            here = (*path, f.name)
            if isinstance(f.dataType, T.StructType):
                yield from leaves(f.dataType, here)
            else:
                yield here

    def pick(path: tuple[str, ...]) -> Column:
        return F.col(".".join(f"`{p}`" for p in path)).alias(sep.join(path))

    return df.select(*[pick(p) for p in leaves(df.schema)])


def read_json_flat(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str | None = None,
    multi_line: bool = True,
    sep: str = ".",
) -> DataFrame:
    """Read JSON as a flat table.

    A file holding one JSON array (``multi_line``) is parsed by one task per file; large data should
    come as JSON Lines with ``multi_line=False``, which Spark splits.
    """
    reader = spark.read if schema is None else spark.read.schema(as_struct(schema))
    return flatten_structs(reader.json(path, multiLine=multi_line), sep)


def result_bindings(df: DataFrame, json_col: str, variables: Mapping[str, str]) -> DataFrame:
    """Explode query-result JSON (``results.bindings[].<var>.value``) and cast each variable.

    A variable absent from a binding, or text that does not fit the type, gives null.
    """
    binding = ", ".join(f"`{v}`: struct<value: string>" for v in variables)
    schema = f"results struct<bindings: array<struct<{binding}>>>"
    keep = [c for c in df.columns if c != json_col]
    rows = df.select(*keep, F.explode(F.from_json(json_col, schema)["results"]["bindings"]).alias("_b"))
    return rows.select(*keep, *[F.col(f"_b.`{v}`.value").try_cast(t).alias(v) for v, t in variables.items()])


def read_lines(spark: SparkSession, path: str | list[str], with_file: bool = False) -> DataFrame:
    """Text lines (``value``) of one file, a folder or a glob; optionally with the file they came from."""
    lines = spark.read.text(path)
    return lines.select("value", F.col("_metadata.file_path").alias("file")) if with_file else lines


def read_chunks(
    spark: SparkSession,
    path: str,
    fn: Callable[[pd.DataFrame], pd.DataFrame],
    schema: str,
    chunk_rows: int = 1000,
) -> DataFrame:
    """Apply ``fn`` to runs of at most ``chunk_rows`` lines; no task holds more than one Arrow batch."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for start in range(0, len(batch), chunk_rows):
                yield fn(batch.iloc[start : start + chunk_rows])

    return read_lines(spark, path).mapInPandas(run, schema)


def from_pandas(spark: SparkSession, pdf: pd.DataFrame, schema: T.StructType | str | None = None) -> DataFrame:
    """A Spark table from a small pandas one."""
    return spark.createDataFrame(pdf, schema=as_struct(schema) if schema else None)


def write_csv(df: DataFrame, path: str, sep: str = ",", mode: str = "errorifexists") -> None:
    """CSV folder with a header row and no index column."""
    df.write.mode(mode).csv(path, sep=sep, header=True, **_CSV)


def write_json_records(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """One JSON object per record, one record per line."""
    df.write.mode(mode).json(path)


def write_lines(df: DataFrame, path: str, append: bool = False) -> None:
    """Write a one-column string table as text lines, or add lines to an existing folder."""
    df.write.mode("append" if append else "errorifexists").text(path)


def write_read(df: DataFrame, path: str, fmt: str, keep_types: bool = True) -> DataFrame:
    """Write ``df`` as ``orc``, ``parquet``, ``json`` or ``csv`` and read it back.

    ``keep_types=False`` with CSV writes no header and reads plain strings named ``_c0``, ``_c1``…
    """
    spark = df.sparkSession
    if fmt == "csv":
        if not keep_types:
            df.write.csv(path)
            return spark.read.csv(path)
        write_csv(df, path)
        return read_table(spark, path, df.schema)
    df.write.format(fmt).save(path)
    reader = spark.read.schema(df.schema) if fmt == "json" else spark.read
    return reader.format(fmt).load(path)


def read_safe(
    spark: SparkSession, path: str, schema: T.StructType | str, fmt: str = "csv", **options: object
) -> tuple[DataFrame, str]:
    """Read ``path``; an absent path or a file without rows gives an empty table and says so.

    The status is ``ok``, ``missing`` or ``empty``.
    """
    declared = as_struct(schema)
    try:
        df = spark.read.schema(declared).options(**options).format(fmt).load(path)
    except AnalysisException as err:
        if err.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], declared), "missing"
    return df, "empty" if df.isEmpty() else "ok"


def describe_schema(df: DataFrame) -> DataFrame:
    """The schema as a table: ``position, column, type, nullable``."""
    rows = [(i, f.name, f.dataType.simpleString(), f.nullable) for i, f in enumerate(df.schema.fields)]
    return df.sparkSession.createDataFrame(rows, "position int, column string, type string, nullable boolean")


def show_rows(df: DataFrame, n: int = 20) -> DataFrame:
    """At most ``n`` rows for display."""
    return df.limit(n)

"""Catalogue tables and relational databases."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def save_table(df: DataFrame, name: str, mode: str = "errorifexists", path: str | None = None) -> DataFrame:
    """Store ``df`` as a catalogue table and return the table; ``path`` chooses where its files lie."""
    writer = df.write.mode(mode)
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(name)
    return df.sparkSession.table(name)


def append_table(df: DataFrame, name: str) -> None:
    """Add rows to a catalogue table; columns are matched by name."""
    df.write.mode("append").saveAsTable(name)


def list_tables(spark: SparkSession, database: str | None = None) -> DataFrame:
    """``name, is_temporary`` of every table in the catalogue."""
    shown = spark.sql(f"SHOW TABLES IN {database}" if database else "SHOW TABLES")
    return shown.selectExpr("tableName AS name", "isTemporary AS is_temporary")


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    part_col: str | None = None,
    bounds: tuple[int, int] | None = None,
    parts: int = 8,
    **properties: str,
) -> DataFrame:
    """Read a relational table; with ``part_col`` and ``bounds`` it is read by ``parts`` tasks."""
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table).options(**properties)
    if part_col is not None:
        if bounds is None:
            raise ValueError("bounds are needed to split the read on a column")
        reader = reader.options(
            partitionColumn=part_col, lowerBound=bounds[0], upperBound=bounds[1], numPartitions=parts
        )
    return reader.load()


def write_jdbc(df: DataFrame, url: str, table: str, mode: str = "append", **properties: str) -> None:
    """Create the relational table if needed and add the rows."""
    df.write.format("jdbc").option("url", url).option("dbtable", table).options(**properties).mode(mode).save()

"""Session helpers: the shared scratch folder and lineage cuts."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_root(spark: SparkSession) -> str:
    """Folder for scratch tables and stream checkpoints, as named by ``spark.checkpoint.dir``.

    Where that is unset, as in tests, a folder in the warehouse, which all executors can reach as well.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    if not root:
        root = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/tallyloom-scratch"
    return root


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder; nothing exists there yet."""
    return f"{shared_root(spark).rstrip('/')}/tallyloom-{uuid.uuid4().hex}/{name}"


# Rows of a file where a row holds long arrays: the vectorized reader takes up to 4096 rows of a file at once, whatever they hold.
LONG_ROWS = 32


def cut_lineage(df: DataFrame, spread: bool = False, long_rows: bool = False) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back.

    Lost executors cost no rerun of what came before, both sides of a self-join see the same rows, and the
    next plan starts from a file scan with known sizes. (The plan of a ``checkpoint()`` keeps the inferred
    constraints of its input, which grow with every round of a loop.)

    ``spread`` deals the rows out evenly, for tables that are small in bytes but costly to compute on. ``long_rows`` writes
    few rows to a file, for rows that hold whole blocks as arrays, so that a task does not read all of a file's into memory.
    """
    spark = df.sparkSession
    if spread:
        parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
        df = df.repartition(parts, *[c for c in df.columns if not df.schema[c].dataType.simpleString().startswith("map")])
    path = scratch_path(spark, "step")
    df.write.option("compression", "zstd").option("maxRecordsPerFile", LONG_ROWS if long_rows else 0).parquet(path)
    return spark.read.schema(df.schema).parquet(path)

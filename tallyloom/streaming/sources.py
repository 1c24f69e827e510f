"""Stream sources and how to run a stream to its end."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter
from pyspark.sql.types import StructType

BatchFn = Callable[[DataFrame, int], None]


def stream_table(spark: SparkSession, path: str, schema: StructType, max_files: int | None = None) -> DataFrame:
    """A Parquet table as a stream; ``max_files`` bounds how many files one micro-batch takes."""
    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(path)


def stream_lines(
    spark: SparkSession, path: str, max_files: int | None = None, archive: str | None = None, with_file: bool = False
) -> DataFrame:
    """New text files of a folder as a stream of lines.

    ``archive`` names a folder finished files are moved to. A file name is taken once: a file written again
    under a name already seen is not read again, so every upload needs a name of its own.
    """
    reader = spark.readStream
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if archive:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    lines = reader.text(path)
    return lines.select("value", F.col("_metadata.file_path").alias("file")) if with_file else lines


def task_stream(spark: SparkSession, n: int | None = None, per_second: int = 1) -> DataFrame:
    """Numbered messages ``Task #i`` at a steady rate, the first ``n`` of them if asked."""
    ticks = spark.readStream.format("rate").option("rowsPerSecond", per_second).load()
    if n is not None:
        ticks = ticks.where(F.col("value") < n)
    return ticks.select(F.col("value").alias("id"), F.concat(F.lit("Task #"), F.col("value").cast("string")).alias("message"))


def run_available(writer: DataStreamWriter, checkpoint: str, timeout: int | None = None) -> bool:
    """Process everything there is, in as many micro-batches as the source bounds ask for, then stop.

    Progress lies in the checkpoint folder, so a second run goes on where the first ended. False on timeout.
    """
    running = writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    if timeout is None:
        running.awaitTermination()
        return True
    done = running.awaitTermination(timeout)
    if not done:
        running.stop()
    return bool(done)


def watch_folder(
    spark: SparkSession,
    path: str,
    process: BatchFn,
    checkpoint: str,
    archive: str | None = None,
    max_files: int | None = None,
    timeout: int | None = None,
) -> bool:
    """Hand every new text file of a folder to ``process(lines, batch_id)`` once; lines carry their file.

    After a failure a batch may be handed over again under the same id, so ``process`` should write to a place
    named by that id.
    """
    lines = stream_lines(spark, path, max_files, archive, with_file=True)
    return run_available(lines.writeStream.foreachBatch(process), checkpoint, timeout)

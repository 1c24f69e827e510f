"""Message consumers with exactly-once tables and a place for bad messages."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import StructType

from tallyloom.streaming.sources import run_available


def write_batch(df: DataFrame, path: str, batch_id: int) -> None:
    """Store the rows of one micro-batch; a repeated batch replaces its first try."""
    df.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")


def read_batches(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """All stored rows with their ``batch`` number."""
    return spark.read.schema(f"{schema}, batch long").parquet(path)


def consume(
    stream: DataFrame,
    work: Callable[[DataFrame], DataFrame],
    out: str,
    checkpoint: str,
    good: Column | None = None,
    dead_letter: str | None = None,
    timeout: int | None = None,
) -> bool:
    """Apply ``work`` to each micro-batch and store the result; a batch counts as done once it is stored.

    Rows for which ``good`` does not hold are set aside in ``dead_letter`` and the stream goes on. The batch
    bound of the source (``max_files``) says how much is taken at a time; both parts read it from there.
    """
    if dead_letter is not None and good is None:
        raise ValueError("a dead-letter folder needs a test for good rows")

    def take(batch: DataFrame, batch_id: int) -> None:
        if good is None:
            write_batch(work(batch), out, batch_id)
            return
        fine = F.coalesce(good, F.lit(False))
        write_batch(work(batch.where(fine)), out, batch_id)
        if dead_letter is not None:
            write_batch(batch.where(~fine), dead_letter, batch_id)

    return run_available(stream.writeStream.foreachBatch(take), checkpoint, timeout)


def work_each(df: DataFrame, work: Callable[[dict], object], kind: str) -> DataFrame:
    """Adds ``result`` (of the Spark type ``kind``) and ``error``: ``work`` on each row as a dictionary.

    A row whose work raises, or gives what is no ``kind``, has no result, and the error as text; the other rows go on.
    """
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)
    names = df.columns
    to = pa.field("result", to_arrow_type(StructType.fromDDL(f"result {kind}")["result"].dataType))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            results, errors = [], []
            for row in batch.to_pylist():
                value, error = None, None
                try:
                    value = work(row)
                    pa.array([value], to.type)
                except Exception as problem:  # whatever the work raises belongs to its message
                    value, error = None, f"{type(problem).__name__}: {problem}"
                results.append(value)
                errors.append(error)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(results, to.type), pa.array(errors, pa.string())], [*names, "result", "error"])

    return df.mapInArrow(run, f"{fields}, result {kind}, error string")


def consume_each(stream: DataFrame, work: Callable[[dict], object], kind: str, out: str, checkpoint: str, timeout: int | None = None) -> bool:
    """``work_each`` on every message of a stream. A micro-batch is worked on once and stored once, by whether it failed, so
    a batch that is repeated after a crash replaces its first try as a whole."""

    def take(batch: DataFrame, batch_id: int) -> None:
        done = work_each(batch, work, kind).withColumn("failed", F.col("error").isNotNull())
        done.write.mode("overwrite").partitionBy("failed").parquet(f"{out}/batch={batch_id}")

    return run_available(stream.writeStream.foreachBatch(take), checkpoint, timeout)


def worked(spark: SparkSession, out: str, schema: str, kind: str, failed: bool) -> DataFrame:
    """The messages with their ``result``, or those set aside with their ``error``."""
    rows = spark.read.schema(f"{schema}, result {kind}, error string, batch long, failed boolean").parquet(out)
    return rows.where(F.col("failed") == failed).drop("failed", "error" if not failed else "result")


def run_updates(
    counts: DataFrame, out: str, checkpoint: str, schema: str, keys: list[str], timeout: int | None = None, every: int = 10
) -> bool:
    """Run a streaming aggregation; each micro-batch stores only the groups it changed.

    Every so many batches the changes since the last snapshot are folded into a new one, so what is read, then or in the end, does
    not grow with the number of batches.
    """

    def take(changed: DataFrame, batch_id: int) -> None:
        write_batch(changed, out, batch_id)
        if batch_id % every == every - 1:
            spark = changed.sparkSession
            folded = _folded(spark, out, schema, keys, batch_id, every)
            folded.write.mode("overwrite").parquet(f"{out}-snapshots/at={batch_id}")

    return run_available(counts.writeStream.outputMode("update").foreachBatch(take), checkpoint, timeout)


def _existing(read: Callable[[], DataFrame]) -> DataFrame | None:
    try:
        return read()
    except AnalysisException as problem:
        if problem.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def _folded(spark: SparkSession, out: str, schema: str, keys: list[str], upto: int, every: int) -> DataFrame:
    """The state of every group after batch ``upto``: the snapshot before it and the changes since. Paths are named, not
    searched, so older ones are not read."""
    last = upto // every * every - 1
    parts = []
    if last >= 0:
        parts.append(spark.read.schema(schema).parquet(f"{out}-snapshots/at={last}").withColumn("batch", F.lit(last).cast("long")))
    for batch in range(last + 1, upto + 1):
        if (rows := _existing(lambda b=batch: spark.read.schema(schema).parquet(f"{out}/batch={b}"))) is not None:
            parts.append(rows.withColumn("batch", F.lit(batch).cast("long")))
    rows = reduce(DataFrame.unionByName, parts) if parts else spark.createDataFrame([], f"{schema}, batch long")
    rest = [c for c in rows.columns if c not in (*keys, "batch")]
    return rows.groupBy(*keys).agg(F.max_by(F.struct(*rest), "batch").alias("_s")).select(*keys, "_s.*")


def latest(spark: SparkSession, out: str, schema: str, keys: list[str], every: int = 10) -> DataFrame:
    """The last stored state of every group; ``every`` as it was given to ``run_updates``."""
    stored = _existing(lambda: read_batches(spark, out, schema))
    # Batch numbers are known from folder names.
    last = stored.agg(F.max("batch")).first()[0] if stored is not None else None
    if last is None:
        return spark.createDataFrame([], schema)
    return _folded(spark, out, schema, keys, last, every)

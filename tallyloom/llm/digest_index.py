"""Exact dedup by a persistent index of digests, bucketed and sorted by digest.

The index is a table of all texts seen so far, one row per text. New data is reduced to one row per digest first, then
anti-joined with the index by a sort-merge join that moves no row of the index, and what is new is appended in the same
buckets. Rows whose text is known already are copies, whichever arrival brought it.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.session import cut_lineage, scratch_path

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def text_digest(text: str | Column = "text") -> Column:
    """SHA-256 (32 bytes) of a text with A-Z lower-cased; null counts as empty."""
    known = F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))
    return F.unhex(F.sha2(F.translate(known, _UPPER, _LOWER), 256))


@dataclass(frozen=True)
class DigestIndex:
    """The table ``digest, doc_id, row``: of each text the row that stays.

    ``folder`` is a shared place that outlives the session; ``opened`` makes the table known to a new one. An append that
    is run again after a failure finds its own digests and adds nothing.
    """

    spark: SparkSession
    name: str
    buckets: int

    @classmethod
    def opened(cls, spark: SparkSession, folder: str, buckets: int) -> DigestIndex:
        """The index stored in ``folder``, empty if there is none. ``buckets`` must be that of its first use."""
        name = f"digests_{uuid.uuid4().hex}"
        spark.sql(
            f"CREATE TABLE {name} (digest BINARY, doc_id BIGINT, row BIGINT) USING parquet "
            f"CLUSTERED BY (digest) SORTED BY (digest) INTO {int(buckets)} BUCKETS LOCATION '{folder}'"
        )
        return cls(spark, name, buckets)

    def rows(self) -> DataFrame:
        return self.spark.table(self.name)

    def unseen(self, firsts: DataFrame) -> DataFrame:
        """The rows of ``firsts`` (one per digest) whose digest the index lacks.

        They are written first: otherwise the optimizer moves the join below the aggregate that made them, and all copies of
        a text meet in one task.
        """
        dealt = cut_lineage(firsts).repartition(self.buckets, "digest")
        return dealt.hint("merge").join(self.rows().select("digest").hint("merge"), "digest", "left_anti")

    def append(self, marked: DataFrame) -> None:
        """Add the new texts of ``marked`` (``digest, doc_id, row``): of each the row with the largest ``doc_id``.

        Nulls are smaller than any id; of rows with the same id one stays. Copies meet as partial maxima.
        """
        largest = F.coalesce(F.max_by("row", "doc_id"), F.max("row")).alias("row")
        firsts = marked.groupBy("digest").agg(F.max("doc_id").alias("doc_id"), largest)
        new = self.unseen(firsts).select("digest", "doc_id", "row")
        writer = new.write.bucketBy(self.buckets, "digest").sortBy("digest").format("parquet").mode("append")
        writer.saveAsTable(self.name)
        self.spark.catalog.refreshTable(self.name)

    def close(self) -> None:
        """Forget the table; its files stay."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")


def marked_rows(docs: DataFrame, keep: list[str]) -> DataFrame:
    """``keep``, ``digest`` and ``row`` (a number of its own for each row), written, so that numbers last."""
    taken = docs.select(*keep, text_digest().alias("digest"), F.monotonically_increasing_id().alias("row"))
    return cut_lineage(taken)


def dedup_newest_first(docs: DataFrame, buckets: int | None = None, folder: str | None = None) -> DataFrame:
    """``doc_id, keep_id, group_size, kept, digest`` for each row of ``docs``.

    Texts are equal when identical after lower-casing A-Z; null counts as empty. Of equal texts the row with the largest
    ``doc_id`` stays (null is smallest; of rows with one id, one stays), ``keep_id`` is its id and ``group_size`` counts
    the rows. The rows arrive at the index in two parts, larger ids first, so that the rows of the second part are copies
    wherever the index knows their text. An empty table gives no rows; other columns of any name do no harm.
    """
    spark = docs.sparkSession
    marked = marked_rows(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("text")), ["doc_id"])
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    index = DigestIndex.opened(spark, folder or scratch_path(spark, "digests"), buckets)
    try:
        # One row with the ends of the ids.
        middle = marked.agg(((F.min("doc_id") / 2) + (F.max("doc_id") / 2)).cast("long").alias("m")).first()["m"]
        late = F.coalesce(F.col("doc_id") < F.lit(middle), F.lit(True)) if middle is not None else F.lit(False)
        index.append(marked.where(~late))
        index.append(marked.where(late))
        sizes = marked.groupBy("digest").agg(F.count("*").alias("group_size"))
        stays = index.rows().select("digest", F.col("doc_id").alias("keep_id"), F.col("row").alias("keep_row"))
        # Read from a table without buckets, so that the rows of a text that a third of the documents share can be dealt out.
        groups = cut_lineage(stays.join(sizes, "digest"))
    finally:
        index.close()
    kept = (F.col("row") == F.col("keep_row")).alias("kept")
    return marked.join(groups, "digest").select("doc_id", "keep_id", "group_size", kept, "digest")


def drop_copies(docs: DataFrame, index: DigestIndex) -> DataFrame:
    """The rows of ``docs`` whose text the index did not know, one of each; the index knows them from now on. Same columns.

    Rows are dealt by digest; of equal texts the row with the largest ``doc_id`` stays.
    """
    marked = marked_rows(docs.select(F.struct("*").alias("doc"), F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("text")), ["doc", "doc_id"])
    largest = F.coalesce(F.max_by("row", "doc_id"), F.max("row")).alias("row")
    firsts = marked.groupBy("digest").agg(F.max("doc_id").alias("doc_id"), largest)
    new = cut_lineage(index.unseen(firsts).select("digest", "doc_id", "row"))
    index.append(new)
    return marked.join(new.select("row"), "row", "left_semi").select("doc.*")

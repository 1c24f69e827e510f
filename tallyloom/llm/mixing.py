"""Mixing sources to target weights.

Words are summed per source, targets follow from the weights, and each document is emitted floor(rate) times
plus one more time with the probability of the fraction, decided by a hash of the document.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.texts import word_count
from tallyloom.operators.order import enumerate_rows
from tallyloom.session import cut_lineage


def source_targets(
    sizes: DataFrame, weights: Sequence[float] = (3, 1, 2), share: float = 1.5, cap: float = 2.0
) -> DataFrame:
    """``source, source_size, target`` for a table ``source, size``.

    Sources in code point order, null last, get ``weights`` in turn and divide ``share`` times all sizes. A target
    stops at ``cap`` times the size of its source; what is over goes to the others by weight until none is above.
    The result has one row per source; the rounds below read only that table and keep two sums on the driver.
    A source without words has target 0.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    turn = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("position") % len(weights) + 1).cast("int"))
    table = cut_lineage(
        enumerate_rows(per, F.col("source").asc_nulls_last()).select(
            "source", "source_size", turn.alias("weight"), (F.col("source_size") * F.lit(float(cap))).alias("most")
        )
    )
    whole = table.agg(F.sum("source_size").alias("size"), F.sum("weight").alias("weight")).first()
    budget = share * (whole["size"] or 0)
    level, full = (budget / whole["weight"] if whole["weight"] else 0.0), -1
    while True:
        above = F.col("most") <= F.col("weight") * F.lit(level)
        now = table.agg(
            F.coalesce(F.sum(F.when(above, F.col("most"))), F.lit(0.0)).alias("used"),
            F.coalesce(F.sum(F.when(~above, F.col("weight"))), F.lit(0.0)).alias("free"),
            F.count_if(above).alias("full"),
        ).first()
        if now["full"] == full or not now["free"]:
            break
        level, full = (budget - now["used"]) / now["free"], now["full"]
    target = F.when(F.col("most") <= F.col("weight") * F.lit(level), F.col("most")).otherwise(F.col("weight") * F.lit(level))
    return table.select("source", "source_size", target.alias("target"))


def draw(seed: int, *parts: Column) -> Column:
    """A number in [0, 1) from 48 bits of an MD5 hash, the same in any engine."""
    key = F.concat_ws(":", F.lit(str(seed)), *[F.coalesce(p.cast("string"), F.lit("")) for p in parts])
    return F.conv(F.substring(F.md5(key), 1, 12), 16, 10).cast("double") / F.lit(float(1 << 48))


def mixing_plan(
    docs: DataFrame, weights: Sequence[float] = (3, 1, 2), share: float = 1.5, cap: float = 2.0, seed: int = 42
) -> DataFrame:
    """``doc, size, source_size, target, copies``: for each row of ``docs`` how often the mix takes it.

    ``doc`` holds all columns of the row, so that their names are free. ``copies`` is floor(rate) or one more, rate
    being target over source size, at most ``cap``. The extra copy is drawn by seed, ``doc_id`` and text: reruns and
    other partitionings agree, and rows that are equal in both get the same number. Null texts have size 0.
    """
    sized = docs.select(F.struct("*").alias("doc"), F.col("source").alias("source"), word_count("text").alias("size"))
    targets = source_targets(sized, weights, share, cap)
    # The one-row-per-source table is broadcast if it is small, by its file size; a hot source is no skew then, and
    # beyond that size adaptive execution splits its share of the rows.
    joined = sized.join(targets.withColumnRenamed("source", "of"), F.col("source").eqNullSafe(F.col("of")))
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    extra = draw(seed, F.col("doc.doc_id"), F.col("doc.text")) < rate - F.floor(rate)
    return joined.select("doc", "size", "source_size", "target", (F.floor(rate) + extra.cast("long")).alias("copies"))


def mix_sources(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs``, each as often as the mix takes it; same columns. See ``mixing_plan``."""
    plan = mixing_plan(docs, **options).where("copies > 0")
    return plan.select("doc", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select("doc.*")

"""Benchmark decontamination by spaced seeds, in DataFrame operations only.

Fixed masks choose some of the words below them and ignore the others, so that a hit survives substituted words. Hashes of
the chosen words are joined between benchmark and documents; each hit names a diagonal (document position minus benchmark
position) along which the words are then compared.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.session import cut_lineage

# 1: the word counts, 0: any word. Different gaps, so that two substitutions seldom spoil both.
MASKS = ("11101011", "1101000111")
# Benchmark seeds up to this number (16 bytes each) are sent to every task; beyond, both sides are shuffled.
BROADCAST_SEEDS = 1_000_000


def _words(text: Column) -> Column:
    """Lower-cased runs of letters and digits; null has none."""
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def _keys(text: Column) -> list[Column]:
    """Two hashes that tell texts apart."""
    return [F.xxhash64(text).alias("_k1"), F.xxhash64(F.lit(1), text).alias("_k2")]


def _needed(width: int, agree: float) -> int:
    """Of so many words this number must agree."""
    return math.ceil(width * agree - 1e-9)


def short_masks(n: int, agree: float) -> list[str]:
    """Masks for an item of ``n`` words that is compared as a whole: any substitutions that are allowed leave one of them intact.

    The item is cut into two blocks more than the substitutions allowed; a mask takes two of the blocks. No mask begins or
    ends with a word it ignores, as that one may lie outside of the document.
    """
    free = n - _needed(n, agree)
    if not free:
        return ["1" * n]
    count = min(free + 2, n)
    block = [i * count // n for i in range(n)]
    chosen = combinations(range(count), count - free)
    return sorted({"".join("01"[b in two] for b in block).strip("0") for two in chosen})


def _seeds(codes: Column, masks: Sequence[str]) -> Column:
    """For each position and mask that fits: a struct of position and hash."""
    def of(mask: str) -> Column:
        chosen = [i for i, c in enumerate(mask) if c == "1"]
        places = F.when(F.size(codes) >= len(mask), F.sequence(F.lit(0), F.size(codes) - len(mask))).otherwise(F.array().cast("array<int>"))
        return F.transform(
            places, lambda p: F.struct(p.alias("at"), F.xxhash64(F.lit(mask), *[F.get(codes, p + i) for i in chosen]).alias("seed"))
        )

    return F.concat(*[of(mask) for mask in masks])


def overlaps(
    docs: DataFrame, benchmark: DataFrame, window: int = 13, agree: float = 0.8, masks: Sequence[str] = MASKS
) -> DataFrame:
    """``doc_id, item_id, n_words`` and the text hashes ``_k1, _k2``: benchmark items found in documents.

    Found means: along one diagonal, some ``window`` neighbouring words of the item (all words of a shorter item) agree in at
    least the share ``agree`` with the document; ``n_words`` is the largest number of words that agree along one diagonal.
    Items of ``window`` words or more are found by ``masks``, shorter ones by ``short_masks`` of their length, so an item of up to
    four words is found where all of its words follow each other. Items without a word are not looked for; an item without an id
    is found as any other. A row of ``docs`` gives a row for each item; rows that
    are equal in id and text give one.
    """
    item = cut_lineage(
        benchmark.select(F.col("item_id").alias("item_id"), F.transform(_words(F.col("text")), lambda w: F.xxhash64(w)).alias("item"))
        .where(F.size("item") > 0)
        .dropDuplicates()
        # Ids may be null or stand for several texts: hits are joined by a key of their own.
        .withColumn("_item", F.xxhash64(F.col("item_id").isNull(), "item_id", "item"))
    )
    # At most ``window`` - 1 numbers; documents get seeds only for the lengths there are.
    lengths = item.select(F.size("item").alias("n")).where(F.col("n") < window).distinct().collect()
    short = {r["n"]: short_masks(r["n"], agree) for r in lengths}
    own = _seeds(F.col("item"), masks)
    for n, some in short.items():
        own = F.when(F.size("item") == n, _seeds(F.col("item"), some)).otherwise(own)
    every = sorted({*masks, *(mask for some in short.values() for mask in some)})
    probes = cut_lineage(
        item.select("_item", F.explode(own).alias("s")).select("_item", F.col("s.at").alias("item_at"), F.col("s.seed").alias("seed"))
    )
    if probes.count() <= BROADCAST_SEEDS:
        probes = F.broadcast(probes)
    texts = docs.select("doc_id", F.col("text").alias("text"), *_keys(F.col("text")))
    coded = texts.select("_k1", "_k2", F.transform(_words(F.col("text")), lambda w: F.xxhash64(w)).alias("codes"))
    found = coded.select("_k1", "_k2", F.explode(_seeds(F.col("codes"), every)).alias("s")).select(
        "_k1", "_k2", F.col("s.at").alias("at"), F.col("s.seed").alias("seed")
    )
    # One row for each diagonal, however many seeds hit it and however many copies a text has.
    hits = cut_lineage(
        found.join(probes, "seed").select("_k1", "_k2", "_item", (F.col("at") - F.col("item_at")).alias("shift")).distinct()
    )
    beside = texts.join(hits, ["_k1", "_k2"]).select(
        "doc_id", "_k1", "_k2", "_item", "shift", F.transform(_words(F.col("text")), lambda w: F.xxhash64(w)).alias("codes")
    )
    same = F.transform(
        F.col("item"), lambda w, i: F.when((F.col("shift") + i >= 0) & (F.get("codes", F.col("shift") + i) == w), 1).otherwise(0)
    )
    checked = beside.join(item, "_item").select("doc_id", "_k1", "_k2", "item_id", same.alias("same"))
    width = F.least(F.lit(window), F.size("same"))
    enough = F.exists(
        F.sequence(F.lit(1), F.size("same") - width + 1),
        lambda s: F.aggregate(F.slice("same", s, width), F.lit(0), lambda a, x: a + x) >= F.ceil(width * F.lit(agree) - 1e-9),
    )
    total = F.aggregate("same", F.lit(0), lambda a, x: a + x).cast("long")
    return checked.where(enough).groupBy("doc_id", "_k1", "_k2", "item_id").agg(F.max(total).alias("n_words"))


def decontaminate(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` in whose text no benchmark item is found; same columns. See ``overlaps``."""
    bad = cut_lineage(overlaps(docs, benchmark, **options).select("_k1", "_k2").distinct())
    k1, k2 = _keys(F.col("doc.text"))
    keyed = docs.select(F.struct("*").alias("doc")).select("doc", k1, k2)
    return keyed.join(bad, ["_k1", "_k2"], "left_anti").select("doc.*")

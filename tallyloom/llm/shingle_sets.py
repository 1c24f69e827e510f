"""Links between sets of word shingles, checked exactly.

A proposed link is kept only if the two sets have a similarity (intersection by union) of at least ``SIMILARITY``. Sets that
are joined by kept links form parts; within a proposed component all pairs of sets of different parts are then compared, block
by block, so that a link that was not proposed itself, or stood behind a refuted one, is not lost.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.texts import words_of
from tallyloom.operators.components import components
from tallyloom.session import cut_lineage

SIMILARITY = 0.8
# A set of up to so many shingles can only be similar to a set that holds it whole and at most two more.
SHORT = 8
# Sets of a block.
BLOCK = 128


def shingle_set(text: str | None, shingle: int, seed: int) -> np.ndarray:
    """The different hashes (XXH64) of the shingles of a text, ascending; fewer words than ``shingle``: one of all of them."""
    words = words_of(text)
    if not words:
        return np.empty(0, "u8")
    k = min(shingle, len(words))
    join, digest = b" ".join, xxhash.xxh64_intdigest
    return np.unique(np.array([digest(join(words[i : i + k]), seed) for i in range(len(words) - k + 1)], "u8"))


def name_of(hashes: np.ndarray) -> bytes:
    """Tells sets apart: 128 bits."""
    return xxhash.xxh3_128_digest(hashes.astype("<u8").tobytes())


def signatures(hashes: np.ndarray) -> tuple[int | None, list[int]]:
    """The signature of a set of 4 to ``SHORT`` shingles, and those of the subsets of that size it may be similar to.

    Sets of up to 3 shingles are similar to themselves only. One more shingle keeps 0.8 from 4 on, two more from 8 on.
    """
    n, h = len(hashes), hashes.view("i8").tolist()
    total = 0
    for x in h:
        total ^= x
    less = [total ^ x for x in h] if 5 <= n <= SHORT + 1 else []
    if n == SHORT + 2:
        less = [total ^ x ^ y for x, y in combinations(h, 2)]
    return (total if 4 <= n <= SHORT else None), less


def similar(shared: np.ndarray, a: int, b: np.ndarray) -> np.ndarray:
    """Whether sets of sizes ``a`` and ``b`` with so many shared shingles reach ``SIMILARITY``."""
    return shared >= SIMILARITY * (a + b - shared) - 1e-9


def _sets(texts: DataFrame, shingle: int, seed: int) -> DataFrame:
    """``key, hashes`` of a table ``key, text``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sets = [shingle_set(t, shingle, seed).view("i8") for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(sets, pa.list_(pa.int64()))], ["key", "hashes"])

    return texts.select("key", "text").mapInArrow(run, "key binary, hashes array<bigint>")


def links_of_blocks(sets: list[np.ndarray], parts: np.ndarray, first: int, same: bool) -> Iterator[tuple[int, int]]:
    """Similar pairs of different parts: of the first ``first`` sets with the others, or of all sets if ``same``.

    Links that would join what others have joined already are left out.
    """
    low = 0 if same else first
    sizes = np.array([len(s) for s in sets])
    owners = np.repeat(np.arange(len(sets))[low:], sizes[low:])
    held = np.concatenate(sets[low:])
    order = np.argsort(held, kind="stable")
    held, owners = held[order], owners[order]
    label = np.unique(parts, return_inverse=True)[1]
    for i in range(len(sets) if same else first):
        if (label[low:] == label[i]).all():
            continue
        starts, ends = np.searchsorted(held, sets[i], "left"), np.searchsorted(held, sets[i], "right")
        some = ends > starts
        if not some.any():
            continue
        shared = np.bincount(np.concatenate([owners[s:e] for s, e in zip(starts[some], ends[some])]), minlength=len(sets))
        near = np.flatnonzero((shared > 0) & (label != label[i]) & similar(shared, int(sizes[i]), sizes))
        for j in near:
            if label[j] != label[i]:
                yield i, int(j)
                label[label == label[j]] = label[i]


def _between_parts(sets: DataFrame, places: DataFrame, block: int) -> DataFrame:
    """``u, v``: links between different parts of one proposed component. ``places``: ``key, whole, part``."""
    sizes = places.groupBy("whole", "part").agg(F.count("*").alias("n"))
    # A large part has blocks of its own, which are not compared with each other; a small part lies in one of the mixed blocks.
    large = F.col("n") >= block
    sizes = cut_lineage(sizes)
    mixed = sizes.where(~large).groupBy("whole").agg(F.sum("n").alias("rest"))
    open_wholes = sizes.groupBy("whole").agg(F.count("*").alias("parts")).where("parts > 1").select("whole")
    of = lambda n: F.ceil(F.col(n) / block).cast("int")
    plan = cut_lineage(sizes.join(open_wholes, "whole").join(mixed, "whole", "left"))
    at = F.when(large, F.pmod(F.xxhash64("key"), of("n"))).otherwise(F.pmod(F.xxhash64("part"), of("rest"))).cast("int")
    own = F.when(large, F.col("part"))
    placed = cut_lineage(places.join(plan, ["whole", "part"]).select("key", "whole", "part", own.alias("own"), at.alias("at")))
    name = F.xxhash64("whole", F.hex("own"), "at")
    row = F.struct("key", "part", "hashes")
    packed = cut_lineage(
        placed.withColumn("block", name).join(sets, "key").groupBy("whole", "own", "at", "block").agg(F.collect_list(row).alias("rows"))
    )
    heads = cut_lineage(packed.select("whole", "own", "at", "block"))
    a, b = (heads.select("whole", *[F.col(c).alias(f"{s}_{c}") for c in ("own", "at", "block")]) for s in "ab")
    apart = F.coalesce(F.col("a_own") != F.col("b_own"), F.lit(True)) & (F.col("a_block") <= F.col("b_block"))
    # A mixed block is also compared with itself; a block of one part is not.
    pairs = cut_lineage(a.join(b, "whole").where(apart).select("a_block", "b_block"))
    joined = pairs.join(packed.select(F.col("block").alias("a_block"), F.col("rows").alias("a")), "a_block")
    joined = joined.join(packed.select(F.col("block").alias("b_block"), F.col("rows").alias("b")), "b_block")

    def compare(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for p in frame.itertuples():
                same = p.a_block == p.b_block
                rows = list(p.a) if same else [*p.a, *p.b]
                sets = [np.asarray(r["hashes"], "i8") for r in rows]
                parts = np.array([bytes(r["part"]).hex() for r in rows])
                out = list(links_of_blocks(sets, parts, len(p.a), same))
                if out:
                    yield pd.DataFrame({c: [bytes(rows[k[n]]["key"]) for k in out] for n, c in enumerate("uv")})

    return joined.repartition("a_block", "b_block").mapInPandas(compare, "u binary, v binary")


def verified_components(proposed: DataFrame, texts: DataFrame, shingle: int, seed: int, block: int = BLOCK) -> DataFrame:
    """``node, component``: classes of similar sets among those that ``proposed`` (``u, v``: names of sets) joins.

    ``texts``: ``key, text`` with at least one text of each set. Sets that are similar to no other may be left out.
    """
    proposed = cut_lineage(proposed.where("u <> v").distinct())
    wanted = cut_lineage(proposed.select(F.explode(F.array("u", "v")).alias("key")).distinct())
    some = cut_lineage(texts.join(wanted, "key", "left_semi").groupBy("key").agg(F.first("text").alias("text")))
    sets = cut_lineage(_sets(some, shingle, seed))
    sides = {c: sets.select(F.col("key").alias(c), F.col("hashes").alias(f"{c}_set")) for c in "uv"}
    shared, a, b = F.size(F.array_intersect("u_set", "v_set")), F.size("u_set"), F.size("v_set")
    met = proposed.join(sides["u"], "u").join(sides["v"], "v").withColumns({"shared": shared, "a": a, "b": b})
    kept = cut_lineage(met.where(F.expr(f"shared >= {SIMILARITY}D * (a + b - shared) - 1e-9D")).select("u", "v"))
    part = components(kept).select(F.col("node").alias("key"), F.col("component").alias("part"))
    whole = components(proposed).select(F.col("node").alias("key"), F.col("component").alias("whole"))
    places = cut_lineage(whole.join(part, "key", "left").select("key", "whole", F.coalesce("part", "key").alias("part")))
    more = cut_lineage(_between_parts(sets, places, block))
    return components(kept.unionByName(more))

"""SimHash near-duplicates by tiled exact comparison.

Different fingerprints are ordered by population count and cut into tiles. A difference of d bits needs population counts
at most d apart, so tile pairs further apart are never formed; the others are compared in full with numpy exclusive-or and
bit counts. A tile pair gives a forest of its links, never all pairs of a group; classes are the connected components.

Where near duplicates are dropped, the links are proposals only: see ``drop_near_duplicates``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallyloom.llm.shingle_sets import SHORT, name_of, shingle_set, signatures, verified_components
from tallyloom.llm.texts import words_of
from tallyloom.operators.components import components
from tallyloom.operators.order import enumerate_rows
from tallyloom.session import cut_lineage

TILE = 8192
# Rows of a tile compared at a time: 256 x 8192 words of 8 bytes.
STRIP = 256
# Odd multipliers that derive further hash words from the first one.
_STEP = np.uint64(0x9E3779B97F4A7C15)


def _spread(h: np.ndarray, words: int) -> np.ndarray:
    """``words`` 64-bit hashes for each hash in ``h``; the first is the hash itself."""
    out = np.empty((len(h), words), "<u8")
    out[:, 0] = h
    for i in range(1, words):
        x = h + np.uint64((int(_STEP) * i) & (1 << 64) - 1)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        out[:, i] = x ^ (x >> np.uint64(31))
    return out


def _votes(hashes: np.ndarray, bits: int) -> np.ndarray:
    """For each bit the number of hashes that set it."""
    wide = _spread(hashes, bits // 64).view("u1").reshape(len(hashes), bits // 8)
    return np.unpackbits(wide, axis=1, bitorder="little").sum(axis=0, dtype="i8")


def fingerprint(text: str | None, shingle: int = 3, seed: int = 42, bits: int = 64, strip: int = 16_384) -> bytes:
    """The fingerprint of a text, little-endian.

    Shingles of ``shingle`` words (repeats included, joined by spaces; fewer words: all of them) are hashed with XXH64; a bit
    is 1 if it is set in over half the hashes. Beyond 64 bits, further words are derived from each hash. A text without words,
    or null, has the fingerprint zero. Long texts are summed in strips.
    """
    words = words_of(text)
    size = bits // 8
    if not words:
        return bytes(size)
    k = min(shingle, len(words))
    n = len(words) - k + 1
    join, digest = b" ".join, xxhash.xxh64_intdigest
    counts = np.zeros(bits, "i8")
    for lo in range(0, n, strip):
        hashes = [digest(join(words[i : i + k]), seed) for i in range(lo, min(lo + strip, n))]
        counts += _votes(np.array(hashes, "u8"), bits)
    return np.packbits(counts * 2 > n, bitorder="little").tobytes()


def fingerprints(docs: DataFrame, keep: list[str], shingle: int = 3, seed: int = 42, bits: int = 64) -> DataFrame:
    """The columns ``keep`` of ``docs`` and ``fingerprint`` (binary)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            prints = [fingerprint(t, shingle, seed, bits) for t in b.column(b.num_columns - 1).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(prints, pa.binary())], [*keep, "fingerprint"])

    rows = docs.select(*keep, F.col("text"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*keep).schema)
    return rows.mapInArrow(run, f"{schema}, fingerprint binary")


def links_of_tiles(a: np.ndarray, b: np.ndarray, radius: int, same: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs of rows of ``a`` and ``b`` that differ in at most ``radius`` bits, strip by strip."""
    # So many words that few pairs without likeness (32 bits a word apart) are left.
    head = min(a.shape[1], -(-max(1, radius) // 24))
    for lo in range(0, len(a), STRIP):
        part = a[lo : lo + STRIP]
        # A pair within the radius differs by no more than that in its first words, which rules out most.
        bits = np.bitwise_count(part[:, None, 0] ^ b[None, :, 0]).astype("u2" if head > 3 else "u1", copy=False)
        for w in range(1, head):
            bits += np.bitwise_count(part[:, None, w] ^ b[None, :, w])
        near = bits <= radius
        if same:
            near &= np.arange(len(b))[None, :] > np.arange(lo, lo + len(part))[:, None]
        i, j = np.nonzero(near)
        if a.shape[1] > head:
            keep = np.bitwise_count(part[i] ^ b[j]).sum(axis=1, dtype="i8") <= radius
            i, j = i[keep], j[keep]
        if len(i):
            yield i + lo, j


class Forest:
    """Labels of nodes that grow together; tells which links joined something new."""

    def __init__(self, n: int):
        self.label = np.arange(n)

    def add(self, i: np.ndarray, j: np.ndarray) -> list[tuple[int, int]]:
        """Links sorted by ``i``. At most one link per join of two groups is returned."""
        taken = []
        starts = np.flatnonzero(np.r_[True, i[1:] != i[:-1]])
        for lo, hi in zip(starts, [*starts[1:], len(i)]):
            x, ys = i[lo], j[lo:hi]
            labels = self.label[ys]
            other = labels != self.label[x]
            if other.any():
                found, first = np.unique(labels[other], return_index=True)
                taken += [(int(x), int(y)) for y in ys[other][first]]
                self.label[np.isin(self.label, found)] = self.label[x]
        return taken


def numbered_links(prints: DataFrame, radius: int, bits: int, tile: int = TILE) -> tuple[DataFrame, DataFrame]:
    """A table of different fingerprints with numbers ``_node``, and a forest ``u, v`` of the links for each pair of tiles."""
    count = F.aggregate(
        F.sequence(F.lit(1), F.lit(bits // 8)),
        F.lit(0),
        lambda n, i: n + F.bit_count(F.conv(F.hex(F.substring("fingerprint", i, F.lit(1))), 16, 10).cast("long")),
    )
    # Numbers without gaps, in the order of the population count; a tile holds the next so many of them.
    placed = cut_lineage(enumerate_rows(prints.withColumn("_ones", count), "_ones", name="_node"))
    row = F.struct("_node", F.hex("fingerprint").alias("code"))
    tiles = cut_lineage(
        placed.groupBy(F.floor(F.col("_node") / tile).alias("tile")).agg(
            F.unhex(F.array_join(F.transform(F.sort_array(F.collect_list(row)), lambda r: r["code"]), "")).alias("codes"),
            F.min("_ones").alias("low"),
            F.max("_ones").alias("high"),
        )
    )
    # The partners of a tile follow it without a gap up to the last one that begins within the radius. That one is looked up
    # by population count: a table of ``bits`` + 1 rows.
    begins = tiles.groupBy(F.col("low").alias("ones")).agg(F.max("tile").alias("last"))
    upto = W.orderBy("ones").rowsBetween(W.unboundedPreceding, 0)
    last = prints.sparkSession.range(bits + 1).select(F.col("id").cast("int").alias("ones")).join(begins, "ones", "left")
    last = last.select("ones", F.max("last").over(upto).alias("last"))
    reach = tiles.select("tile", F.least(F.col("high") + radius, F.lit(bits)).alias("ones")).join(last, "ones").select("tile", "last")
    first = tiles.select("tile", F.col("codes").alias("a")).join(reach, "tile").withColumn("other", F.explode(F.sequence("tile", "last")))
    pairs = first.join(tiles.select(F.col("tile").alias("other"), F.col("codes").alias("b")), "other")

    def compare(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for p in frame.itertuples():
                same = p.tile == p.other
                codes = [np.frombuffer(x, "<u8").reshape(-1, bits // 64) for x in (p.a, p.b)]
                ids = [t * tile + np.arange(len(c)) for t, c in zip((p.tile, p.other), codes)]
                nodes = ids[0] if same else np.concatenate(ids)
                forest, out = Forest(len(nodes)), []
                for i, j in links_of_tiles(*codes, radius, same):
                    out += forest.add(i, j if same else j + len(ids[0]))
                if out:
                    u, v = np.array(out).T
                    yield pd.DataFrame({"u": nodes[u], "v": nodes[v]})

    # Adaptive execution would put pairs of tiles together by their few bytes; comparing them costs time, not bytes.
    tasks = max(int(prints.sparkSession.conf.get("spark.sql.shuffle.partitions")), prints.sparkSession.sparkContext.defaultParallelism)
    links = pairs.select("tile", "other", "a", "b").repartition(tasks, "tile", "other").mapInPandas(compare, "u long, v long")
    return placed.drop("_ones"), links


def classes(prints: DataFrame, radius: int, bits: int, tile: int = TILE) -> DataFrame:
    """Adds ``root`` to a table of different fingerprints: the same number for all that are linked, directly or by others."""
    placed, links = numbered_links(prints, radius, bits, tile)
    roots = components(links).withColumnRenamed("node", "_node")
    return placed.join(roots, "_node", "left").withColumn("root", F.coalesce("component", "_node")).drop("_node", "component")


def _rooted(prints: DataFrame, radius: int, bits: int) -> DataFrame:
    """``fingerprint, root, component_id`` for each different fingerprint of a written table ``doc_id, fingerprint``."""
    known = prints.groupBy("fingerprint").agg(F.min("doc_id").alias("least"))
    linked = cut_lineage(classes(known, radius, bits))
    least = cut_lineage(linked.groupBy("root").agg(F.min("least").alias("component_id")))
    return cut_lineage(linked.join(least, "root").select("fingerprint", "root", "component_id"))


def simhash_classes(docs: DataFrame, radius: int = 3, shingle: int = 3, seed: int = 42, bits: int = 64) -> DataFrame:
    """``doc_id, fingerprint, component_id`` for each row of ``docs``.

    Rows whose fingerprints differ in at most ``radius`` bits are linked; ``component_id`` is the smallest ``doc_id`` reachable
    by links, itself included (null if all are null). Copies share a fingerprint, so they cost one row in the comparison.
    Texts without words, or null, share the fingerprint zero.
    """
    prints = cut_lineage(fingerprints(docs, ["doc_id"], shingle, seed, bits))
    # A fingerprint may be that of a third of all rows: both sides are read from tables, so its rows can be dealt out.
    return prints.join(_rooted(prints, radius, bits), "fingerprint").select("doc_id", "fingerprint", "component_id")


def drop_linked(docs: DataFrame, radius: int = 3, shingle: int = 3, seed: int = 42, bits: int = 64) -> DataFrame:
    """The rows of ``docs`` without all but one of each class of ``simhash_classes``: the row with the smallest ``doc_id``
    stays (null is largest; among equal ids the one with the smaller hash of its text, among equal rows one). Same columns.

    Fingerprints are kept with the id and a 128-bit hash of the text, not with the text; the rows that stay are found again by
    these three.
    """
    key = ["_d", "_h1", "_h2"]
    text = F.coalesce(F.col("text"), F.lit(""))
    # Null and empty texts have the same fingerprint; the first hash tells them apart.
    hashes = [F.xxhash64("text").alias("_h1"), F.xxhash64(F.lit(1), text).alias("_h2")]
    named = docs.select(F.col("doc_id").alias("_d"), *hashes, F.col("text").alias("text"))
    prints = cut_lineage(fingerprints(named, key, shingle, seed, bits))
    rooted = _rooted(prints.select(F.col("_d").alias("doc_id"), "fingerprint"), radius, bits)
    place = F.struct(F.col("_d").isNull().alias("none"), *key)
    firsts = prints.join(rooted.select("fingerprint", "root"), "fingerprint").groupBy("root").agg(F.min(place).alias("p"))
    firsts = firsts.select("p._d", "p._h1", "p._h2")
    same = lambda a, b: a["_d"].eqNullSafe(b["_d"]) & (a["_h1"] == b["_h1"]) & (a["_h2"] == b["_h2"])
    counts = prints.groupBy(*key).agg(F.count("*").alias("_n"))
    stay = cut_lineage(firsts.join(counts, same(firsts, counts)).select(*[firsts[c] for c in key], "_n"))
    keyed = docs.select(F.struct("*").alias("doc"), F.col("doc_id").alias("_d"), *hashes)
    once, often = stay.where("_n = 1"), stay.where("_n > 1")
    single = keyed.join(once, same(keyed, once), "left_semi").select("doc")
    # Rows that are there several times: each task keeps one before they meet.
    met = keyed.join(often, same(keyed, often), "left_semi")
    first = F.row_number().over(W.partitionBy(*key).orderBy(F.xxhash64("doc")))
    return single.unionByName(met.withColumn("_at", first).where("_at = 1").select("doc")).select("doc.*")


def _set_prints(docs: DataFrame, shingle: int, seed: int, bits: int, strip: int = 16_384) -> DataFrame:
    """``doc, doc_id`` and of the set of different shingles of ``doc.text``: ``key``, which tells sets apart, ``fingerprint``
    (null for sets of up to ``SHORT`` shingles), ``own`` and ``less``: see ``signatures``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keys, prints, own, less = [], [], [], []
            for text in b.column(2).to_pylist():
                hashes = shingle_set(text, shingle, seed)
                keys.append(name_of(hashes))
                votes = sum(_votes(hashes[lo : lo + strip], bits) for lo in range(0, len(hashes), strip)) if len(hashes) > SHORT else None
                prints.append(None if votes is None else np.packbits(votes * 2 > len(hashes), bitorder="little").tobytes())
                one, many = signatures(hashes)
                own.append(one)
                less.append(many)
            columns = [pa.array(keys, pa.binary()), pa.array(prints, pa.binary()), pa.array(own, pa.int64()), pa.array(less, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays([*b.columns[:2], *columns], ["doc", "doc_id", "key", "fingerprint", "own", "less"])

    rows = docs.select(F.struct("*").alias("doc"), "doc_id", "text")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:2])
    return rows.mapInArrow(run, f"{schema}, key binary, fingerprint binary, own bigint, less array<bigint>")


def proposals(sets: DataFrame, radius: int, bits: int) -> DataFrame:
    """``u, v``: names of sets that may be similar, for different ``key, fingerprint, own, less``.

    Sets whose fingerprints differ in at most ``radius`` bits are linked, directly or by others, and each short set is linked
    to those that hold it.
    """
    long = sets.where(F.col("fingerprint").isNotNull())
    first = cut_lineage(long.groupBy("fingerprint").agg(F.min("key").alias("first")))
    placed, links = numbered_links(first, radius, bits)
    ends = {c: placed.select(F.col("_node").alias(c), F.col("first").alias(f"{c}_key")) for c in "uv"}
    near = cut_lineage(links).join(ends["u"], "u").join(ends["v"], "v").select(F.col("u_key").alias("u"), F.col("v_key").alias("v"))
    equal = long.join(first, "fingerprint").where(F.col("key") != F.col("first")).select(F.col("key").alias("u"), F.col("first").alias("v"))
    inner = sets.where(F.col("own").isNotNull()).select(F.col("key").alias("v"), F.col("own").alias("part"))
    held = sets.select(F.col("key").alias("u"), F.explode("less").alias("part")).join(inner, "part").select("u", "v")
    return near.unionByName(equal).unionByName(held)


def drop_near_duplicates(docs: DataFrame, radius: int, shingle: int = 5, seed: int = 42, bits: int = 256) -> DataFrame:
    """The rows of ``docs`` without all but one of each class: the row with the smallest ``doc_id`` stays (null is largest;
    among equal ids one of them). Same columns.

    A class is joined by links between texts whose sets of shingles have a similarity of at least 0.8. Fingerprints of the
    sets within ``radius`` bits propose links, for short sets their subsets do; each link is checked with the sets.
    """
    marked = cut_lineage(_set_prints(docs, shingle, seed, bits))
    sets = cut_lineage(marked.select("key", "fingerprint", "own", "less").distinct())
    roots = verified_components(proposals(sets, radius, bits), marked.select("key", F.col("doc.text").alias("text")), shingle, seed)
    roots = cut_lineage(roots.select(F.col("node").alias("key"), "component"))
    # Filtering on the first row lets each task drop all but one row of a class before the shuffle.
    order = W.partitionBy("root").orderBy(F.col("doc_id").asc_nulls_last(), F.xxhash64("doc.text"))
    rooted = marked.join(roots, "key", "left").withColumn("root", F.coalesce("component", "key"))
    firsts = rooted.withColumn("at", F.row_number().over(order)).where("at = 1")
    return firsts.select("doc.*")

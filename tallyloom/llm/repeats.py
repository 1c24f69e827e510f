"""Removal of long repeated byte strings by bucket refinement over sampled suffixes.

Every string of ``length`` bytes holds, among its grams of ``gram`` bytes, one with the smallest hash (the first such): its
anchor. Equal strings have equal anchors, so only suffixes that start at anchors have to be kept, about one in a hundred.
They are put into buckets by their gram, and buckets are refined level by level, each of which looks only at what is still
open: first all strings of an anchor together, then slices of neighbouring strings, then single strings. This differs from
refinement of stored identifiers: a level's identifiers are hashed anew from the text by prefix sums, and only those of single
strings are put together from halves (100 bytes to 200 to 400).
Identifiers are 64-bit hashes instead of sorted ranks, so that refining is a grouped minimum and maximum over all tables and
never a list of a bucket; two strings are taken for equal if these agree.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.session import cut_lineage

LENGTH = 400
GRAM = 100
# Neighbouring strings of an anchor that are looked at together.
SLICE = 12
# Tables of side information up to this many bytes, counted, are sent to every task; beyond, the join is left to shuffles.
BROADCAST_BYTES = 32_000_000

_BASE = 0x9E3779B97F4A7C15 | 1
_CODE = np.random.default_rng(11).integers(0, 1 << 64, 256, dtype="u8")


@lru_cache(maxsize=1)
def _powers(bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2^64, for texts of up to 2^bits bytes."""
    out = []
    for base in (_BASE, pow(_BASE, -1, 1 << 64)):
        p = np.full(1 << bits, base, "u8")
        p[0] = 1
        out.append(np.cumprod(p, dtype="u8"))
    return out[0], out[1]


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


class Names:
    """Hashes of any substrings of a text."""

    def __init__(self, data: bytes):
        raw = np.frombuffer(data, "u1")
        up, self.down = _powers(max(18, (len(raw) + 1).bit_length()))
        self.sums = np.zeros(len(raw) + 1, "u8")
        np.cumsum(_CODE[raw] * up[: len(raw)], out=self.sums[1:])
        self.n = len(raw)

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return _mix((self.sums[end] - self.sums[start]) * self.down[start])

    def all(self, size: int) -> np.ndarray:
        """Identifiers of the ``size`` bytes at each offset, made from those of the halves."""
        m = self.n - size + 1
        if size % 2 or size <= GRAM:
            return _mix((self.sums[size:] - self.sums[:m]) * self.down[:m])
        half = self.all(size // 2)
        return _mix(half[:m] * np.uint64(3) + _mix(half[size // 2 : size // 2 + m] + np.uint64(size)))


def anchors(names: Names, length: int, gram: int) -> tuple[np.ndarray, ...]:
    """``lo, hi, pos, bucket``: strings that start at lo ... hi have their anchor at pos."""
    wide = length - gram + 1
    grams = names.all(gram)
    # Smallest hash first, then the leftmost. The minimum over a window comes from minima up to and from block borders.
    key = (grams >> np.uint64(32) << np.uint64(32)) | np.arange(len(grams), dtype="u8")
    block = np.concatenate([key, np.full(-len(key) % wide, (1 << 64) - 1, "u8")]).reshape(-1, wide)
    upto = np.minimum.accumulate(block, axis=1).ravel()
    since = np.minimum.accumulate(block[:, ::-1], axis=1)[:, ::-1].ravel()
    strings = names.n - length + 1
    at = (np.minimum(since[:strings], upto[wide - 1 : wide - 1 + strings]) & np.uint64(0xFFFFFFFF)).astype("i8")
    lo = np.flatnonzero(np.r_[True, at[1:] != at[:-1]])
    return lo, np.r_[lo[1:], strings] - 1, at[lo], grams[at[lo]]


def _over(texts: DataFrame, each: Callable, fields: list[tuple[str, pa.DataType]], once: bool = False) -> DataFrame:
    """Runs ``each(key, size, text, extra)``, which gives a tuple of arrays or None, on every row ``key, size, text[, extra]``.

    The output has ``key`` and ``size`` before the arrays. ``once``: a text is looked at once in a task.
    """
    schema = pa.schema([("key", pa.int64()), ("size", pa.int32()), *fields])
    ddl = ", ".join(f"{f.name} {'long' if f.type == pa.int64() else 'int'}" for f in schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = set()
        for b in batches:
            out = []
            for key, size, text, *extra in zip(*(c.to_pylist() for c in b.columns)):
                if once and (key, size) in seen:
                    continue
                seen.add((key, size))
                got = each(text.encode("utf-8", "replace"), *extra)
                if got is not None and len(got[0]):
                    out.append((np.full(len(got[0]), key), np.full(len(got[0]), size), *got))
                if out and sum(len(x[0]) for x in out) > 50_000:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c), f.type) for c, f in zip(zip(*out), schema)], schema=schema)
                    out = []
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c), f.type) for c, f in zip(zip(*out), schema)], schema=schema)

    return texts.mapInArrow(run, ddl)


def _sized(df: DataFrame, many: str | None = None, each: int = 64) -> DataFrame:
    """A written table, marked for broadcast if its rows, or the entries of its list column ``many``, take few bytes."""
    df = cut_lineage(df)
    entries = F.coalesce(F.sum(F.size(many) + 1), F.lit(0)) if many else F.count("*")
    return F.broadcast(df) if df.agg(entries.alias("n")).first()["n"] * each <= BROADCAST_BYTES else df


def _shared(rows: DataFrame, name: str) -> DataFrame:
    """The values of column ``name`` that more than one class has."""
    ends = rows.where(F.col(name).isNotNull()).groupBy(name).agg(F.min("cls").alias("a"), F.max("cls").alias("b"))
    return cut_lineage(ends.where("a <> b").select(name))


def repeated_starts(texts: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """``key, size, first, last``: the strings of ``length`` bytes that start at first ... last occur more than once.

    ``texts`` is ``key, size, text`` with a row for each document; ``key`` and ``size`` tell texts apart.
    """
    i8, i4 = pa.int64(), pa.int32()

    def sample(data: bytes):
        if len(data) < length:
            return None
        names = Names(data)
        lo, hi, pos, bucket = anchors(names, length, gram)
        whole = _mix(names.of(lo, hi + length) + (pos - lo).astype("u8") * np.uint64(7919) + (hi - lo).astype("u8"))
        return lo, hi, pos, bucket.view("i8"), whole.view("i8")

    long_enough = texts.where(F.col("size") >= length)
    found = _over(long_enough, sample, [("lo", i4), ("hi", i4), ("pos", i4), ("bucket", i8), ("whole", i8)])
    kept = cut_lineage(found.groupBy("key", "size", "lo", "hi", "pos", "bucket", "whole").agg(F.count("*").alias("n")))
    # A class: anchors that agree in all their strings. Its strings are repeated if it has two members; the strings of
    # different classes in a bucket have to be compared.
    class_rows = cut_lineage(kept.groupBy("bucket", "whole").agg(F.sum("n").alias("n")))
    ambiguous = class_rows.groupBy("bucket").agg(F.count("*").alias("classes")).where("classes > 1").select("bucket", F.lit(1).alias("open"))
    marked = class_rows.join(ambiguous, "bucket", "left").where("n > 1 or open = 1")
    marked = _sized(marked.select("bucket", "whole", (F.col("n") > 1).alias("twice"), F.coalesce("open", F.lit(0)).alias("open")))
    tagged = cut_lineage(kept.drop("n").join(marked, ["bucket", "whole"]).withColumn("cls", F.xxhash64("bucket", "whole")))
    done = tagged.where("twice").select("key", "size", F.col("lo").alias("first"), F.col("hi").alias("last"))

    # One member of each open class stands for it; a class of one member is that member.
    one = F.struct("key", "size", "lo", "hi", "pos", "twice")
    stands = cut_lineage(tagged.where("open = 1").groupBy("cls").agg(F.min(one).alias("m")).select("cls", "m.*"))

    def asked(rows: DataFrame, *columns: str) -> DataFrame:
        """The texts that have such rows, each with a list of them (no more than the anchors of the text)."""
        lists = rows.groupBy("key", "size").agg(F.collect_list(F.struct(*columns)).alias("asked"))
        return long_enough.join(_sized(lists, "asked"), ["key", "size"]).select("key", "size", "text", "asked")

    def slices(data: bytes, rows: list[dict]):
        names = Names(data)
        cls, lo, hi, pos = (np.array([r[c] for r in rows]) for c in ("cls", "lo", "hi", "pos"))
        first, last = (pos - hi) // SLICE, (pos - lo) // SLICE
        each = last - first + 1
        row = np.repeat(np.arange(len(rows)), each)
        j = np.arange(each.sum()) - np.repeat(np.cumsum(each) - each, each) + first[row]
        # Strings at distance j * SLICE ... j * SLICE + SLICE - 1 before the anchor: what they have in common, and all of it.
        start = pos[row] - j * SLICE
        core = names.of(start, start + length - SLICE + 1) + j.astype("u8")
        full = (start <= hi[row]) & (start - SLICE + 1 >= lo[row])
        union = names.of(np.maximum(start - SLICE + 1, 0), np.minimum(start + length, names.n)) + j.astype("u8")
        own = np.where(full, union, _mix(cls[row].view("u8") + j.astype("u8")))  # not full: like no other
        return (cls[row], np.maximum(start - SLICE + 1, lo[row]), np.minimum(start, hi[row]), core.view("i8"), own.view("i8"))

    sliced = cut_lineage(_over(asked(stands, "cls", "lo", "hi", "pos"), slices, [("cls", i8), ("first", i4), ("last", i4), ("core", i8), ("whole", i8)], once=True))
    alive = sliced.join(_shared(sliced, "core"), "core", "left_semi")
    judged = cut_lineage(alive.join(_shared(sliced, "whole").withColumn("same", F.lit(True)), "whole", "left"))
    # Slices without an equal are opened; one of each kind of equal ones stands beside them, as its strings may be theirs.
    opened = judged.where("same is null").select("core", "key", "size", "cls", "first", "last")
    member = F.min(F.struct("key", "size", "cls", "first", "last")).alias("m")
    beside = judged.where("same").groupBy("core", "whole").agg(member).join(cut_lineage(opened.select("core").distinct()), "core", "left_semi")
    opened = opened.drop("core").unionByName(beside.select("m.*")).distinct()

    def strings(data: bytes, rows: list[dict]):
        ids = Names(data).all(length)
        cls, first, last = (np.array([r[c] for r in rows]) for c in ("cls", "first", "last"))
        each = last - first + 1
        start = np.arange(each.sum()) - np.repeat(np.cumsum(each) - each, each) + np.repeat(first, each)
        return np.repeat(cls, each), start, ids[start].view("i8")

    single = cut_lineage(_over(asked(opened, "cls", "first", "last"), strings, [("cls", i8), ("first", i4), ("id", i8)], once=True))
    again = single.join(_shared(single, "id"), "id", "left_semi").select("key", "size", "first", F.col("first").alias("last"))
    return done.unionByName(judged.where("same").select("key", "size", "first", "last")).unionByName(again)


def _keyed(docs: DataFrame) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    return docs.select(F.xxhash64(text).alias("key"), F.octet_length(text).alias("size"), text.alias("text"))


def remove_repeats(docs: DataFrame, keep: list[str], length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """The columns ``keep``, ``kept`` (binary: the remaining bytes of the text), ``n_bytes``, ``n_removed`` and ``n_spans``.

    A byte goes if a string of ``length`` bytes covers it that also starts anywhere else, in this document or another; strings
    do not cross documents. Null is an empty text; texts shorter than ``length`` stay whole. Each row gives one row.
    """
    ranges = repeated_starts(_keyed(docs), length, gram)
    lists = _sized(ranges.distinct().groupBy("key", "size").agg(F.collect_list(F.struct("first", "last")).alias("ranges")), "ranges")
    text = F.coalesce("text", F.lit(""))
    rows = docs.select(*keep, F.xxhash64(text).alias("_key"), F.octet_length(text).alias("_size"), text.alias("_text"))
    lists = lists.select(F.col("key").alias("_key"), F.col("size").alias("_size"), "ranges")
    joined = rows.join(lists, ["_key", "_size"], "left").select(*keep, "_text", "ranges")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*keep).schema)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            kept, counts = [], []
            for text, found in zip(b.column(b.num_columns - 2).to_pylist(), b.column(b.num_columns - 1).to_pylist()):
                data = text.encode("utf-8", "replace")
                if not found:
                    kept.append(data)
                    counts.append((len(data), 0, 0))
                    continue
                edges = np.zeros(len(data) + 1, "i8")
                np.add.at(edges, [r["first"] for r in found], 1)
                np.add.at(edges, [r["last"] + length for r in found], -1)
                gone = np.cumsum(edges[:-1]) > 0
                kept.append(np.frombuffer(data, "u1")[~gone].tobytes())
                counts.append((len(data), int(gone.sum()), int(np.count_nonzero(gone[1:] & ~gone[:-1]) + gone[0])))
            n, removed, spans = zip(*counts) if counts else ((), (), ())
            arrays = [*b.columns[:-2], pa.array(kept, pa.binary()), *(pa.array(x, pa.int64()) for x in (n, removed, spans))]
            yield pa.RecordBatch.from_arrays(arrays, [*keep, "kept", "n_bytes", "n_removed", "n_spans"])

    return joined.mapInArrow(cut, f"{schema}, kept binary, n_bytes long, n_removed long, n_spans long")

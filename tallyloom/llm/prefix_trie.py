"""The trie of conversation prefixes: which conversations share their first turns, and how many words that saves.

Turns become 128-bit ids. Conversations are cut into segments of ``WIDTH`` turns, range-partitioned and sorted by (segment,
what came before it, ids), so that the members of a node follow each other. A task takes a run of rows as a padded matrix of
turn ids: ``lexsort`` orders it, the change masks of the columns, OR-accumulated from the left, mark where nodes start at each
depth, and ``reduceat`` aggregates every depth. Nodes that may reach over the end of a run are given out as parts and put
together by Spark; their ``ends`` are hashed in order, piece by piece.

A padding behind the last turn is larger than any id: rows that go on come first, so a conversation ends in a leaf exactly if
its row starts a new node at its own depth.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallyloom.llm.texts import word_count
from tallyloom.operators.order import enumerate_rows
from tallyloom.session import cut_lineage

# Turns of a segment: what a row holds is bounded, and so is the matrix of a run.
WIDTH = 64
ID = 16
_END = b"\xff" * ID
# Segments of one conversation whose fingerprints are summed in one window.
BLOCK = 1024
EMPTY_SHA = hashlib.sha256(b"").hexdigest()
# Conversation ids of one piece of a long list of ends.
PIECE = 1024
# The first characters by which turns with the same number and role are ordered; then by their id.
HEAD = 64


def _bits(at: Column, turn: Column) -> tuple[Column, Column]:
    """Two numbers of 60 bits that stand for a turn at its place; prefixes are told apart by their exclusive-or."""
    digest = F.md5(F.concat(F.encode(F.concat(at.cast("string"), F.lit(":")), "utf-8"), turn))
    return tuple(F.conv(F.substring(digest, start, 15), 16, 10).cast("long") for start in (1, 16))


def _bits_of(at: int, turn: bytes) -> tuple[int, int]:
    digest = hashlib.md5(f"{at}:".encode() + turn).hexdigest()
    return int(digest[:15], 16), int(digest[15:30], 16)


def numbered_turns(conversations: DataFrame) -> DataFrame:
    """``conv_id, at, id, words``: the turns of each conversation from 0 on, by turn (null first).

    Null role or text becomes empty. Turns of one number are ordered by role, the first ``HEAD`` characters and then the id.
    Rows without a ``conv_id`` belong to no conversation. One conversation may hold any part of all rows.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    size = F.octet_length(role).cast("string")
    # The length keeps role and text apart.
    turn = F.unhex(F.md5(F.concat(F.encode(F.concat(size, F.lit(":")), "utf-8"), F.encode(role, "utf-8"), F.encode(text, "utf-8"))))
    rows = conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        role.alias("role"),
        F.substring(text, 1, HEAD).alias("head"),
        turn.alias("id"),
        word_count("text").alias("words"),
    )
    order = ["conv_id", F.col("turn").asc_nulls_first(), "role", "head", "id"]
    numbered = cut_lineage(enumerate_rows(rows, order, name="n").select("conv_id", "n", "id", "words"))
    first = numbered.groupBy("conv_id").agg(F.min("n").alias("first"))
    return numbered.join(first, "conv_id").select("conv_id", (F.col("n") - F.col("first")).alias("at"), "id", "words")


def rebuilt(turns: DataFrame, family: int = 20, heads: int = 4) -> tuple[DataFrame, DataFrame]:
    """Conversations that start with the first turns of the first one of their family.

    The first h turns of conversation c - c % ``family`` (all if fewer, none if absent), then the own ones after the first h;
    h is the unsigned crc32 of the decimal c, modulo ``heads``. Returns ``conv_id`` of all, and ``conv_id, at, id, words``.
    """
    convs = turns.groupBy("conv_id").agg(F.count("*").alias("n"))
    h = F.crc32(F.encode(F.col("conv_id").cast("string"), "utf-8")) % heads
    first = F.col("conv_id") - F.col("conv_id") % family
    leads = convs.select(F.col("conv_id").alias("lead"), F.col("n").alias("lead_n"))
    taken = F.least("h", F.coalesce("lead_n", F.lit(0))).alias("taken")
    plan = cut_lineage(convs.withColumns({"h": h, "lead": first}).join(leads, "lead", "left").select("conv_id", "h", "lead", taken))
    # At most family x heads rows of any first conversation.
    start = turns.where(F.col("at") < heads - 1).select(F.col("conv_id").alias("lead"), "at", "id", "words")
    copied = plan.where("taken > 0").join(start, "lead").where("at < taken").select("conv_id", "at", "id", "words")
    own = turns.join(plan, "conv_id").where(F.col("at") >= F.col("h")).select("conv_id", (F.col("at") - F.col("h") + F.col("taken")).alias("at"), "id", "words")
    return plan.select("conv_id"), copied.unionByName(own)


def segments(convs: DataFrame, turns: DataFrame, width: int) -> DataFrame:
    """One row for each conversation and ``width`` turns: ``seg, p1, p2, key, conv_id, words``.

    ``key`` joins the ids, ``_END`` behind the last turn; ``p1, p2`` stand for all turns before. A conversation without turns
    has one row.
    """
    z1, z2 = _bits(F.col("at"), F.col("id"))
    row = F.struct("at", "id", "words")
    seg = F.floor(F.col("at") / width).cast("long").alias("seg")
    grouped = cut_lineage(
        turns.groupBy("conv_id", seg).agg(
            F.sort_array(F.collect_list(row)).alias("rows"),
            # The fingerprint of a segment; only conversations of several segments need it.
            F.bit_xor(z1).alias("z1"),
            F.bit_xor(z2).alias("z2"),
        )
    )
    ends = grouped.groupBy("conv_id").agg(F.max("seg").alias("end"))
    # Fingerprints before each segment: within blocks, and over the blocks of a conversation.
    many = grouped.join(ends.where("end > 0").select("conv_id"), "conv_id", "left_semi")
    many = cut_lineage(many.select("conv_id", "seg", "z1", "z2", F.floor(F.col("seg") / BLOCK).alias("block")))
    blocks = many.groupBy("conv_id", "block").agg(*[F.bit_xor(c).alias(c) for c in ("z1", "z2")])
    over = W.partitionBy("conv_id").orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    blocks = blocks.select("conv_id", "block", *[F.coalesce(F.bit_xor(c).over(over), F.lit(0)).alias(f"b_{c}") for c in ("z1", "z2")])
    inside = W.partitionBy("conv_id", "block").orderBy("seg").rowsBetween(W.unboundedPreceding, -1)
    before = many.select("conv_id", "seg", "block", *[F.coalesce(F.bit_xor(c).over(inside), F.lit(0)).alias(c) for c in ("z1", "z2")])
    before = before.join(blocks, ["conv_id", "block"]).select("conv_id", "seg", *[F.col(c).bitwiseXOR(F.col(f"b_{c}")).alias(p) for c, p in (("z1", "p1"), ("z2", "p2"))])
    joined = F.unhex(F.array_join(F.transform("rows", lambda r: F.hex(r["id"])), ""))
    key = F.concat(joined, F.when(F.col("seg") == F.col("end"), F.lit(_END)).otherwise(F.lit(b"")))
    full = grouped.join(ends, "conv_id").join(before, ["conv_id", "seg"], "left")
    full = full.select("seg", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("p1", "p2")], key.alias("key"), "conv_id", F.transform("rows", lambda r: r["words"]).alias("words"))
    bare = convs.join(ends, "conv_id", "left_anti").select(
        *[F.lit(0).cast("long").alias(c) for c in ("seg", "p1", "p2")], F.lit(_END).alias("key"), "conv_id", F.array().cast("array<bigint>").alias("words")
    )
    return cut_lineage(full.unionByName(bare))


def _sorted_runs(rows: DataFrame) -> DataFrame:
    """``rows`` range-partitioned, sorted, and led by the last row of the part before (``mark`` 0) where there is one."""
    keys = ["seg", "p1", "p2", "key", "conv_id"]
    placed = cut_lineage(rows.repartitionByRange(*keys).withColumn("part", F.spark_partition_id().cast("long")))
    # One row per part.
    lasts = placed.groupBy("part").agg(F.max(F.struct(*keys)).alias("last"))
    after = lasts.select(F.lead("part").over(W.orderBy("part")).alias("part"), "last.*").where("part IS NOT NULL")
    other = [c for c in placed.columns if c not in (*keys, "part")]
    kinds = dict(placed.dtypes)
    after = after.select(*keys, "part", *[F.lit(None).cast(kinds[c]).alias(c) for c in other], F.lit(0).alias("mark"))
    led = placed.select(*keys, "part", *other, F.lit(1).alias("mark")).unionByName(after)
    return led.repartition("part").sortWithinPartitions("part", "mark", *keys)


class Run:
    """A run of sorted rows as a padded matrix: where nodes start, by level (turns within the segment)."""

    def __init__(self, frame: pd.DataFrame, before: tuple | None):
        self.seg, self.p1, self.p2, self.conv = (frame[c].to_numpy("i8") for c in ("seg", "p1", "p2", "conv_id"))
        keys, n = list(frame["key"]), len(frame)
        held = np.array([len(k) // ID for k in keys])
        flat = np.frombuffer(b"".join(keys), f"S{ID}") if held.sum() else np.empty(0, f"S{ID}")
        # Ids become their ranks within the run. Fixed-width bytes lose zeros at the end, which no two ids of one length differ by alone.
        ranks = np.unique(flat, return_inverse=True)[1]
        self.width = int(held.max(initial=0))
        matrix = np.full((n, self.width), np.iinfo("i4").max, "i4")
        place = np.arange(self.width) < held[:, None]
        matrix[place] = ranks
        self.ended = np.array([k.endswith(_END) for k in keys], bool)
        self.turns = held - self.ended
        # A conversation that goes on in the next segment stands before those that end with this one.
        matrix[np.flatnonzero(self.ended), self.turns[self.ended]] = np.iinfo("i4").max
        matrix[~self.ended, self.turns.max(initial=0) :] = np.iinfo("i4").max - 1
        order = np.lexsort((self.conv, *matrix.T[::-1], self.p2, self.p1, self.seg))
        for name in ("seg", "p1", "p2", "conv", "ended", "turns"):
            setattr(self, name, getattr(self, name)[order])
        self.keys, self.matrix, self.order = [keys[k] for k in order], matrix[order], order
        self.words = np.zeros((n, self.width + 1), "i8")
        sizes = np.array([len(w) for w in frame["words"]])
        self.words[:, 1:][np.arange(self.width) < sizes[:, None]] = np.concatenate([np.asarray(w, "i8") for w in frame["words"]]) if n else []
        self.words = self.words[order]
        lead = np.column_stack((self.seg, self.p1, self.p2))
        change = np.zeros((n, self.width + 1), bool)
        change[1:, 0] = (lead[1:] != lead[:-1]).any(axis=1)
        change[1:, 1:] = self.matrix[1:] != self.matrix[:-1]
        # Level 0 is what came before the segment. Of the first row, the levels it shares with the row before are not new.
        self.shared = self._shared(before)
        change[0] = np.arange(self.width + 1) > self.shared
        self.starts = np.logical_or.accumulate(change, axis=1)
        self.exists = np.arange(self.width + 1) <= self.turns[:, None]

    def _shared(self, before: tuple | None) -> int:
        """The levels of the first row that the row before the run shares; -1 for none."""
        if before is None or before[:3] != (self.seg[0], self.p1[0], self.p2[0]):
            return -1
        a, b, n = before[3], self.keys[0], 0
        while n < self.width and a[n * ID : n * ID + ID] == b[n * ID : n * ID + ID] not in (b"", _END):
            n += 1
        return n

    def own(self) -> tuple[np.ndarray, np.ndarray]:
        """By row and level: words of the turn unless the row is the first of its node; by row: whether it ends in a leaf."""
        new = self.starts & self.exists
        return self.words * ~new, self.ended & new[np.arange(len(self.turns)), self.turns]

    def path(self, row: int, width: int) -> list[tuple[int, int]]:
        """The names of the nodes on the way to a row, by level."""
        a, b = int(self.p1[row]), int(self.p2[row])
        out = [(a, b)]
        for k in range(int(self.turns[row])):
            x, y = _bits_of(int(self.seg[row]) * width + k, self.keys[row][k * ID : k * ID + ID])
            a, b = a ^ x, b ^ y
            out.append((a, b))
        return out


_NODES = pa.schema(
    [(c, pa.int64()) for c in ("depth", "f1", "f2", "conv_id", "parent_conv_id", "parent_f1", "parent_f2", "n_convs", "n_children", "n_leaves", "saved_tokens")]
    + [("ends_sha256", pa.string()), ("part_of", pa.bool_()), ("first_end", pa.int64()), ("ends", pa.string())]
)


def _nodes_of(run: Run, width: int, carry: tuple[np.ndarray, np.ndarray]) -> Iterator[dict]:
    """The nodes of a run as columns of ``_NODES``, one dictionary a level."""
    n = len(run.turns)
    value, leaf = run.own()
    tail = np.cumsum(value[:, ::-1], axis=1)[:, ::-1] + carry[0][:, None]
    leaves = leaf + carry[1]
    paths: dict[int, list[tuple[int, int]]] = {}

    def named(row: int, level: int) -> tuple[int, int]:
        if row not in paths:
            paths[row] = run.path(row, width)
        return paths[row][level]

    above = None
    for k in range(run.width + 1):
        at = np.flatnonzero(run.starts[:, k] | (np.arange(n) == 0))
        real = run.exists[at, k]
        stop = np.r_[at[1:], n]
        kids = np.zeros(n, "i8") if k == run.width else (run.starts[:, k + 1] & run.exists[:, k + 1]).astype("i8")
        sums = {"n_convs": stop - at, "n_children": np.add.reduceat(kids, at), "n_leaves": np.add.reduceat(leaves, at), "saved_tokens": np.add.reduceat(tail[:, k], at)}
        least = np.minimum.reduceat(run.conv, at)
        # Nodes that may reach over an end of the run or into another segment.
        part = (stop == n) | ((at == 0) & (k <= run.shared)) | (k in (0, width))
        here = (at, part, least)
        if real.any():
            at, stop, part, least = at[real], stop[real], part[real], least[real]
            sums = {c: v[real] for c, v in sums.items()}
            later = (k == 0) & (run.seg[at] > 0)  # the node itself stands at the end of the segment before
            ends = np.add.reduceat(run.ended & (run.turns == k), here[0])[real]
            out = {"depth": run.seg[at] * width + k, "conv_id": least, "part_of": part, **sums}
            for c in ("n_convs", "n_leaves", "saved_tokens"):
                out[c] = np.where(later, 0, out[c])
            names = [named(int(r), k) if p else (None, None) for r, p in zip(at, part)]
            out |= {"f1": [x for x, _ in names], "f2": [y for _, y in names]}
            if k:
                up = np.searchsorted(above[0], at, "right") - 1
                open_up = above[1][up]
                out["parent_conv_id"] = [None if o else int(c) for o, c in zip(open_up, above[2][up])]
                names = [named(int(r), k - 1) if o else (None, None) for r, o in zip(at, open_up)]
                out |= {"parent_f1": [x for x, _ in names], "parent_f2": [y for _, y in names]}
            hashes, pieces = [], []
            for lo, hi, p, e in zip(at, stop, part, ends):
                ids = run.conv[lo:hi][run.ended[lo:hi] & (run.turns[lo:hi] == k)] if e else ()
                if p or not e:
                    hashes.append(EMPTY_SHA)
                else:
                    hashes.append(hashlib.sha256(",".join(map(str, ids.tolist())).encode()).hexdigest())
                if p and e:
                    name = named(int(lo), k)
                    pieces += [(int(run.seg[lo]) * width + k, *name, int(ids[m]), ",".join(map(str, ids[m : m + PIECE].tolist()))) for m in range(0, len(ids), PIECE)]
            out["ends_sha256"] = hashes
            out["conv_id"] = [None if x else int(c) for x, c in zip(later, least)]
            yield out
            if pieces:
                yield dict(zip(("depth", "f1", "f2", "first_end", "ends"), map(list, zip(*pieces)))) | {"part_of": [True] * len(pieces)}
        above = here


def _runs(frames: Iterator[pd.DataFrame]) -> Iterator[tuple[pd.DataFrame, tuple | None]]:
    """Rows of one part that follow each other, with the row before them."""
    part, before = None, None
    for frame in frames:
        if not len(frame):
            continue
        cuts = np.flatnonzero(np.r_[True, frame["part"].to_numpy()[1:] != frame["part"].to_numpy()[:-1]])
        for lo, hi in zip(cuts, [*cuts[1:], len(frame)]):
            rows = frame.iloc[lo:hi]
            if rows["part"].iat[0] != part:
                part, before = rows["part"].iat[0], None
            if rows["mark"].iat[0] == 0:
                before, rows = _place(rows.iloc[0]), rows.iloc[1:]
            if len(rows):
                yield rows, before
                before = _place(rows.iloc[-1])


def _place(row: pd.Series) -> tuple:
    return int(row["seg"]), int(row["p1"]), int(row["p2"]), bytes(row["key"])


def _totals(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """What each row adds to all nodes above its segment."""
    for rows, before in _runs(frames):
        run = Run(rows, before)
        value, leaf = run.own()
        yield pd.DataFrame({"conv_id": run.conv, "seg": run.seg, "saved": value.sum(axis=1), "leaves": leaf.astype("i8")})


def _hashed(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """One hash for all pieces of a node, which come in order."""
    name, hasher = None, None
    for frame in frames:
        out = []
        for depth, f1, f2, ends in zip(frame["depth"], frame["f1"], frame["f2"], frame["ends"]):
            if (depth, f1, f2) != name:
                if name:
                    out.append((*name, hasher.hexdigest()))
                name, hasher = (depth, f1, f2), hashlib.sha256(ends.encode())
            else:
                hasher.update(b"," + ends.encode())
        yield pd.DataFrame(out, columns=["depth", "f1", "f2", "ends_sha256"])
    if name:
        yield pd.DataFrame([(*name, hasher.hexdigest())], columns=["depth", "f1", "f2", "ends_sha256"])


def _carried(totals: DataFrame) -> DataFrame:
    """``conv_id, seg, saved, leaves``: sums over all later segments of a conversation, for each of its segments."""
    known = cut_lineage(totals.withColumn("block", F.floor(F.col("seg") / BLOCK)))
    # Segment 0 gets the sum as well; it has no total of its own.
    both = cut_lineage(known.unionByName(known.groupBy("conv_id").agg(F.lit(0).cast("long").alias("seg"), *[F.lit(0).cast("long").alias(c) for c in ("saved", "leaves", "block")])))
    names = ("saved", "leaves")
    blocks = both.groupBy("conv_id", "block").agg(*[F.sum(c).alias(c) for c in names])
    over = W.partitionBy("conv_id").orderBy("block").rowsBetween(1, W.unboundedFollowing)
    blocks = blocks.select("conv_id", "block", *[F.coalesce(F.sum(c).over(over), F.lit(0)).alias(f"b_{c}") for c in names])
    inside = W.partitionBy("conv_id", "block").orderBy("seg").rowsBetween(1, W.unboundedFollowing)
    rows = both.select("conv_id", "seg", "block", *[F.coalesce(F.sum(c).over(inside), F.lit(0)).alias(c) for c in names])
    return rows.join(blocks, ["conv_id", "block"]).select("conv_id", "seg", *[(F.col(c) + F.col(f"b_{c}")).alias(f"later_{c}") for c in names])


def trie(convs: DataFrame, turns: DataFrame, width: int = WIDTH) -> DataFrame:
    """The nodes of the prefixes of conversations ``conv_id`` with turns ``conv_id, at, id, words``.

    Per node ``conv_id`` (its smallest member), ``depth``, ``parent_conv_id`` (root: null), ``n_convs`` (members),
    ``n_children``, ``n_leaves`` (of its subtree, itself included), ``saved_tokens`` (over its subtree, members less one times
    the words of the last turn) and ``ends_sha256`` (of the members that end there, ascending). No conversations, no root.
    """
    rows = segments(convs, turns, width)
    totals = _sorted_runs(rows.where("seg > 0")).mapInPandas(_totals, "conv_id long, seg long, saved long, leaves long")
    carried = cut_lineage(_carried(totals))
    zero = F.lit(0).cast("long")
    carrying = rows.join(carried, ["conv_id", "seg"], "left").select("seg", "p1", "p2", "key", "conv_id", "words", *[F.coalesce(c, zero).alias(c) for c in ("later_saved", "later_leaves")])

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows, before in _runs(frames):
            made = Run(rows, before)
            carry = tuple(rows[c].to_numpy("i8")[made.order] for c in ("later_saved", "later_leaves"))
            for columns in _nodes_of(made, width, carry):
                size = len(columns["depth"])
                yield pd.DataFrame({f.name: pd.array(columns.get(f.name, [None] * size), dtype=_kind(f.type)) for f in _NODES})

    kinds = {pa.int64(): "long", pa.string(): "string", pa.bool_(): "boolean"}
    schema = ", ".join(f"{f.name} {kinds[f.type]}" for f in _NODES)
    nodes = cut_lineage(_sorted_runs(carrying).mapInPandas(run, schema))
    name, counts = ["depth", "f1", "f2"], ("n_convs", "n_children", "n_leaves", "saved_tokens")
    parts = nodes.where("part_of AND ends IS NULL").groupBy(*name).agg(
        F.min("conv_id").alias("conv_id"), *[F.max(c).alias(c) for c in ("parent_conv_id", "parent_f1", "parent_f2")], *[F.sum(c).alias(c) for c in counts]
    )
    pieces = nodes.where("ends IS NOT NULL").select(*name, "first_end", "ends")
    hashes = pieces.repartition(*name).sortWithinPartitions(*name, "first_end").mapInPandas(_hashed, "depth long, f1 long, f2 long, ends_sha256 string")
    met = cut_lineage(parts.join(hashes, name, "left").withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(EMPTY_SHA))))
    shown = ["conv_id", "depth", "parent_conv_id", *counts, "ends_sha256"]
    up = met.select((F.col("depth") + 1).alias("depth"), F.col("f1").alias("parent_f1"), F.col("f2").alias("parent_f2"), F.col("conv_id").alias("up"))
    all_nodes = nodes.where("NOT part_of").select(*shown, "parent_f1", "parent_f2").unionByName(met.select(*shown, "parent_f1", "parent_f2"))
    return all_nodes.join(up, ["depth", "parent_f1", "parent_f2"], "left").withColumn("parent_conv_id", F.coalesce("up", "parent_conv_id")).select(*shown)


def _kind(kind: pa.DataType) -> str:
    return {pa.int64(): "Int64", pa.string(): "object", pa.bool_(): "boolean"}[kind]


def conversation_trie(conversations: DataFrame, width: int = WIDTH) -> DataFrame:
    """The prefix trie of rebuilt conversations (see ``rebuilt``) of a table ``conv_id, turn, role, text``.

    Other columns of any name do no harm; an empty table gives no rows.
    """
    return trie(*rebuilt(cut_lineage(numbered_turns(conversations))), width)

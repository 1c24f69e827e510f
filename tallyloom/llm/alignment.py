"""Cross-tokenizer alignment: where two tokenizers cut a text at the same byte, and which tokens end there together.

Each text is cut into words that both tokenizers treat apart, every different word is encoded once a task, and the end
offsets of its tokens are two ascending lists. A galloping intersection finds the common ends: the shorter list drives, an
exponential search from the last hit brackets the next block of it in the longer one, a binary search finds each member.
Common indices slice the groups, and differences of ranks give the tokens that overlap.

How often an id pair is linked is counted over all documents: tasks count within chunks of some megabytes of text, Spark
adds the chunks up, and each chunk gets back the counts of its own pairs.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from array import array
from collections.abc import Iterator, Sequence
from functools import lru_cache
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.session import cut_lineage

# Ends of the shorter list that one exponential search brackets together.
STRIDE = 256
# Words that are aligned at once, and id pairs (different ones of each row) of a chunk of rows: what a task holds is bounded.
PORTION, CHUNK_PAIRS = 65_536, 1_000_000
# A task keeps the tokens of twice this many different words at hand.
WORDS_KEPT = 250_000
# Before a space or line feed that stands between two other characters that are no white space.
_CUT = re.compile(r"(?<=\S)(?=[ \n]\S)")
_SPACE = "▁"


def byte_alphabet() -> dict[str, int]:
    """Character to byte of byte-level vocabularies: printable Latin-1 stands for itself, the others follow from 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + n): b for n, b in enumerate(others)}


class Pair:
    """The two tokenizers: A byte-level (``tokenizers``), B with a dummy space and byte fallback (``sentencepiece``).

    Words are encoded alone, which is exact as long as neither tokenizer joins over their borders: A cuts before a single
    space or line feed by its pattern, B has no piece with a space behind another character or with a line feed. The second
    is checked here; without it, texts are encoded whole.
    """

    def __init__(self, a: str, b: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.a, self.b = Tokenizer.from_file(a), sentencepiece.SentencePieceProcessor(model_file=b)
        self.a.encode_special_tokens = True
        alphabet = byte_alphabet()
        names = [self.a.id_to_token(i) or "" for i in range(self.a.get_vocab_size())]
        self.a_bytes = [bytes(alphabet[c] for c in n) if all(c in alphabet for c in n) else n.encode() for n in names]
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        fallback = [re.fullmatch(r"<0x([0-9A-F]{2})>", p) if self.b.is_byte(i) else None for i, p in enumerate(pieces)]
        self.b_bytes = [bytes([int(m[1], 16)]) if m else p.replace(_SPACE, " ").encode() for p, m in zip(pieces, fallback)]
        self.a_len, self.b_len = (np.array([len(x) for x in t], "i8") for t in (self.a_bytes, self.b_bytes))
        self.space = pieces.index(_SPACE) if _SPACE in pieces else -1
        kind = json.loads(self.a.to_str())
        level = kind["pre_tokenizer"] or {}
        apart = level.get("type") == "ByteLevel" and level.get("use_regex") and not kind["normalizer"]
        whole = any(_SPACE in p.lstrip(_SPACE) or "\n" in p for p in pieces)
        self.cuts = bool(apart and not whole and self.space >= 0)
        # Of each word the ids of A, then of B, 32 bits each; those of the generation before in ``before``. Words whose bytes do
        # not come back are in ``broken``.
        self.known: dict[str, tuple[bytes, bytes]] = {}
        self.before: dict[str, tuple[bytes, bytes]] = {}
        self.broken: set[str] = set()

    def _same(self, raw: list[bytes], ids: list[list[int]], names: list[bytes], sizes: np.ndarray) -> bool:
        """Whether the tokens of all words give back their bytes, word by word."""
        counts = np.array([len(x) for x in ids])
        flat = list(chain.from_iterable(ids))
        if not counts.all() or b"".join(map(names.__getitem__, flat)) != b"".join(raw):
            return False
        return bool((np.add.reduceat(sizes[flat], np.cumsum(counts) - counts) == [len(x) for x in raw]).all())

    def _learn(self, words: list[str]) -> None:
        ids_b = self.b.encode([w[1:] if w[0] == " " else w for w in words], num_threads=1)
        ids_b = [b[1:] if w[0] != " " and b[:1] == [self.space] else b for w, b in zip(words, ids_b)]
        ids_a = [code.ids for code in self.a.encode_batch_fast(words, add_special_tokens=False)]
        raw = [w.encode() for w in words]
        if not (self._same(raw, ids_a, self.a_bytes, self.a_len) and self._same(raw, ids_b, self.b_bytes, self.b_len)):
            for w, x, a, b in zip(words, raw, ids_a, ids_b):
                if b"".join([self.a_bytes[i] for i in a]) != x or b"".join([self.b_bytes[i] for i in b]) != x:
                    self.broken.add(w)
        for w, a, b in zip(words, ids_a, ids_b):
            self.known[w] = (array("I", a).tobytes(), array("I", b).tobytes())

    def _know(self, words: set[str]) -> None:
        """Brings the words into ``known``. When that is full a new generation begins; words still in use come over from the
        one before."""
        new = words.difference(self.known)
        if len(self.known) + len(new) > WORDS_KEPT:
            self.before, self.known, new = self.known, {}, words
            self.broken &= self.before.keys() | words
        old = [w for w in new if w in self.before]
        self.known.update((w, self.before[w]) for w in old)
        new = list(new.difference(old))
        for lo in range(0, len(new), 2048):
            self._learn(new[lo : lo + 2048])

    def portions(self, text: str | None) -> Iterator[tuple[bytes, bytes, bool]]:
        """The ids of A and of B for the next words, and whether these are the last ones of the text.

        Nothing, once, if the text is empty or its bytes do not come back.
        """
        words = [] if not text else _CUT.split(" " + text) if self.cuts else [" " + text]
        if not self.known.keys() >= (different := set(words)):
            self._know(different)
        if self.broken and not self.broken.isdisjoint(words):
            words = []
        for lo in range(0, max(1, len(words)), PORTION):
            both = list(map(self.known.__getitem__, words[lo : lo + PORTION]))
            yield b"".join([x[0] for x in both]), b"".join([x[1] for x in both]), lo + PORTION >= len(words)


@lru_cache(maxsize=1)
def _pair(a: str, b: str) -> Pair:
    """One for all tasks of a worker process."""
    return Pair(a, b)


def common_ends(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Indices into two ascending lists where they hold the same number, by galloping with the shorter one."""
    if len(x) > len(y):
        j, i = common_ends(y, x)
        return i, j
    left, right, at = [], [], 0
    for lo in range(0, len(x), STRIDE):
        part = x[lo : lo + STRIDE]
        last, step = part[-1], len(part)
        low = at
        while at + step < len(y) and y[at + step] < last:  # exponential
            low, step = at + step, step * 2
        high = min(at + step + 1, len(y))
        high = low + int(np.searchsorted(y[low:high], last, "right"))  # binary
        window = y[at:high]
        if len(window):
            found = np.searchsorted(window, part)
            hit = found < len(window)
            hit[hit] = window[found[hit]] == part[hit]
            left.append(np.flatnonzero(hit) + lo)
            right.append(found[hit] + at)
        at = high
    empty = np.empty(0, "i8")
    return (np.concatenate(left), np.concatenate(right)) if left else (empty, empty)


def _written(ids_a: np.ndarray, ids_b: np.ndarray, i: np.ndarray, j: np.ndarray, names: Sequence[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The written form of the groups, token by token in the order of the text, and where each group ends in it."""
    comma_a, bar, comma_b, semi = names
    # Before an A token stand the B tokens of earlier groups, before a B token the A tokens up to its own group.
    group_a, group_b = np.searchsorted(i, np.arange(len(ids_a))), np.searchsorted(j, np.arange(len(ids_b)))
    to_b, to_a = np.r_[0, j + 1], np.r_[i + 1, len(ids_a)]
    at_a, at_b = np.arange(len(ids_a)) + to_b[group_a], np.arange(len(ids_b)) + to_a[group_b]
    out = np.empty(len(ids_a) + len(ids_b), object)
    out[at_a], out[at_b] = comma_a[ids_a], comma_b[ids_b]
    out[at_a[i]], out[at_b[j]] = bar[ids_a[i]], semi[ids_b[j]]
    return out, at_b[j] + 1


def _together(pair: Pair, items: Sequence[tuple[int, bytes, bytes, bool]], names: Sequence[np.ndarray], hashers: dict) -> Iterator[tuple[int, dict]]:
    """Aligns portions laid end to end: each ends where both lists end, so no group reaches over."""
    n_a, n_b = (np.array([len(x[k]) // 4 for x in items], "i8") for k in (1, 2))
    a, b = (np.frombuffer(b"".join([x[k] for x in items]), "<u4") for k in (1, 2))
    ends_a, ends_b = np.cumsum(pair.a_len[a]), np.cumsum(pair.b_len[b])
    i, j = common_ends(ends_a, ends_b)
    # Ranks of the overlapped tokens: from the first B token that ends behind the start of an A token to the first that
    # reaches its end.
    first, last = np.searchsorted(ends_b, ends_a - pair.a_len[a], "right"), np.searchsorted(ends_b, ends_a, "left")
    overlaps = np.r_[0, np.cumsum(last - first + 1)]
    written, ends = _written(a, b, i, j, names)
    pairs = a[i].astype("u8") << np.uint64(32) | b[j]
    stop_a = np.cumsum(n_a)
    stop_g = np.searchsorted(i, stop_a)
    lo = 0
    for n, (k, _, _, final) in enumerate(items):
        hi, digest = int(stop_g[n]), None
        if hi > lo:
            text = "".join(written[int(ends[lo - 1]) if lo else 0 : int(ends[hi - 1])].tolist())[:-1].encode()
            if k in hashers:
                hashers[k].update(b";" + text)
            else:
                hashers[k] = hashlib.sha256(text)
        if final:
            digest = hashers.pop(k).hexdigest() if k in hashers else ""
        yield k, {"n_a": int(n_a[n]), "n_b": int(n_b[n]), "n_overlaps": int(overlaps[stop_a[n]] - overlaps[stop_a[n] - n_a[n]]), "groups_sha256": digest, "pairs": pairs[lo:hi]}
        lo = hi


def aligned(pair: Pair, texts: Sequence[str | None], names: Sequence[np.ndarray], held_bytes: int = 1_000_000) -> Iterator[tuple[int, dict]]:
    """For each portion of each text, its index, numbers and linked id pairs; the hash of all groups comes with the last."""
    items, held, hashers = [], 0, {}
    for k, text in enumerate(texts):
        for part_a, part_b, final in pair.portions(text):
            items.append((k, part_a, part_b, final))
            held += len(part_a) + len(part_b)
            if held >= held_bytes:
                yield from _together(pair, items, names, hashers)
                items, held = [], 0
    yield from _together(pair, items, names, hashers)


_ROWS = pa.schema(
    [
        ("chunk", pa.string()),
        ("row", pa.int64()),
        ("doc_id", pa.int64()),
        ("n_a", pa.int64()),
        ("n_b", pa.int64()),
        ("n_overlaps", pa.int64()),
        ("groups_sha256", pa.string()),
        ("pairs", pa.binary()),
        ("times", pa.binary()),
        ("seen", pa.list_(pa.struct([("pair", pa.int64()), ("n", pa.int64())]))),
    ]
)


def written_ids(pair: Pair) -> list[np.ndarray]:
    """The ids of A and B in decimal with what may follow them."""
    return [np.array([f"{i}{end}" for i in range(len(t))], object) for t, end in ((pair.a_len, ","), (pair.a_len, "|"), (pair.b_len, ","), (pair.b_len, ";"))]


def _align(a: str, b: str):
    """Rows of documents (long ones as several, with parts of the numbers) and, for each chunk of rows, one with ``seen``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = _pair(a, b)
        names, task = written_ids(pair), TaskContext.get().taskAttemptId()
        chunks, held, seen = 0, 0, []

        def closed() -> dict:
            keys, where = np.unique(np.concatenate([s[0] for s in seen]), return_inverse=True)
            n = np.bincount(where, np.concatenate([s[1] for s in seen])).astype("i8")
            return {"chunk": f"{task}-{chunks}", "seen": [{"pair": int(p), "n": int(k)} for p, k in zip(keys, n)]}

        for batch in batches:
            ids, numbers, texts = (c.to_pylist() for c in batch.columns)
            made = []
            for k, r in aligned(pair, texts, names):
                keys, times = np.unique(r.pop("pairs"), return_counts=True)
                made.append({"chunk": f"{task}-{chunks}", "row": numbers[k], "doc_id": ids[k], **r, "pairs": keys.tobytes(), "times": times.astype("<u4").tobytes()})
                seen.append((keys, times))
                held += len(keys)
                if held >= CHUNK_PAIRS:
                    made.append(closed())
                    chunks, held, seen = chunks + 1, 0, []
                if len(made) >= 512:
                    yield pa.RecordBatch.from_pylist(made, _ROWS)
                    made = []
            if made:
                yield pa.RecordBatch.from_pylist(made, _ROWS)
        if held:
            yield pa.RecordBatch.from_pylist([closed()], _ROWS)

    return run


def _scored(docs: pd.DataFrame, counts: pd.DataFrame) -> pd.DataFrame:
    """Numbers of links and sums of their counts for the rows of one chunk."""
    docs = docs[docs["row"].notna()]
    order = np.argsort(counts["pair"].to_numpy("u8")) if len(counts) else np.empty(0, "i8")
    keys = counts["pair"].to_numpy("u8")[order]
    n, best = counts["total"].to_numpy("i8")[order], counts["best"].to_numpy(bool)[order]
    out = []
    for pairs, times in zip(docs["pairs"], docs["times"]):
        at, k = np.searchsorted(keys, np.frombuffer(pairs, "<u8")), np.frombuffer(times, "<u4").astype("i8")
        out.append((int(k.sum()), int(k[best[at]].sum()), int((k * n[at]).sum())))
    made = docs[["row", "doc_id", "n_a", "n_b", "n_overlaps", "groups_sha256"]].reset_index(drop=True)
    return pd.concat([made, pd.DataFrame(out, columns=["n_links", "n_best", "count_sum"], dtype="int64")], axis=1)


def align(docs: DataFrame, a: str, b: str) -> tuple[DataFrame, DataFrame]:
    """Per document ``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, n_overlaps, groups_sha256``, and the linked id
    pairs of the corpus: ``a_id, b_id, total, best``.

    ``a`` and ``b`` are paths of the tokenizers on every executor. Tokens are those of a space and the text by A and of the
    text by B, special tokens read as plain text. Groups end where tokens of both end; the two tokens that end there are
    linked. ``n_best`` counts links whose pair is linked as often in the corpus as any of its B id, ``count_sum`` adds up how
    often the pairs are linked in the corpus, ``n_overlaps`` counts pairs of tokens that share a byte. Null or empty texts,
    and those whose bytes do not come back from the tokens of A or B, have zeros and an empty hash. Repeated rows and ids
    are kept apart; other columns of any name do no harm; an empty table gives no rows.
    """
    # Written first, so that a row has one number.
    kept = cut_lineage(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.monotonically_increasing_id().alias("row"), F.col("text").alias("text")).mapInArrow(_align(a, b), _ddl()))
    seen = kept.where("seen IS NOT NULL").select("chunk", F.explode("seen").alias("s")).select("chunk", "s.pair", "s.n")
    totals = seen.groupBy("pair").agg(F.sum("n").alias("total")).withColumn("b_id", F.col("pair").bitwiseAND(F.lit((1 << 32) - 1)))
    totals = cut_lineage(totals)
    most = totals.groupBy("b_id").agg(F.max("total").alias("most"))
    counts = cut_lineage(totals.join(most, "b_id").select("pair", "b_id", "total", (F.col("total") == F.col("most")).alias("best")))
    wanted = seen.select(F.col("chunk").alias("of"), "pair").join(counts.select("pair", "total", "best"), "pair")
    rows = kept.where("seen IS NULL").select("chunk", "row", "doc_id", "n_a", "n_b", "n_overlaps", "groups_sha256", "pairs", "times")
    # A chunk is of bounded size: its rows and its counts meet in one call.
    schema = "row long, doc_id long, n_a long, n_b long, n_overlaps long, groups_sha256 string, n_links long, n_best long, count_sum long"
    parts = rows.groupBy("chunk").cogroup(wanted.groupBy("of")).applyInPandas(lambda d, c: _scored(d, c).astype({x: "Int64" for x in ("doc_id", "n_a", "n_b", "n_overlaps")}), schema)
    sums = [F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("n_a", "n_b", "n_links", "n_best", "count_sum", "n_overlaps")]
    whole = parts.groupBy("row").agg(F.max("doc_id").alias("doc_id"), *sums, F.max("groups_sha256").alias("groups_sha256"))
    made = whole.select("doc_id", "n_a", "n_b", F.col("n_links").alias("n_groups"), "n_links", "n_best", "count_sum", "n_overlaps", "groups_sha256")
    return made, counts.select(F.shiftrightunsigned("pair", 32).alias("a_id"), "b_id", "total", "best")


def _ddl() -> str:
    return (
        "chunk string, row long, doc_id long, n_a long, n_b long, n_overlaps long, groups_sha256 string, pairs binary, times binary, "
        "seen array<struct<pair:bigint,n:bigint>>"
    )

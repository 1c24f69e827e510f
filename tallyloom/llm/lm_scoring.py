"""Scores of texts under a language model: online logistic context mixing.

A text is its words, A-Z lower-cased, with a space between them and a line feed at the end. Each byte is a few binary decisions
along a prefix code of the training bytes. Several predictors look up the decision by a hash of their context; one more follows
the text's own last occurrence of the context. Their log odds are added with weights that a gate chooses, and a further map
refines the outcome. Every text starts from the tuned weights and map; while it is read, all weights of the gates it passes and
its refinement learn from each window of bytes behind. The sum of the costs of all decisions is the total in bits.

Counts live in Spark tables only and grow with the corpus: the contexts of every packed row go to buckets of the hash, where they
are added up over all rows, and each row gets back the log odds of just the contexts it holds.

Training documents are dealt into two parts by their id: one of 49 parts tunes weights and refinement, all others are counted.
"""

from __future__ import annotations

import heapq
import zlib
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.texts import words_of
from tallyloom.session import cut_lineage

# Contexts: so many bytes before, or (0) the whole word so far. Contexts of MATCH bytes also find their last place in the text.
ORDERS = (2, 3, 5, 0)
MATCH, WORD = ORDERS.index(5), ORDERS.index(0)
PAD = 8
# Bytes of text that are packed into one row, and that share a bucket of contexts.
CHUNK = 5 << 20
BUCKET_BYTES = 8 << 20
# Bytes of a row's texts that are looked at together, so that working memory does not follow the row (a longer text is looked at
# at once): for the hashes of contexts, and for finding equal ones.
PIECE = 1 << 17
BLOCK = 1 << 21
# Bytes a text goes on between two updates, texts that are read side by side, rates of the weights and of the refinement.
STEP = 64
LANES = 128
RATE = 0.002
REFINE_RATE = 0.02
GATES = 27
BUCKETS = 25
# Log odds are kept in these parts of one.
SCALE = 12
# Stored log odds beyond this are sure.
SURE = 2 * SCALE
SLICE = 1 << 15
END = b"\n"
COUNTED, TUNING, HELD_OUT = 0, 1, 2


def kind_of(doc_id: int | None) -> int:
    """By CRC-32 of the id as text (null: empty text)."""
    crc = zlib.crc32(b"" if doc_id is None else str(doc_id).encode())
    return HELD_OUT if crc % 7 == 2 else TUNING if crc % 49 == 3 else COUNTED


class Code:
    """A prefix code of bytes by their counts: for each byte the inner nodes passed and the bits taken."""

    def __init__(self, counts: np.ndarray):
        heap = [(int(c) + 1, s, s) for s, c in enumerate(counts)]
        heapq.heapify(heap)
        children: list[tuple[int, int]] = []
        while len(heap) > 1:
            a, b = heapq.heappop(heap), heapq.heappop(heap)
            children.append((a[2], b[2]))
            heapq.heappush(heap, (a[0] + b[0], 256 + len(children), 255 + len(children)))
        paths: dict[int, list[tuple[int, int]]] = {}
        todo = [(heap[0][2], [])]
        while todo:
            at, path = todo.pop()
            if at < 256:
                paths[at] = path
            else:
                todo += [(child, [*path, (at - 256, bit)]) for bit, child in enumerate(children[at - 256])]
        self.length = np.array([len(paths[s]) for s in range(256)])
        deep = self.length.max()
        self.nodes, self.bits = np.zeros((256, deep), "i8"), np.zeros((256, deep), "i1")
        self.begin = np.arange(256) * deep
        for s, path in paths.items():
            for d, (node, bit) in enumerate(path):
                self.nodes[s, d], self.bits[s, d] = node, bit
        self.signs = self.bits * np.float32(2) - np.float32(1)
        # Places of the bytes by their paths: those under a node are next to each other.
        self.rank = np.empty(256, "u8")
        self.rank[np.lexsort(self.bits.T[::-1])] = np.arange(256)
        # For two bytes the depth at which their paths part.
        self.parting = np.zeros((256, 256), "i2")
        for s in range(256):
            n = self.length[s]
            same = (self.nodes[:, :n] == self.nodes[s, :n]) & (self.bits[:, :n] == self.bits[s, :n]) & (np.arange(n) < self.length[:, None])
            self.parting[:, s] = np.cumprod(same, axis=1).sum(axis=1)


def spread(begins: np.ndarray, n: np.ndarray) -> np.ndarray:
    """``begins[i], begins[i] + 1, …`` for ``n[i]`` places, one after the other."""
    ends = np.cumsum(n)
    out = np.repeat(begins - ends + n, n)
    out += np.arange(len(out))
    return out


def mixed(h: np.ndarray, order: int) -> np.ndarray:
    """The hash of a context from the number that names it, in place."""
    h ^= np.uint64(order + 1 << 56)  # above the bytes, so that no two orders share a context
    h *= np.uint64(0xFF51AFD7ED558CCD)
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xC4CEB9FE1A85EC53)
    h ^= h >> np.uint64(29)
    return h


BASE = 0x9E3779B97F4A7C15


@lru_cache(maxsize=1)
def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``n`` powers of ``BASE`` and their inverses."""
    power, undo = np.full(n, BASE, "u8"), np.full(n, pow(BASE, -1, 1 << 64), "u8")
    power[:1] = undo[:1] = 1
    return np.cumprod(power, dtype="u8"), np.cumprod(undo, dtype="u8")


class Words:
    """The words so far of a stream, cut after each byte up to 32 and at the ``starts`` of texts; the byte that ends a word counts to it.

    Sums of byte times power; the difference of two, divided by the power at the begin of the word, names the word so far.
    """

    def __init__(self, stream: np.ndarray, starts: np.ndarray):
        begins = np.zeros(len(stream), bool)
        begins[1:] = stream[:-1] <= 32
        begins[starts] = True
        self.begin = np.flatnonzero(begins)
        self.size = np.diff(self.begin, append=len(stream))
        # Rounded up, so that streams of about one size share the powers.
        power, self.undo = powers(max(PIECE, 1 << max(len(stream) - 1, 0).bit_length()))
        self.sums = np.zeros(len(stream) + 1, "u8")
        np.cumsum((stream.astype("u8") + np.uint64(1)) * power[: len(stream)], dtype="u8", out=self.sums[1:])

    def names(self, begin: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Of the bytes from ``begin`` to ``at``, the last not included."""
        return (self.sums[at] - self.sums[begin]) * self.undo[begin]


def context_hashes(stream: np.ndarray, order: int) -> np.ndarray:
    """64-bit hashes of the contexts before each byte of a stream; ``PAD`` zeros precede each text."""
    if order:
        h = np.zeros(len(stream), "u8")
        for d in range(1, order + 1):
            h <<= np.uint64(8)
            h[d:] |= stream[:-d]
    else:
        words = Words(stream, np.zeros(min(1, len(stream)), "i8"))
        h = words.names(np.repeat(words.begin, words.size), np.arange(len(stream)))
    return mixed(h, order)


class Reading:
    """The texts of a packed row with the places of all their contexts.

    ``keys``: the different pairs of context and byte, ascending, the byte in the last eight bits; ``n``: how often they occur in
    the first ``counted`` texts (none given: in all); ``codes``: for each predictor and byte of text the number of its pair, ``rank``:
    for each number the place in ``keys``. Pairs are numbered as they first occur, so that what is looked up while reading is near.

    Only different contexts are hashed: those of fewer bytes are found from the different ones of most bytes, and the words
    so far from the different words.
    """

    def __init__(self, texts: list[bytes], bits: int = 56, counted: int | None = None):
        self.sizes = np.array([len(t) for t in texts], "i8")
        self.ends = np.cumsum(self.sizes)
        self.starts = self.ends - self.sizes
        self.symbols = np.frombuffer(b"".join(texts), "u1")
        self.codes = [np.empty(len(self.symbols), "i4") for _ in ORDERS]
        counted = int(self.sizes[:counted].sum())

        def keys_of(h: np.ndarray, order: int, symbols: np.ndarray) -> np.ndarray:
            h = mixed(h, order)
            h >>= np.uint64(64 - bits)
            h <<= np.uint64(8)
            h |= symbols
            return h

        blocks = [slice(self.starts[lo], self.ends[hi - 1]) for lo, hi in self.blocks(0, len(texts), BLOCK)]
        longest = max(ORDERS)
        raws, raw_n, words, word_n = [], [], [], []
        for (lo, hi), block in zip(self.blocks(0, len(texts), BLOCK), blocks):
            codes, different = pd.factorize(self._raw(texts, lo, hi, longest))
            self.codes[ORDERS.index(longest)][block] = codes
            raws.append(different)
            raw_n.append(np.bincount(codes[: max(0, counted - block.start)], minlength=len(different)))
            del codes
            names, symbols, n, at = self._words(lo, hi, counted)
            place, different = pd.factorize(keys_of(names, 0, symbols))
            self.codes[WORD][block] = place.astype("i4").take(at)
            words.append(different)
            word_n.append(np.bincount(place, n, len(different)))
        none = [np.empty(0, "u8")]
        # All different contexts of the row by order, and for each block and order the place of its own among them.
        place, raw = pd.factorize(np.concatenate(raws or none))
        count = np.bincount(place, np.concatenate(raw_n or [np.empty(0)]), len(raw))
        parts, n, found = [], [], {}
        for order in sorted({o for o in ORDERS if o}, reverse=True):
            if order < longest:
                shorter, raw = pd.factorize(raw & np.uint64((1 << 8 * order + 8) - 1))
                count, place = np.bincount(shorter, count, len(raw)), shorter[place]
            found[order] = sum(map(len, parts)), place
            # The byte just before is the last of ``raw``; a context is named by the number that begins with it.
            context = (raw >> np.uint64(8)).byteswap() >> np.uint64(64 - 8 * order)
            parts.append(keys_of(context, order, raw & np.uint64(255)))
            n.append(count)
        place, different = pd.factorize(np.concatenate(words or none))
        found[0] = sum(map(len, parts)), place
        parts.append(different)
        n.append(np.bincount(place, np.concatenate(word_n or [np.empty(0)]), len(different)))
        # A key that two orders share, by chance, has one place and the counts of both.
        self.keys, rank = np.unique(np.concatenate(parts), return_inverse=True)
        self.rank = rank.astype("i4")
        self.n = np.bincount(self.rank, np.concatenate(n), len(self.keys)).astype("i4")
        for p, order in sorted(enumerate(ORDERS), key=lambda x: x[1] == longest):
            first, place = found[order]
            place, at = (first + place).astype("i4"), 0
            for block, own in zip(blocks, raws if order else words):
                self.codes[p][block] = place[at : at + len(own)].take(self.codes[ORDERS.index(longest) if order else p][block])
                at += len(own)

    def _words(self, lo: int, hi: int, counted: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Of the different words of texts ``lo`` to ``hi``, byte by byte: the word so far, the byte, how often the word occurs in the
        first ``counted`` bytes of the row; and for each byte of text its place among them."""
        names, heads, symbols, sizes = [], [], [], []
        for a, b in self.blocks(lo, hi, PIECE):
            stream = self.symbols[self.starts[a] : self.ends[b - 1]]
            words = Words(stream, (self.starts[a:b] - self.starts[a])[self.sizes[a:b] > 0])
            place, different = pd.factorize(words.names(words.begin, words.begin + words.size))
            one = np.empty(len(different), "i8")
            one[place[::-1]] = np.arange(len(place))[::-1]
            begin, size = words.begin[one], words.size[one]
            at = spread(begin, size)
            count = np.searchsorted(words.begin, counted - self.starts[a])
            names.append((place.astype("i4"), different, words.size.astype("i4"), np.bincount(place[:count], minlength=len(different))))
            heads.append(words.names(np.repeat(begin, size), at))
            symbols.append(stream[at])
            sizes.append(size)
        # The words of all pieces; each is taken from the first piece that has it.
        place, different = pd.factorize(np.concatenate([d for _, d, _, _ in names]))
        size = np.concatenate(sizes)
        one = np.empty(len(different), "i8")
        one[place[::-1]] = np.arange(len(place))[::-1]
        at = spread((np.cumsum(size) - size)[one], size[one])
        begin = np.cumsum(size[one]) - size[one]
        n, places = np.zeros(len(different), "i8"), np.empty(self.ends[hi - 1] - self.starts[lo], "i4")
        first = done = 0
        for own, which, each, count in names:
            here = place[first : first + len(which)]
            n[here] += count
            found = spread(begin[here][own], each)
            places[done : done + len(found)] = found
            first, done = first + len(which), done + len(found)
        return np.concatenate(heads)[at], np.concatenate(symbols)[at], np.repeat(n, size[one]), places

    def blocks(self, lo: int, hi: int, size: int) -> Iterator[tuple[int, int]]:
        """Texts ``lo`` to ``hi``, without the last, in runs of ``size`` bytes at most, or one text."""
        while lo < hi:
            to = min(hi, max(lo + 1, int(np.searchsorted(self.ends, self.starts[lo] + size, "right"))))
            yield lo, to
            lo = to

    def _raw(self, texts: list[bytes], lo: int, hi: int, order: int) -> np.ndarray:
        """The ``order`` bytes before each byte of texts ``lo`` to ``hi``, and the byte; zeros precede each text.

        The padding is told by its place, a zero byte of a text is text.
        """
        out = np.empty(self.ends[hi - 1] - self.starts[lo], "u8")
        for a, b in self.blocks(lo, hi, PIECE):
            stream = np.frombuffer(b"".join(bytes(PAD) + t for t in texts[a:b]), "u1").astype("u8")
            text = np.ones(len(stream), bool)
            text[np.add.outer(self.starts[a:b] - self.starts[a] + PAD * np.arange(b - a), np.arange(PAD))] = False
            raw = stream.copy()
            for d in range(1, order + 1):
                raw[d:] |= stream[:-d] << np.uint64(8 * d)
            out[self.starts[a] - self.starts[lo] : self.ends[b - 1] - self.starts[lo]] = raw[text]
        return out

    def prepare(self, code: Code, odds: np.ndarray) -> Reading:
        """``odds``: for each key its log odds along the path of its byte, see ``answer``. Adds what the text's own past says.

        ``begin``: for each number where its log odds begin in ``odds``, ``path``: where in those that are kept, in order of numbers.
        """
        n = code.length[(self.keys & np.uint64(255)).astype("i8")]
        small = "i4" if 2 * n.sum() < 2**31 else "i8"
        self.begin, n = (np.cumsum(n) - n).astype(small)[self.rank], n[self.rank]
        self.path = (np.cumsum(n) - n).astype(small)
        self.odds = np.empty(n.sum(), "i1")
        for lo in range(0, len(n), SLICE):
            here = slice(lo, lo + SLICE)
            self.odds[self.path[lo] : self.path[lo] + n[here].sum()] = odds.take(spread(self.begin[here], n[here]))
        context = np.cumsum(np.diff(self.keys >> np.uint64(8), prepend=self.keys[:1] >> np.uint64(8)) > 0)
        context, size = context[self.rank], len(self.symbols)
        self.seen, self.foretold, self.trust = np.empty(size, bool), np.empty(size, "u1"), np.empty(size, "f4")
        for lo, hi in self.blocks(0, len(self.sizes), PIECE):
            block = slice(self.starts[lo], self.ends[hi - 1])
            n, last = block.stop - block.start, np.full(block.stop - block.start, -1, "i4")
            order = (context[self.codes[MATCH][block]] << 32) + np.arange(n)
            order.sort()
            same, place = order >> 32, order & 0xFFFFFFFF
            text = np.repeat(np.arange(lo, hi, dtype="i4"), self.sizes[lo:hi])[place]
            again = np.flatnonzero((same[1:] == same[:-1]) & (text[1:] == text[:-1]))
            last[place[again + 1]] = place[again]
            self.seen[block], self.foretold[block] = last >= 0, self.symbols[block][last]
            # How long the last place and this one have gone along with each other.
            place = np.arange(n, dtype="i4")
            goes_on = np.zeros(n, bool)
            goes_on[1:] = (last[1:] >= 0) & (last[1:] == last[:-1] + 1) & (last[:-1] >= 0)
            run = place - np.maximum.accumulate(np.where(goes_on, 0, place))
            self.trust[block] = np.log1p(run, dtype="f4") + np.float32(0.5)
        return self


def pack_keys(keys: np.ndarray) -> bytes:
    """Ascending keys: which of them begin a context, the steps from one context to the next by planes of bytes, and the bytes."""
    context = keys >> np.uint64(8)
    new = np.r_[np.ones(min(1, len(keys)), bool), context[1:] != context[:-1]]
    steps = np.diff(context[new], prepend=np.zeros(1, "u8"))
    planes = [np.packbits(new), steps.view("u1").reshape(-1, 8).T.ravel(), (keys & np.uint64(255)).astype("u1")]
    return len(keys).to_bytes(8, "little") + zstandard.compress(np.concatenate(planes).tobytes(), 3)


def unpack_keys(blob: bytes) -> np.ndarray:
    size = int.from_bytes(blob[:8], "little")
    planes = np.frombuffer(zstandard.decompress(blob[8:]), "u1")
    flags = -(-size // 8)
    new = np.unpackbits(planes[:flags], count=size)
    steps = np.ascontiguousarray(planes[flags : len(planes) - size].reshape(8, -1).T).view("u8").ravel()
    context = np.cumsum(steps, dtype="u8")[np.cumsum(new, dtype="i8") - 1]
    return context << np.uint64(8) | planes[len(planes) - size :]


def pack_counts(n: np.ndarray) -> bytes:
    return zstandard.compress(n.astype("i8").view("u1").reshape(-1, 8).T.tobytes(), 3)


def unpack_counts(blob: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(zstandard.decompress(blob), "u1").reshape(8, -1).T).view("i8").ravel()


def answer(code: Code, requests: list[np.ndarray], counts: list[np.ndarray]) -> list[np.ndarray]:
    """For each request the log odds, towards the byte of the key, of all decisions on the path of each key, one after the other.

    A request is ascending keys without repeats; all keys of a context are in one call.
    """
    keys = np.sort(np.concatenate(requests))
    keys = keys[np.r_[True, keys[1:] != keys[:-1]]]
    at = [np.searchsorted(keys, r) for r in requests]
    n = np.zeros(len(keys), "i8")
    for a, c in zip(at, counts):
        n[a] += c
    symbols = (keys & np.uint64(255)).astype("i8")
    lengths = code.length[symbols]
    begin = np.cumsum(lengths) - lengths
    out = np.empty(lengths.sum(), "i1")
    # The keys of a context by the paths of their bytes: all that pass a node are next to each other.
    order = np.argsort((keys & ~np.uint64(255)) | code.rank[symbols], kind="stable")
    context = keys >> np.uint64(8)
    lo = 0
    while lo < len(keys):
        # A context is not cut in two; it has 256 keys at most.
        hi = len(keys) if lo + SLICE >= len(keys) else int(np.searchsorted(context, context[lo + SLICE]))
        which = order[lo:hi]
        symbol, weight = symbols[which], n[which].astype("f8")
        # How far a key goes along with the one before it.
        along = np.full(hi - lo, -1, "i2")
        along[1:] = np.where(context[lo + 1 : hi] == context[lo : hi - 1], code.parting[symbol[:-1], symbol[1:]], -1)
        for depth in range(int(lengths[lo:hi].max())):
            # A byte whose path has ended had a node of its own, so what follows it begins a node as well.
            on = np.flatnonzero(code.length[symbol] > depth)
            if len(on) < len(symbol):
                which, symbol, weight, along = which[on], symbol[on], weight[on], along[on]
            first = np.flatnonzero(along < depth)
            bit = code.bits[:, depth][symbol]
            both, ones = np.add.reduceat(weight, first), np.add.reduceat(weight * bit, first)
            odds = np.log((ones + 0.3) / (both - ones + 0.3)) * SCALE
            odds = np.rint(np.clip(odds, -127, 127)).astype("i1")
            odds = np.repeat(odds, np.diff(first, append=len(symbol)))
            out[begin[which] + depth] = np.where(bit, odds, -odds)
        lo = hi
    return [out[spread(begin[a], lengths[a])] for a in at]


@dataclass
class Model:
    """Everything here has a fixed size: the code, weights by gate and predictor, and the refinement by node and bucket."""

    code: Code
    weights: np.ndarray = field(default_factory=lambda: np.full((GATES, len(ORDERS) + 1), 0.3, "f4"))
    refined: np.ndarray = field(default_factory=lambda: np.tile((np.arange(BUCKETS, dtype="f4") - BUCKETS // 2) / np.float32(1.5), (256, 1)))

    def decisions(self, r: Reading, at: np.ndarray):
        """Of the bytes at the places ``at``: byte (by its number in ``at``), node, sign of the bit, log odds towards it by predictor, gate.

        A decision's depth is its own number less that of its byte's first, so what starts at a byte is moved back by the latter once.
        """
        symbols = r.symbols.take(at).astype("i8")
        n = self.code.length.take(symbols)
        ends = np.cumsum(n)
        begins = ends - n
        of, number = np.repeat(np.arange(len(at)), n), np.arange(ends[-1])
        place = (self.code.begin.take(symbols) - begins).take(of)
        place += number
        node, sign = self.code.nodes.ravel().take(place), self.code.signs.ravel().take(place)
        inputs, gate = [], np.zeros(len(of), "u1")
        for p, codes in enumerate(r.codes):
            (r.path.take(codes.take(at)) - begins).take(of, out=place, mode="clip")
            place += number
            x = r.odds.take(place)
            if p in (MATCH, WORD):
                gate *= np.uint8(3)
                gate += (x != 0).view("u1")
                gate += (np.abs(x) > SURE).view("u1")
            inputs.append(np.multiply(x, np.float32(1 / SCALE), dtype="f4"))
        # Where the path of the foretold byte parts from this one: before it goes on, there it parts, behind it has parted, or
        # nothing is foretold.
        parting = np.where(r.seen.take(at), self.code.parting[r.foretold.take(at), symbols], -1) + begins
        parting.take(of, out=place, mode="clip")
        before, at_parting, told = number < place, number == place, r.trust.take(at).take(of)
        on = (before | at_parting).view("u1")
        gate *= np.uint8(3)
        gate += on
        gate += on & (told > np.float32(2.5)).view("u1")
        told *= before.view("i1") - at_parting.view("i1")
        inputs.append(told)
        return of, node, sign, inputs, gate

    def costs(self, r: Reading) -> np.ndarray:
        """The natural logarithm of the probability of each text. A text is read on its own: nothing passes to another."""
        out = np.zeros(len(r.sizes))
        order = np.argsort(-r.sizes, kind="stable")
        for lo in range(0, len(order), LANES):
            out[order[lo : lo + LANES]] = self._side_by_side(r, order[lo : lo + LANES])
        return out

    def _side_by_side(self, r: Reading, texts: np.ndarray) -> np.ndarray:
        sizes, starts = r.sizes[texts], r.starts[texts]
        weights = [np.tile(w, len(texts)) for w in self.weights.T]
        own = np.zeros(len(texts) * BUCKETS, "f4")
        total = np.zeros(len(texts))
        for done in range(0, int(sizes[0]), STEP):
            active = int(np.searchsorted(-sizes, -done))
            width = np.minimum(sizes[:active] - done, STEP)
            of, node, sign, inputs, own_gate = self.decisions(r, spread(starts[:active] + done, width))
            lane = np.repeat(np.arange(active), width)
            first = np.cumsum(width) - width
            begins = np.searchsorted(of, first)
            gate = (lane * GATES).take(of)
            gate += own_gate
            z = np.zeros(len(node), "f4")
            part = np.empty(len(node), "f4")
            for w, x in zip(weights, inputs):
                w.take(gate, out=part, mode="clip")
                part *= x
                z += part
            cell = bucket(z * sign)
            mine = (lane * BUCKETS).take(of)
            mine += cell
            place = node * BUCKETS
            place += cell
            final = self.refined.ravel().take(place)
            final += own.take(mine)
            final *= sign
            final += z
            final *= np.float32(-0.5)
            np.minimum(final, np.float32(80), out=final)
            np.exp(final, out=final)
            total[:active] -= np.add.reduceat(np.log1p(final), begins, dtype="f8")
            if done + STEP >= sizes[0]:
                break
            # The products are rounded as before they are added up.
            each = np.empty(len(node))
            np.divide(final, np.float32(1) + final, out=part)
            np.multiply(part, sign, out=each)
            own[: active * BUCKETS] += np.bincount(mine, each, active * BUCKETS) * REFINE_RATE
            np.minimum(z, np.float32(80), out=z)
            np.exp(z, out=z)
            z += np.float32(1)
            np.divide(np.float32(RATE), z, out=z)
            for w, x in zip(weights, inputs):
                np.multiply(z, x, out=each)
                w[: active * GATES] += np.bincount(gate, each, active * GATES)
        return total


def bucket(z: np.ndarray) -> np.ndarray:
    cell = z * np.float32(1.5)
    cell += np.float32(BUCKETS // 2 + 0.5)
    return np.clip(cell, 0, BUCKETS - 1, out=cell).astype("i4")


def _texts(frame: pd.DataFrame) -> Iterator[tuple[object, list[bytes]]]:
    """Rows of the packed table and their texts."""
    for r in frame.itertuples():
        blob, at, texts = zstandard.decompress(r.blob), 0, []
        for n in r.sizes:
            texts.append(blob[at : at + n])
            at += n
        yield r, texts


def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """The rows of the batches; few are Python objects at a time."""
    for b in batches:
        for lo in range(0, b.num_rows, 256):
            yield from zip(*(c.to_pylist() for c in b.slice(lo, 256).columns))


def pack(docs: DataFrame) -> DataFrame:
    """``kind, chunk, ids, sizes, blob, counts, counted``: the texts of a few documents in a row, written as a table.

    Rows are of tuning documents (``kind`` is ``TUNING``) or of all others, the ``counted`` documents first and then those held out.
    ``counts``: how often training documents hold each byte.
    """
    schema = pa.schema(
        [("kind", pa.int32()), ("chunk", pa.int64()), ("ids", pa.list_(pa.int64())), ("sizes", pa.list_(pa.int32())), ("blob", pa.binary()), ("counts", pa.binary()), ("counted", pa.int32())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {k: [] for k in (COUNTED, TUNING)}
        size, made = dict.fromkeys(held, 0), TaskContext.get().partitionId() << 32

        def row(kind: int) -> pa.RecordBatch:
            nonlocal made
            kinds, ids, texts = zip(*sorted(held[kind], key=lambda x: x[0]))
            training = len(kinds) - kinds.count(HELD_OUT)
            counts = np.bincount(np.frombuffer(b"".join(texts[:training]), "u1"), minlength=256)
            joined = zstandard.compress(b"".join(texts), 3)
            values = (kind, made, list(ids), [len(t) for t in texts], joined, counts.astype("i8").tobytes(), kinds.count(COUNTED))
            made, held[kind], size[kind] = made + 1, [], 0
            return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(values, schema)], schema=schema)

        for doc_id, text in rows_of(batches):
            kind = kind_of(doc_id)
            place = TUNING if kind == TUNING else COUNTED
            words = b" ".join(words_of(text)) + END
            if held[place] and size[place] + len(words) > CHUNK:
                yield row(place)
            held[place].append((kind, doc_id, words))
            size[place] += len(words)
        for place in held:
            if held[place]:
                yield row(place)

    ddl = "kind int, chunk long, ids array<long>, sizes array<int>, blob binary, counts binary, counted int"
    return cut_lineage(docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, ddl))


def check_bits(size: int) -> int:
    """Bits of a context's hash: enough that of ``size`` contexts one in some 4000 meets another."""
    return min(56, 12 + max(size, 1 << 20).bit_length())


def look_up(packed: DataFrame, code: Code, size: int) -> DataFrame:
    """``kind, chunk, bucket, odds``: for each packed row the log odds of its own contexts, counted over all counted documents.

    ``size``: bytes of all texts.

    A row sends each of its different contexts once, however often it occurs, in a blob for each bucket, so a frequent context
    is a hot key nowhere. The number of buckets follows the bytes of text; there are never more blobs than contexts.
    """
    buckets, bits = min(1 + size // BUCKET_BYTES, 1 << 24), check_bits(size)

    def send(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for r, texts in _texts(frame):
                reading = Reading(texts, bits, r.counted)
                goes_to = ((reading.keys >> np.uint64(bits - 16)) * np.uint64(buckets) >> np.uint64(24)).astype("i8")
                begins = np.flatnonzero(np.diff(goes_to, prepend=-1))
                cuts = list(zip(begins, [*begins[1:], len(goes_to)]))
                yield pd.DataFrame(
                    {
                        "bucket": goes_to[begins],
                        "kind": r.kind,
                        "chunk": r.chunk,
                        "keys": [pack_keys(reading.keys[a:b]) for a, b in cuts],
                        "n": [pack_counts(reading.n[a:b]) for a, b in cuts],
                    }
                )

    def reply(frame: pd.DataFrame) -> pd.DataFrame:
        counts = [unpack_counts(n) for n in frame["n"]]
        odds = answer(code, [unpack_keys(k) for k in frame["keys"]], counts)
        return frame[["kind", "chunk", "bucket"]].assign(odds=[zstandard.compress(o.tobytes(), 3) for o in odds])

    sent = packed.select("kind", "chunk", "sizes", "blob", "counted").mapInPandas(send, "bucket long, kind int, chunk long, keys binary, n binary")
    return cut_lineage(sent.groupBy("bucket").applyInPandas(reply, "kind int, chunk long, bucket long, odds binary"))


def read(code: Code, bits: int, texts: list[bytes], answers) -> Reading:
    """The texts of a packed row with the answers it got, in the order of its keys."""
    odds = b"".join(map(zstandard.decompress, answers))
    return Reading(texts, bits).prepare(code, np.frombuffer(odds, "i1"))


def byte_code(packed: DataFrame) -> Code:
    """A prefix code of the bytes of all training documents."""
    seen = packed.select("counts").rdd.map(lambda r: np.frombuffer(r["counts"], "i8"))
    return Code(seen.treeAggregate(np.zeros(256, "i8"), np.add, np.add))


def tune(packed: DataFrame, replies: DataFrame, code: Code, bits: int) -> Model:
    """The weights and the refinement each text starts from, fitted on the tuning documents, none of which is counted.

    The driver gets sums of a fixed size: a small matrix a gate, and two numbers a cell of the refinement.
    """
    model, width = Model(code), len(ORDERS) + 1
    # All a packed row got.
    answers = replies.where(F.col("kind") == TUNING).groupBy("chunk").agg(F.sort_array(F.collect_list(F.struct("bucket", "odds"))).alias("answers"))
    rows = cut_lineage(packed.where(F.col("kind") == TUNING).select("chunk", "sizes", "blob").join(answers, "chunk"))

    def decisions(frame: pd.DataFrame, model: Model):
        for r, texts in _texts(frame):
            reading = read(code, bits, texts, [a["odds"] for a in r.answers])
            for lo in range(0, len(reading.symbols), 1 << 17):
                at = np.arange(lo, min(lo + (1 << 17), len(reading.symbols)))
                _, node, sign, inputs, gate = model.decisions(reading, at)
                x, gate = np.vstack(inputs), gate.astype("i8")
                yield node, sign, x, gate, np.einsum("pi,ip->i", x, model.weights[gate])

    def summed(each, shape: tuple[int, ...]) -> np.ndarray:
        def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            total = sum((each(f) for f in frames), np.zeros(shape))
            yield pd.DataFrame({"sums": [total.tobytes()]})

        out = rows.mapInPandas(run, "sums binary").rdd.map(lambda r: np.frombuffer(r["sums"]))
        return out.treeAggregate(np.zeros(int(np.prod(shape))), np.add, np.add).reshape(shape)

    for _ in range(3):  # Newton steps of a logistic regression for each gate

        def curvature(frame: pd.DataFrame, model=model) -> np.ndarray:
            total = np.zeros((GATES, width, width + 1))
            for _, _, x, gate, z in decisions(frame, model):
                missed = 1 / (1 + np.exp(np.clip(z, -80, 80)))
                bend = missed * (1 - missed)
                for p in range(width):
                    total[:, p, -1] += np.bincount(gate, x[p] * missed, GATES)
                    bent = x[p] * bend
                    for q in range(p, width):
                        total[:, p, q] += np.bincount(gate, bent * x[q], GATES)
                        total[:, q, p] = total[:, p, q]
            return total

        sums = summed(curvature, (GATES, width, width + 1))
        step = [np.linalg.solve(s[:, :-1] + 2.0 * np.eye(width), s[:, -1]) for s in sums]
        model = Model(code, (model.weights + np.clip(step, -0.5, 0.5)).astype("f4"))

    def outcomes(frame: pd.DataFrame) -> np.ndarray:
        total = np.zeros((256 * BUCKETS, 2))
        for node, sign, _, _, z in decisions(frame, model):
            total += np.bincount((node * BUCKETS + bucket(z * sign)) * 2 + (sign > 0), minlength=512 * BUCKETS).reshape(-1, 2)
        return total

    zero, one = summed(outcomes, (256 * BUCKETS, 2)).T
    prior = np.tile(1 / (1 + np.exp(-(np.arange(BUCKETS) - BUCKETS // 2) / 1.5)), 256)
    return Model(code, model.weights, np.log((one + 20 * prior) / (zero + 20 * (1 - prior))).reshape(256, BUCKETS).astype("f4"))


def word_counts(packed: DataFrame, size: int) -> DataFrame:
    """``chunk, bucket, n, total, new``: how often training documents hold each word of a packed row, in the order of the row's
    words (by bucket, then by their bytes). ``total`` and ``new``: all tokens and different words that training documents have
    in the bucket, given on one row of it and 0 on the others. The words go the way of the contexts, see ``look_up``.
    """
    buckets = 1 + size // BUCKET_BYTES

    def send(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for r, texts in _texts(frame):
                counts, training = Counter(), len(texts) if r.kind == TUNING else r.counted
                for t in texts[:training]:
                    counts.update(t.split())
                for t in texts[training:]:
                    counts.update(dict.fromkeys(t.split(), 0))
                counts[END] = training
                rows = []
                for b, words in by_bucket(counts, buckets):
                    n = np.array([counts[w] for w in words])
                    rows.append((b, r.chunk, zstandard.compress(b" ".join(words), 3), pack_counts(n)))
                yield pd.DataFrame(rows, columns=["bucket", "chunk", "words", "n"])

    def reply(frame: pd.DataFrame) -> pd.DataFrame:
        requests = [zstandard.decompress(w).split(b" ") for w in frame["words"]]
        sums: Counter = Counter()
        for words, n in zip(requests, frame["n"]):
            for w, c in zip(words, unpack_counts(n).tolist()):
                sums[w] += c
        out = frame[["chunk", "bucket"]].assign(n=[pack_counts(np.array([sums[w] for w in words])) for words in requests], total=0, new=0)
        out.iloc[0, 3:] = sums.total(), sum(c > 0 for c in sums.values())
        return out

    sent = packed.select("kind", "chunk", "sizes", "blob", "counted").mapInPandas(send, "bucket long, chunk long, words binary, n binary")
    return cut_lineage(sent.groupBy("bucket").applyInPandas(reply, "chunk long, bucket long, n binary, total long, new long"))


def by_bucket(words, buckets: int) -> list[tuple[int, list[bytes]]]:
    """Different words by bucket, sorted within; a word holds no white space, but for the end, which is a line feed."""
    out: dict[int, list[bytes]] = defaultdict(list)
    for w in sorted(words):
        out[zlib.crc32(w) % buckets].append(w)
    return sorted(out.items())


def score_texts(docs: DataFrame) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte`` for each row of ``docs``.

    Tokens are the words and one end. ``base_score`` is the log10 probability by counts of single tokens with one added,
    ``score`` that of the mixed model, both of the whole text; rows whose id has CRC-32 2 modulo 7 are held out. Null is
    an empty text, which has just the end. Each row is scored on its own, so rows that are equal have equal scores.
    """
    packed = pack(docs)
    size = packed.agg(F.sum(F.aggregate("sizes", F.lit(0).cast("long"), lambda a, s: a + s))).first()[0] or 0
    counts = word_counts(packed, size)
    sums = counts.agg(F.coalesce(F.sum("total"), F.lit(0)).alias("n"), F.coalesce(F.sum("new"), F.lit(0)).alias("v")).first()
    n, v = sums["n"], sums["v"]
    code, bits, word_buckets = byte_code(packed), check_bits(size), 1 + size // BUCKET_BYTES
    replies = look_up(packed, code, size)
    shared = docs.sparkSession.sparkContext.broadcast(tune(packed, replies, code, bits))
    # A packed row, its words and its answers meet as the small rows they are; the packed row comes first.
    part = lambda df, at, *columns: df.select("chunk", F.lit(at).alias("part"), *columns)
    parts = part(packed, 0, F.lit(0).cast("long").alias("bucket"), F.col("blob").alias("data"), "kind", "ids", "sizes", "counted")
    parts = parts.unionByName(part(counts, 1, "bucket", F.col("n").alias("data")), allowMissingColumns=True)
    parts = parts.unionByName(part(replies, 2, "bucket", F.col("odds").alias("data")), allowMissingColumns=True)

    def by_words(texts: list[bytes], answers) -> Iterator[tuple[int, int, float]]:
        """Tokens, known tokens and base score of each text."""
        tokens, begins = [], []
        for text in texts:
            begins.append(len(tokens))
            tokens += text.split()
            tokens.append(END)
        words = [w for _, ws in by_bucket(set(tokens), word_buckets) for w in ws]
        place = dict(zip(words, range(len(words))))
        at = np.fromiter(map(place.__getitem__, tokens), "i8", len(tokens))
        c = np.concatenate([unpack_counts(a) for a in answers])
        known, logs = np.add.reduceat((c > 0)[at], begins, dtype="i8"), np.add.reduceat(np.log10(c + 1)[at], begins)
        each = np.diff(begins, append=len(tokens))
        return zip(each.tolist(), known.tolist(), (logs - each * np.log10(n + v + 1)).tolist())

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        model, frame = shared.value, frame.sort_values(["part", "bucket"])
        of = lambda at: frame["data"][frame["part"] == at]
        ((r, texts),) = _texts(frame[frame["part"] == 0].rename(columns={"data": "blob"}).astype({"kind": int, "counted": int}))
        # The contexts of the row are gone when its words are looked at.
        costs = model.costs(read(model.code, bits, texts, of(2)))
        held = [False] * len(texts) if r.kind == TUNING else [i >= r.counted for i in range(len(texts))]
        rows = [
            (doc_id, out, tokens, known, n, base, cost / np.log(10), -cost / np.log(2) / len(text))
            for doc_id, out, text, cost, (tokens, known, base) in zip(r.ids, held, texts, costs, by_words(texts, of(1)))
        ]
        out = pd.DataFrame(rows, columns=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score", "bits_per_byte"])
        return out.astype({"doc_id": "Int64"})

    return parts.groupBy("chunk").applyInPandas(
        run, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double, bits_per_byte double"
    )

"""Token-ID files: flat unsigned integers with 64-bit document offsets, written by tasks and memory-mapped by readers.

A part consists of three flat little-endian files: ``.bin`` (the ids of its documents one after another, unsigned, 16 bits
wide if the vocabulary fits, else 32), ``.idx`` (unsigned 64-bit: where each document starts within the part, then the
end) and ``.doc`` (signed 64-bit document ids; the smallest 64-bit number stands for null). A manifest row names a part
and its counts; the prefix sums over the manifest give each part its base.
"""

from __future__ import annotations

import os
import re
import uuid
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallyloom.session import cut_lineage

NO_ID = -(1 << 63)
# A task keeps the ids of this many different words at hand.
WORDS_KEPT = 400_000


@lru_cache(maxsize=1)
def _tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def _place(folder: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(folder) if "://" in folder or folder.startswith("file:") else (pafs.LocalFileSystem(), folder)


# Stands between words that are encoded together; words that hold it are encoded alone.
MARK = b"\x01"
# A word that ends in plain punctuation after a letter or digit: the tokenizer cuts there in any case.
_CUT = re.compile(rb"(.*[a-z0-9])([.,!?;:%&#$*|]+)", re.DOTALL)


class WordEncoder:
    """Encodes texts word by word, each different word once.

    For tokenizers that lower-case, drop white space and never join pieces across it or across the border between letters
    and punctuation, the ids of a text are those of its words in turn, so the library runs only on words not seen before.
    """

    def __init__(self, path: str, dtype: str):
        self.tokenizer, self.dtype, self.known, self.before = _tokenizer(path), dtype, {}, {}

    def _run(self, words: list[bytes], batch: int = 512) -> None:
        """Learn words as a whole from the library: many in one text, each followed by a mark that is a token of its own."""
        plain = [w for w in words if MARK not in w and b"<|" not in w]
        mark = self.tokenizer.encode(MARK.decode(), add_special_tokens=False).ids
        if len(mark) != 1:
            plain = []
        texts = [b"".join(w + b" " + MARK + b" " for w in plain[i : i + batch]).decode() for i in range(0, len(plain), batch)]
        for n, code in enumerate(self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)):
            ids = np.array(code.ids, self.dtype)
            ends = np.flatnonzero(ids == mark[0])
            for w, lo, hi in zip(plain[n * batch :], [0, *(ends[:-1] + 1)], ends):
                self.known[w] = ids[lo:hi].tobytes()
        for w in set(words).difference(plain):
            self.known[w] = np.array(self.tokenizer.encode(w.decode(), add_special_tokens=False).ids, self.dtype).tobytes()

    def _learn(self, words: set[bytes]) -> None:
        if len(self.known) > WORDS_KEPT:  # frequent words come back from the generation before
            self.before, self.known = self.known, {}
        old = self.before
        self.known.update((w, old[w]) for w in words if w in old)
        cut = {w: m.groups() for w in words if w not in self.known and (m := _CUT.fullmatch(w))}
        parts = {p for pair in cut.values() for p in pair} | (words - cut.keys())
        self.known.update((p, old[p]) for p in parts if p in old)
        self._run([p for p in parts if p not in self.known])
        self.known.update((w, self.known[a] + self.known[b]) for w, (a, b) in cut.items())

    def __call__(self, texts: list[str | None], group: int = 128) -> Iterator[bytes]:
        """The ids of each text, packed. Null is an empty text. New words of ``group`` texts are learnt together."""
        for lo in range(0, len(texts), group):
            split = []
            for text in texts[lo : lo + group]:
                packed = (text or "").encode("utf-8", "replace")
                # Special tokens are told apart by case.
                split.append((packed if b"<|" in packed else packed.lower()).split())
            words = set().union(*split)
            if new := words.difference(self.known):
                self._learn(new if len(self.known) <= WORDS_KEPT else words)
            for text in split:
                yield b"".join(map(self.known.__getitem__, text))


@lru_cache(maxsize=1)
def _encoder(path: str, dtype: str) -> WordEncoder:
    """One for all tasks of a worker process."""
    return WordEncoder(path, dtype)


def write_token_files(docs: DataFrame, folder: str, tokenizer: str, end_id: int) -> DataFrame:
    """Encode the texts of ``docs`` in ascending ``doc_id`` order (null first) into files in ``folder``, a shared place.

    ``tokenizer`` is the path of a tokenizer file that drops white space, readable on every executor; ``end_id`` follows
    each document. Rows are range-partitioned by id; equal ids are ordered by text, and equal rows may go to several
    tasks, so no id is a hot key. Returns the manifest ``part, name, width, n_docs, n_tokens, doc_base, token_base``.
    Tasks write files under names of their own and only those of tasks that succeeded come into the manifest, so
    retried or doubled tasks do no harm.
    """
    wide = _tokenizer(tokenizer).get_vocab_size() > 1 << 16 or end_id >= 1 << 16
    dtype = "<u4" if wide else "<u2"
    end = np.array([end_id], dtype).tobytes()

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        where, root = _place(folder)
        where.create_dir(root, recursive=True)
        part = TaskContext.get().partitionId()
        name = f"part-{part:06d}-{uuid.uuid4().hex}"
        encode, n, at = _encoder(tokenizer, dtype), 0, 0
        with (
            where.open_output_stream(f"{root}/{name}.bin") as ids,
            where.open_output_stream(f"{root}/{name}.idx") as idx,
            where.open_output_stream(f"{root}/{name}.doc") as doc,
        ):
            for b in batches:
                keys, texts = b.column(0), b.column(1).to_pylist()
                doc.write(np.asarray(keys.fill_null(NO_ID), "<i8").tobytes())
                starts = []
                for packed in encode(texts):
                    starts.append(at)
                    ids.write(packed + end)
                    at += (len(packed) + len(end)) // len(end)
                idx.write(np.array(starts, "<u8").tobytes())
                n += b.num_rows
            idx.write(np.array([at], "<u8").tobytes())
        if n:
            yield pa.RecordBatch.from_pydict({"part": [part], "name": [name], "width": [len(end)], "n_docs": [n], "n_tokens": [at]})

    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("text")).withColumns(
        {"by": F.xxhash64("text"), "row": F.monotonically_increasing_id()}
    )
    order = [F.col("doc_id").asc_nulls_first(), "by", "row"]
    spread = keyed.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text")
    parts = cut_lineage(spread.mapInArrow(write, "part long, name string, width long, n_docs long, n_tokens long"))
    # One row per part.
    before = W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    return parts.withColumns({base: F.coalesce(F.sum(n).over(before), F.lit(0)) for base, n in (("doc_base", "n_docs"), ("token_base", "n_tokens"))})


def save_manifest(manifest: DataFrame, folder: str) -> None:
    manifest.write.parquet(f"{folder}/manifest")


def load_manifest(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/manifest")


def _mapped(where: pafs.FileSystem, path: str, dtype: str) -> np.ndarray:
    """A flat file as an array: memory-mapped where the file system is a mounted one, else read (one part)."""
    if where.get_file_info(path).size == 0:
        return np.zeros(0, dtype)
    if isinstance(where, pafs.LocalFileSystem):
        return np.memmap(path, dtype, "r")
    with where.open_input_file(path) as f:
        return np.frombuffer(f.read(), dtype)


def read_token_files(manifest: DataFrame, folder: str, batch: int = 512) -> DataFrame:
    """``doc_id, start, n_tokens, ids`` of every document in the files; ``ids`` as little-endian unsigned 32-bit integers.

    ``start`` counts the ids of all documents before. One task reads the parts of a few manifest rows.
    """

    def read(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        where, root = _place(folder)
        for frame in frames:
            for p in frame.itertuples():
                ids = _mapped(where, f"{root}/{p.name}.bin", f"<u{p.width}")
                idx, doc = _mapped(where, f"{root}/{p.name}.idx", "<u8"), _mapped(where, f"{root}/{p.name}.doc", "<i8")
                at = idx.astype("i8")
                for lo in range(0, p.n_docs, batch):
                    hi = min(lo + batch, p.n_docs)
                    keys = pd.array(doc[lo:hi], dtype="Int64")
                    keys[np.asarray(doc[lo:hi]) == NO_ID] = pd.NA
                    yield pd.DataFrame(
                        {
                            "doc_id": keys,
                            "start": at[lo:hi] + p.token_base,
                            "n_tokens": at[lo + 1 : hi + 1] - at[lo:hi],
                            "ids": [ids[at[i] : at[i + 1]].astype("<u4").tobytes() for i in range(lo, hi)],
                        }
                    )

    spread = manifest.select("part", "name", "width", "n_docs", "token_base").repartition(F.col("part"))
    return spread.mapInPandas(read, "doc_id long, start long, n_tokens long, ids binary")

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyloom.llm import alignment
from tallyloom.llm.alignment import Pair, aligned, byte_alphabet, common_ends, written_ids
from tallyloom.llm.queries import QUERIES

known = pytest.importorskip("public_tokenizers")
A, B = known.path("byte_bpe_50k.json"), known.path("piece_bpe_32k.model")


def plain_tokens(text):
    """Ids and bytes of both tokenizers on the whole text."""
    import sentencepiece
    from tokenizers import Tokenizer

    a, b = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
    a.encode_special_tokens = True
    alphabet = byte_alphabet()

    def tokens(text):
        if not text:
            return [], [], [], []
        ids = a.encode(" " + text, add_special_tokens=False).ids
        theirs = b.encode(text)
        a_bytes = [bytes(alphabet[c] for c in a.id_to_token(i)) for i in ids]
        b_bytes = []
        for i in theirs:
            p = b.id_to_piece(i)
            b_bytes.append(bytes([int(p[3:5], 16)]) if p.startswith("<0x") and len(p) == 6 else p.replace("▁", " ").encode())
        if b"".join(a_bytes) != (" " + text).encode() or b"".join(b_bytes) != (" " + text).encode():
            return [], [], [], []
        return ids, theirs, a_bytes, b_bytes

    return [tokens(t) for t in text]


def spans(pieces):
    out, at = [], 0
    for p in pieces:
        out.append((at, at + len(p)))
        at += len(p)
    return out


def plain_alignment(texts):
    """The contract, token pair by token pair."""
    docs, total = [], Counter()
    for ids, theirs, a_bytes, b_bytes in plain_tokens(texts):
        a, b = spans(a_bytes), spans(b_bytes)
        links = [(ids[m], theirs[n]) for m, x in enumerate(a) for n, y in enumerate(b) if x[1] == y[1]]
        overlaps = sum(x[0] < y[1] and y[0] < x[1] for x in a for y in b)
        common = sorted({x[1] for x in a} & {y[1] for y in b})
        groups, low = [], 0
        for end in common:
            groups.append("|".join(",".join(str(i) for i, s in zip(known_ids, all_spans) if low < s[1] <= end) for known_ids, all_spans in ((ids, a), (theirs, b))))
            low = end
        docs.append((len(ids), len(theirs), len(groups), links, overlaps, hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else ""))
        total.update(links)
    most = defaultdict(int)
    for (_, b), n in total.items():
        most[b] = max(most[b], n)
    return [(na, nb, g, len(li), sum(total[p] == most[p[1]] for p in li), sum(total[p] for p in li), o, h) for na, nb, g, li, o, h in docs]


TEXTS = [
    "The quick brown fox, it's 42 years old.\nNew line  two spaces\t tab nbsp and separator",
    None,
    "",
    " ",
    " leading and trailing ",
    "\nstarts with a line\n\nand more \n x\r\ny",
    "<|endoftext|> <s> </s> <unk> <0x41> are plain text",
    "▁ is changed by one of the two",
    "日本語のテキスト 그리고 한국어 🎉👩‍👩‍👧 é",
    "a" * 700,
    "nul \x00 byte \x85 next \x1c sep",
    "Repeated words words words, repeated words.",
    "Repeated words words words, repeated words.",
    "     five spaces\n\n\n   and lines",
    "x\ny z\n w 　wide",
]
COLUMNS = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "n_overlaps", "groups_sha256")


def test_query_against_all_token_pairs(docs_of, folder_of, spark):
    rng = random.Random(4)
    texts = TEXTS + ["".join(rng.choice([" ", "\n", "Ab", "é", "'s", "12", ".", "日", "  ", "\t", "the"]) for _ in range(rng.randint(1, 60))) for _ in range(60)]
    rows = QUERIES["op12_alignment"](spark, folder_of(documents=docs_of([(i, t, "s") for i, t in enumerate(texts)]))).collect()
    want = plain_alignment(texts)
    assert len(rows) == len(texts)
    for r in rows:
        assert tuple(r[c] for c in COLUMNS) == want[r["doc_id"]], (r["doc_id"], texts[r["doc_id"]])


def test_small_portions_and_chunks_change_nothing(docs_of, spark, monkeypatch):
    texts = TEXTS + ["one two three four five " * 30]
    docs = docs_of([(i, t, "s") for i, t in enumerate(texts)], parts=2)
    pair = Pair(A, B)
    names = written_ids(pair)
    monkeypatch.setattr(alignment, "PORTION", 3)
    parts = defaultdict(list)
    for k, r in aligned(pair, texts, names, held_bytes=100):
        parts[k].append(r)
    want = plain_alignment(texts)
    for k, w in enumerate(want):
        assert sum(r["n_a"] for r in parts[k]) == w[0] and sum(r["n_overlaps"] for r in parts[k]) == w[6]
        assert [r["groups_sha256"] for r in parts[k]] == [None] * (len(parts[k]) - 1) + [w[7]]
    rows = alignment.align(docs, A, B)[0].collect()
    assert {r["doc_id"]: tuple(r[c] for c in COLUMNS) for r in rows} == dict(enumerate(want))


def test_generations_of_known_words_change_nothing(monkeypatch):
    texts = [f"word{i} again and word{i % 7}, " * 3 + ("▁ broken" if i % 5 == 0 else "") for i in range(60)]
    want = [w[0] for w in plain_alignment(texts)]
    for kept in (5, 40, 10_000):
        monkeypatch.setattr(alignment, "WORDS_KEPT", kept)
        pair = Pair(A, B)
        got = [r["n_a"] for _, r in aligned(pair, texts, written_ids(pair), held_bytes=1)]
        assert got == want and 0 in want and len(pair.known) <= max(kept, 30)


def test_counts_of_pairs(docs_of):
    rows, counts = alignment.align(docs_of([(1, "word word word", "s"), (2, "word", "s")]), A, B)
    assert counts.agg(F.sum("total")).first()[0] == rows.agg(F.sum("n_links")).first()[0]
    assert counts.where("best").groupBy("b_id").count().count() == counts.select("b_id").distinct().count()


def test_odd_tables(docs_of, odd):
    assert alignment.align(docs_of([]), A, B)[0].count() == 0
    named = docs_of(odd).withColumns({"chunk": F.lit(1), "row": F.lit("r"), "pairs": F.lit(2)})
    rows = alignment.align(named, A, B)[0].collect()
    assert len(rows) == len(odd)
    assert all(r["n_a"] == 0 and r["groups_sha256"] == "" for r in rows if r["doc_id"] in (2, 3))
    assert alignment.align(docs_of([(1, None, "s"), (2, "", "s")]), A, B)[0].count() == 2


def test_galloping_finds_every_common_end():
    rng = np.random.default_rng(3)
    for n, m, top in ((0, 5, 9), (5, 0, 9), (1, 1, 1), (3, 4000, 5000), (4000, 3, 5000), (3000, 3000, 3500), (1000, 90_000, 100_000)):
        x, y = (np.sort(rng.choice(top + 1, min(k, top), replace=False)) for k in (n, m))
        i, j = common_ends(x, y)
        want = np.intersect1d(x, y, return_indices=True)
        assert i.tolist() == want[1].tolist() and j.tolist() == want[2].tolist()


def test_a_very_long_text(docs_of):
    text = " ".join(f"word{i % 977} and\nmore" for i in range(150_000))
    row = alignment.align(docs_of([(1, text, "s")]), A, B)[0].first()
    assert row["n_links"] == row["n_groups"] > 300_000 and len(row["groups_sha256"]) == 64

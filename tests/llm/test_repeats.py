import hashlib
import random
from collections import Counter

from tallyloom.llm.queries import QUERIES
from tallyloom.llm.repeats import remove_repeats


def plain(texts, length=400):
    """``(n_bytes, n_removed, n_spans, sha256)`` of each text, by counting all strings."""
    data = [(t or "").encode() for t in texts]
    count = Counter(d[i : i + length] for d in data for i in range(len(d) - length + 1))
    out = []
    for d in data:
        gone = bytearray(len(d))
        for i in range(len(d) - length + 1):
            if count[d[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        kept = bytes(b for b, g in zip(d, gone) if not g)
        out.append((len(d), sum(gone), len([s for s in bytes(gone).split(b"\0") if s]), hashlib.sha256(kept).hexdigest()))
    return out


def test_query_against_all_strings(docs_of, folder_of, spark):
    rng = random.Random(4)
    word = lambda: "".join(rng.choices("abcdé", k=rng.randint(1, 7)))
    prose = lambda n: " ".join(word() for _ in range(n))
    passages = [prose(n) for n in (60, 75, 90, 100, 140, 300)]
    texts = [prose(rng.randint(0, 60)) + rng.choice(["", " ", "x"]) + rng.choice(passages) + prose(rng.randint(0, 60)) for _ in range(120)]
    exact = prose(400).encode()[:400].decode("utf-8", "ignore")
    base = prose(250)
    near = [base[:i] + "#" + base[i + 1 :] for i in (5, 300, 420, 800, 900)]
    texts += ["p" + exact + "q", "r" + exact + "s", exact[:-1], *near, base, base, "ab" * 700, "a" * 1300, prose(100) + "ab" * 300, None, "", "x" * 399, "y" * 400, passages[0] * 9]
    folder = folder_of(documents=docs_of([(i, t, "s") for i, t in enumerate(texts)], 4))
    got = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in QUERIES["op9_repeats"](spark, folder).collect()}
    want = dict(enumerate(plain(texts)))
    assert {i: (got[i], want[i]) for i in want if got[i] != want[i]} == {}


def test_odd_rows(docs_of, odd):
    rows = remove_repeats(docs_of(odd), ["doc_id", "source"]).collect()
    assert len(rows) == len(odd)
    assert remove_repeats(docs_of([]), ["doc_id"]).count() == 0

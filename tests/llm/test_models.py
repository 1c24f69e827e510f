import math
import random
import tracemalloc
import zlib
from collections import Counter

import numpy as np

from tallyloom.llm import lm_scoring
from tallyloom.llm.lm_scoring import MATCH, ORDERS, Code, Model, Reading, answer, context_hashes, pack_keys, unpack_keys
from tallyloom.llm.quality import isotonic
from tallyloom.llm.queries import QUERIES

LABELS = "doc_id long, quality int, toxic int"


def corpus(docs_of, folder_of, spark, odd):
    rng = random.Random(12)
    vocabulary = ["".join(rng.choices("abcdefgh", k=rng.randint(2, 6))) for _ in range(120)]
    rows, labels = list(odd), []
    for i in range(100, 600):
        words = rng.choices(vocabulary, k=rng.randint(30, 120))
        toxic, bad = i % 5 == 0, i % 7 == 0
        if toxic:
            for at in rng.sample(range(len(words)), 5):
                words[at] = rng.choice(["vilewordx", "vilewordy", "nastyterm"])
        rows.append((i, "!! ".join(words).upper() if bad else " ".join(words) + ".", "s"))
        labels.append((i, int(not bad), int(toxic)))
    labels += [(None, 1, 1), (100, None, None), (1, 1, 0)]
    return folder_of(documents=docs_of(rows), labels=spark.createDataFrame(labels, LABELS)), rows, labels


def test_classifiers_on_held_out_rows(docs_of, folder_of, spark, odd):
    folder, rows, labels = corpus(docs_of, folder_of, spark, odd)
    for name, place, least in (("op6_quality", 1, 0.95), ("op7_toxicity", 2, 0.9)):
        got = QUERIES[name](spark, folder).collect()
        assert len(got) == len(rows) and all(0 <= r["score"] <= 1 for r in got)
        assert all(r["held_out"] == (zlib.crc32(b"" if r["doc_id"] is None else str(r["doc_id"]).encode()) % 5 == 0) for r in got)
        truth = {x[0]: x[place] for x in labels if x[0] and x[0] >= 100 and x[1] is not None}
        held = [r for r in got if r["held_out"] and r["doc_id"] in truth]
        assert sum(r["predicted"] == truth[r["doc_id"]] for r in held) / len(held) >= least


def test_scores_against_counts(docs_of, folder_of, spark, odd):
    folder, rows, _ = corpus(docs_of, folder_of, spark, odd)
    held = lambda i: zlib.crc32(b"" if i is None else str(i).encode()) % 7 == 2
    tokens = [(i, "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "").encode().split() + [b"\n"]) for i, t, _ in rows]
    c = Counter(w for i, ws in tokens if not held(i) for w in ws)
    n, v = sum(c.values()), len(c)
    want = Counter((i, held(i), len(ws), sum(c[w] > 0 for w in ws), n, round(sum(math.log10((c[w] + 1) / (n + v + 1)) for w in ws), 6)) for i, ws in tokens)
    got = QUERIES["op1_lm_score"](spark, folder).collect()
    assert Counter((*[r[k] for k in ("doc_id", "held_out", "n_tokens", "n_known", "train_tokens")], round(r["base_score"], 6)) for r in got) == want
    assert all(r["score"] < 0 and abs(r["score"]) < 1e6 for r in got)
    # The model has learnt the vocabulary: far below the eight bits of a byte.
    assert np.mean([r["bits_per_byte"] for r in got if r["held_out"] and r["n_tokens"] > 20]) < 3


def test_code_is_a_prefix_code():
    code = Code(np.arange(256))
    assert abs(sum(0.5**n for n in code.length) - 1) < 1e-12


def test_isotonic():
    x, y = isotonic(np.arange(5.0), np.array([0.0, 1.0, 0.0, 1.0, 1.0]), np.ones(5))
    assert np.interp([0, 1, 2, 3], x, y).tolist() == [0.0, 0.5, 0.5, 1.0]


def test_empty_tables(docs_of, folder_of, spark):
    folder = folder_of(documents=docs_of([]), labels=spark.createDataFrame([], LABELS))
    for name in ("op1_lm_score", "op6_quality", "op7_toxicity"):
        assert QUERIES[name](spark, folder).count() == 0


def test_labels_of_one_class_reject_nothing_else(docs_of, spark, odd):
    from tallyloom.llm import toxicity

    docs = docs_of(odd)
    for rows, want in (([], 1 / 3), ([(1, 1, 0), (2, 1, 0), (7, 1, 0)], None), ([(1, 0, 1), (2, 0, 1), (7, 1, 1)], None)):
        labels = spark.createDataFrame(rows, LABELS)
        usable = [r for r in rows if zlib.crc32(str(r[0]).encode()) % 5]
        ones = sum(r[2] for r in usable)
        scores = {round(r["score"], 6) for r in toxicity.score(docs, toxicity.fit(docs, labels), ["doc_id"]).collect()}
        assert scores == {round((ones + 1) / (len(usable) + 3), 6)} and (want is None or scores == {round(want, 6)})


def toy_model(seed=3):
    rng = np.random.default_rng(seed)
    model = Model(Code(np.bincount(np.frombuffer(b"abracadabra\x00 abc\n" * 5, "u1"), minlength=256)))
    model.weights = rng.normal(0.3, 0.2, model.weights.shape).astype("f4")
    model.refined = model.refined + rng.normal(0, 0.3, model.refined.shape).astype("f4")
    return model


def test_chances_of_the_next_byte_add_up_to_one():
    """Also after windows that have changed the text's own weights, with bytes foretold by its own past, and with zero bytes."""
    counted = Reading([b"abra cadabra\n", b"abracadabra\x00abra\n", b"bar bar bar\n"])
    model = toy_model()
    for begin in (b"", b"abra abra abr", b"cadabra abra \x00" * 12):
        texts = [begin + bytes([s]) for s in range(256)] + [begin + b"\n"]
        r = Reading(texts)
        odds = answer(model.code, [counted.keys, r.keys], [counted.n, 0 * r.n])[1]
        costs = model.costs(r.prepare(model.code, odds))
        # The bytes of the begin cost the same in all texts, so that their cost can be told from the text by one byte less.
        if begin:
            b = Reading([begin])
            before = model.costs(b.prepare(model.code, answer(model.code, [counted.keys, b.keys], [counted.n, 0 * b.n])[1]))[0]
        else:
            before = 0.0
        assert abs(np.exp(costs[:256] - before).sum() - 1) < 1e-3
        assert costs[256] == costs[10]  # nothing passes from text to text


def test_log_odds_against_counting():
    rng = random.Random(4)
    parts = [[bytes(rng.choices(b"ab \x00c", k=rng.randint(1, 40))) for _ in range(20)] for _ in range(3)]
    code = toy_model().code
    readings = [Reading(t) for t in parts]
    odds = answer(code, [r.keys for r in readings], [r.n for r in readings])
    seen = Counter()
    for texts in parts:
        for t in texts:
            for i, s in enumerate(t):
                for d in range(code.length[s]):
                    word = i - len(t[:i].split(b"\x00")[-1].split(b" ")[-1])
                    for p, order in enumerate(ORDERS):
                        context = (bytes(8) + t)[8 + i - order : 8 + i] if order else t[word:i]
                        seen[p, context, int(code.nodes[s, d]), int(code.bits[s, d])] += 1
    r, o = readings[1], odds[1]
    r.prepare(code, o)
    at = 0
    for t in parts[1]:
        for i, s in enumerate(t):
            word = i - len(t[:i].split(b"\x00")[-1].split(b" ")[-1])
            for p, order in enumerate(ORDERS):
                context = (bytes(8) + t)[8 + i - order : 8 + i] if order else t[word:i]
                for d in range(code.length[s]):
                    node, bit = int(code.nodes[s, d]), int(code.bits[s, d])
                    want = math.log((seen[p, context, node, bit] + 0.3) / (seen[p, context, node, 1 - bit] + 0.3))
                    assert abs(o[r.begin[r.codes[p][at]] + d] / 12 - want) < 0.05
            # The last place of the same five bytes in this text.
            before = [j for j in range(i) if (bytes(8) + t)[3 + j : 8 + j] == (bytes(8) + t)[3 + i : 8 + i]]
            assert bool(r.seen[at]) == bool(before)
            assert not before or r.foretold[at] == t[before[-1]]
            at += 1


def test_word_contexts_have_no_greatest_length():
    one, other = b"x" + b"y" * 40, b"z" + b"y" * 40
    h = context_hashes(np.frombuffer(bytes(8) + one + b" " + bytes(8) + other + b" " + bytes(8) + one + b" ", "u1"), 0)
    ends = [8 + 41, 8 + 42 + 8 + 41, 8 + 42 + 8 + 42 + 8 + 41]
    assert h[ends[0]] == h[ends[2]] != h[ends[1]] and ORDERS[MATCH] == 5


def test_keys_round_trip():
    keys = np.unique(np.random.default_rng(1).integers(0, 1 << 63, 1000).astype("u8"))
    assert (unpack_keys(pack_keys(keys)) == keys).all()


def test_scores_of_no_documents(docs_of, folder_of, spark):
    assert QUERIES["op1_lm_score"](spark, folder_of(documents=docs_of([]))).collect() == []


def test_scores_without_training_documents(docs_of, folder_of, spark):
    held = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 7 == 2)
    (row,) = QUERIES["op1_lm_score"](spark, folder_of(documents=docs_of([(held, "a b a", "s")]))).collect()
    assert (row["held_out"], row["n_tokens"], row["n_known"], row["train_tokens"], row["base_score"]) == (True, 4, 0, 0, 0.0)
    assert row["score"] < 0


def prose(seed, texts, words):
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choices("abcdefgh", k=rng.randint(2, 6))) for _ in range(120)]
    return [" ".join(rng.choices(vocabulary, k=words)).encode() + b"\n" for _ in range(texts)]


def test_reading_takes_little_memory_beside_the_text():
    """Working memory is that of a block: once it was some 87 bytes for each byte of a packed row, and 70 for what comes after."""
    texts = prose(5, 500, 1500)
    size, code = sum(map(len, texts)), Code(np.arange(256))
    tracemalloc.start()
    r = Reading(texts)
    reading = tracemalloc.get_traced_memory()[1] / size
    tracemalloc.reset_peak()
    r.prepare(code, np.zeros(code.length[(r.keys & np.uint64(255)).astype("i8")].sum(), "i1"))
    prepared = tracemalloc.get_traced_memory()[1] / size
    tracemalloc.stop()
    assert reading < 45 and prepared < 50


def test_blocks_of_a_row_make_no_difference(monkeypatch):
    texts = [*prose(6, 40, 60), b"\n", b"abc abc abc abc abc\n", *prose(6, 10, 60)]
    code = Code(np.bincount(np.frombuffer(b"".join(texts), "u1"), minlength=256))

    def look():
        r = Reading(texts)
        r.prepare(code, answer(code, [r.keys], [r.n])[0])
        return [r.keys, r.n, *r.codes, r.odds, r.begin, r.seen, r.foretold[r.seen], r.trust, Model(code).costs(r)]

    whole = look()
    monkeypatch.setattr(lm_scoring, "PIECE", 700)
    monkeypatch.setattr(lm_scoring, "BLOCK", 2000)
    monkeypatch.setattr(lm_scoring, "SLICE", 300)
    monkeypatch.setattr(lm_scoring, "LANES", 7)
    for a, b in zip(whole, look()):
        np.testing.assert_array_equal(a, b)


def test_counted_and_held_out_texts_of_a_row():
    """A row holds both; only the first texts are counted, and pairs are numbered as they first occur."""
    texts = [*prose(7, 20, 30), b"\n", *prose(8, 9, 30)]
    r, first, rest = Reading(texts, counted=12), Reading(texts[:12]), Reading(texts[12:])
    assert (r.keys == np.union1d(first.keys, rest.keys)).all() and set(first.keys) < set(r.keys)
    assert (r.n == [dict(zip(first.keys, first.n)).get(k, 0) for k in r.keys]).all()
    assert all((np.diff(np.unique(c, return_index=True)[1]) > 0).all() for c in (r.codes[MATCH],))
    code = Code(np.bincount(r.symbols, minlength=256))
    odds = answer(code, [first.keys, r.keys], [first.n, 0 * r.n])[1]
    r.prepare(code, odds)
    one = Reading(texts[:12]).prepare(code, answer(code, [first.keys], [first.n])[0])
    assert (Model(code).costs(r)[:12] == Model(code).costs(one)).all()


def test_keys_of_one_context_round_trip():
    for keys in (np.empty(0, "u8"), np.array([5], "u8"), np.arange(256, dtype="u8") + np.uint64(3 << 8), np.array([1 << 8, (1 << 64) - 1], "u8")):
        assert (unpack_keys(pack_keys(keys)) == keys).all()


def test_contexts_take_less_time_than_a_hash_of_each():
    """Contexts are hashed once for each different one: once it was once for each byte and predictor."""
    hashed = []
    once = lm_scoring.mixed
    texts = prose(9, 40, 400)
    try:
        lm_scoring.mixed = lambda h, order: hashed.append(len(h)) or once(h, order)
        Reading(texts)
    finally:
        lm_scoring.mixed = once
    assert 0 < sum(hashed) < sum(map(len, texts))

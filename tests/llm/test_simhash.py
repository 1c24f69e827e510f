import random
from collections import defaultdict

import xxhash
from pyspark.sql import functions as F

from tallyloom.llm.queries import QUERIES
from tallyloom.llm.shingle_sets import verified_components
from tallyloom.llm.simhash import _set_prints, classes, drop_linked, drop_near_duplicates


def plain_print(text):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").encode().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    h = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def plain_classes(prints, radius=3):
    """Class of each key, by comparing all pairs."""
    root = {k: k for k in prints}

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    keys = list(prints)
    for n, a in enumerate(keys):
        for b in keys[n + 1 :]:
            if (prints[a] ^ prints[b]).bit_count() <= radius:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {k: find(k) for k in keys}


def test_query_against_all_pairs(docs_of, folder_of, spark):
    rng = random.Random(1)
    base = [" ".join(rng.choices("ab Cd ef gh Äi jk lm no pq".split(), k=rng.randint(0, 300))) for _ in range(25)]
    texts = base + [b.replace("ab", "xy", 1) for b in base] + [b + " tail" for b in base] + base[:5] + [None, "", " \n"]
    folder = folder_of(documents=docs_of([(i, t, "s") for i, t in enumerate(texts)]))
    got = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in QUERIES["op8_simhash"](spark, folder).collect()}
    prints = {i: plain_print(t) for i, t in enumerate(texts)}
    want = plain_classes(prints)
    assert got == {i: (f"{prints[i]:016x}", want[i]) for i in prints}


def test_links_across_many_tiles(spark):
    rng = random.Random(2)
    codes = {}
    for _ in range(60):
        code = rng.getrandbits(64)
        for _ in range(4):
            codes.setdefault(code, len(codes))
            code ^= 1 << rng.randrange(64) | 1 << rng.randrange(64)
    rows = [(c.to_bytes(8, "little"),) for c in codes]
    got = defaultdict(set)
    for r in classes(spark.createDataFrame(rows, "fingerprint binary"), 3, 64, tile=16).collect():
        got[r["root"]].add(int.from_bytes(r["fingerprint"], "little"))
    want = defaultdict(set)
    for c, r in plain_classes({c: c for c in codes}).items():
        want[r].add(c)
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, want.values()))


def test_one_row_of_a_class_stays(docs_of, odd):
    words = [f"w{i}" for i in range(200)]
    other = [f"v{i}" for i in range(200)]
    rows = [(9, " ".join(words), "a"), (10, " ".join(words[:199] + ["new"]), "a"), (11, " ".join(other), "a"), *odd]
    docs = docs_of(rows)
    kept = drop_near_duplicates(docs, 52)
    assert kept.columns == docs.columns
    ids = sorted(r["doc_id"] or -1 for r in kept.collect())
    assert ids == [-1, 1, 2, 7, 8, 9, 11]


def test_empty_table(docs_of):
    assert drop_near_duplicates(docs_of([]), 52).count() == 0


def shingles(text):
    words = (text or "").lower().split()
    return {" ".join(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def plain_similar(texts):
    """Smallest index of the class of each text, by comparing all sets of shingles."""
    sets = [shingles(t) for t in texts]
    label = list(range(len(texts)))
    for i, a in enumerate(sets):
        for j in range(i):
            if len(a & sets[j]) >= 0.8 * len(a | sets[j]) - 1e-9 and label[i] != label[j]:
                x, y = label[i], label[j]
                label = [min(x, y) if k in (x, y) else k for k in label]
    return label


def test_only_similar_texts_go(docs_of):
    rng = random.Random(11)
    prose = lambda n: ["".join(rng.choices("abcdefgh", k=6)) for _ in range(n)]
    texts = []
    for n in (9, 10, 12, 13, 14, 30, 60, 150, 400):  # changes that leave similarities from 0.5 to 1
        base = prose(n)
        for cut in (0.05, 0.1, 0.15, 0.2, 0.3, 0.4):
            texts += [base[max(1, int(n * cut)) :] + prose(max(1, int(n * cut))), base[max(1, int(n * cut)) :], base[: n - 1], base[: n - 2]]
        texts.append(base)
    line = prose(5)
    texts += [line * 20 + prose(64) for _ in range(6)]  # one repeated line in common
    texts += [prose(6) for _ in range(150)] + [prose(n) for n in (3, 4, 5, 7) for _ in range(20)]
    texts = [" ".join(t) for t in texts]
    rng.shuffle(texts)
    want = {i for i, k in enumerate(plain_similar(texts)) if i == k}
    kept = {r["doc_id"] for r in drop_near_duplicates(docs_of([(i, t, "a") for i, t in enumerate(texts)]), 72).collect()}
    assert kept == want and len(texts) - len(want) > 60


def test_links_behind_refuted_ones_are_found(docs_of):
    words = [f"w{i}" for i in range(230)]
    texts = [" ".join(words[i : i + 60]) for i in (0, 1, 100, 101, 160, 161, 170)] + [" ".join(words[at : at + 60]) for at in (2, 3, 102, 162)]
    docs = docs_of([(i, t, "a") for i, t in enumerate(texts)])
    marked = _set_prints(docs, 5, 42, 256).select("doc_id", "key", F.col("doc.text").alias("text")).cache()
    hub = marked.where("doc_id = 6").select(F.col("key").alias("v"))
    proposed = marked.select(F.col("key").alias("u")).crossJoin(hub)
    for block in (2, 128):
        got = verified_components(proposed, marked.select("key", "text"), 5, 42, block).join(marked, F.col("node") == F.col("key")).collect()
        found = defaultdict(set)
        for r in got:
            found[bytes(r["component"])].add(r["doc_id"])
        want = defaultdict(set)
        for i, k in enumerate(plain_similar(texts)):
            want[k].add(i)
        assert sorted(map(sorted, found.values())) == sorted(sorted(c) for c in want.values() if len(c) > 1)


def test_one_row_of_linked_fingerprints_stays(docs_of, odd):
    rng = random.Random(21)
    base = [" ".join(rng.choices("ab cd ef gh ij kl".split(), k=rng.randint(50, 300))) for _ in range(20)]
    rows = [(100 + i, t, "s") for i, t in enumerate(base + base[:8] + [b + " tail" for b in base])] + [(101, base[1], "t"), (101, base[1], "s"), *odd]
    got = drop_linked(docs_of(rows)).collect()
    prints = {}
    for i, t, _ in rows:
        prints.setdefault((t or "", t is None), plain_print(t))
    by_text = plain_classes(prints)
    want = {}
    for i, t, _ in rows:
        root = by_text[t or "", t is None]
        want[root] = min(want.get(root, (True, 0)), (i is None, i or 0))
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in got) == sorted(want.values())
    assert len(got) < len(rows) - 8

import random
import re
from itertools import combinations

from tallyloom.llm.decontaminate import decontaminate, overlaps, short_masks
from tallyloom.llm.queries import QUERIES


def words(text):
    return re.findall(r"[^\W_]+", (text or "").lower())


def plain(docs, items, window=13, agree=0.8):
    """``(doc_id, item_id)`` with a window that agrees along some diagonal and holds a hit of a mask near it."""
    out = set()
    for d, text in docs:
        x = words(text)
        for n, item in items:
            y = words(item)
            w = min(window, len(y))
            for shift in range(-len(y), len(x) + 1):
                same = [0 <= i + shift < len(x) and x[i + shift] == v for i, v in enumerate(y)]
                if any(sum(same[s : s + w]) >= -(-w * agree // 1) for s in range(len(y) - w + 1)):
                    out.add((d, n))
    return out


def test_query_against_all_diagonals(docs_of, folder_of, spark):
    rng = random.Random(9)
    prose = lambda n: ["".join(rng.choices("abcdefgh", k=5)) for _ in range(n)]
    items = [prose(rng.randint(15, 40)) for _ in range(6)]
    docs = [prose(rng.randint(0, 80)) for _ in range(30)]
    for n, item in enumerate(items):
        leak = list(item)
        for at in range(3, len(leak), 9):  # a substitution in every ninth word
            leak[at] = "other"
        docs += [prose(20) + leak + prose(20), [w.upper() + "," for w in item], prose(5) + item[:6] + prose(30)]
    rows = [(i, " ".join(d), "s") for i, d in enumerate(docs)] + [(900, None, "s"), (901, "", None), (None, " ".join(items[0]), "s")]
    bench = [(n, " ".join(x)) for n, x in enumerate(items)] + [(50, None), (51, "too short")]
    folder = folder_of(documents=docs_of(rows), benchmark=spark.createDataFrame(bench, "item_id long, text string"))
    got = {(r["doc_id"], r["item_id"]) for r in QUERIES["op4_decontaminate"](spark, folder).collect()}
    want = plain([(i, t) for i, t, _ in rows], [b for b in bench if len(words(b[1])) >= 8])
    assert got == want and len(want) >= 13


def test_clean_rows_stay_and_empty_tables(docs_of, odd, spark):
    docs = docs_of(odd)
    bench = spark.createDataFrame([(1, "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu")], "item_id long, text string")
    assert decontaminate(docs, bench).count() == len(odd) and decontaminate(docs, bench).columns == docs.columns
    assert decontaminate(docs, bench.limit(0)).count() == len(odd)
    assert overlaps(docs_of([]), bench).count() == 0


def test_short_items_against_all_diagonals(docs_of, spark):
    rng = random.Random(10)
    prose = lambda n: ["".join(rng.choices("abcdefgh", k=5)) for _ in range(n)]
    items, docs = [(n, prose(n)) for n in range(1, 13)] + [(20, ["我们今天去公园散步"])], []
    for n, item in items:
        docs += [prose(10) + item + prose(10), item, item[1:] + prose(9), prose(9) + item[:-1], prose(3) + item[2:] + prose(3)]
        for lost in [*combinations(range(len(item)), 1), *combinations(range(len(item)), 2)]:
            docs.append(prose(4) + [("other" if i in lost else w) for i, w in enumerate(item)] + prose(4))
    rows = [(i, " ".join(d), "s") for i, d in enumerate(docs)]
    bench = [(n, " ".join(x)) for n, x in items]
    got = overlaps(docs_of(rows), spark.createDataFrame(bench, "item_id long, text string"))
    want = plain([(i, t) for i, t, _ in rows], bench)
    assert {(r["doc_id"], r["item_id"]) for r in got.collect()} == want and len(want) > 200


def test_allowed_substitutions_leave_a_seed():
    for n in range(1, 13):
        free = n - -(-8 * n // 10)
        for lost in combinations(range(n), free):
            kept = [i not in lost for i in range(n)]
            places = [(m, at) for m in short_masks(n, 0.8) for at in range(n - len(m) + 1)]
            assert any(all(kept[at + i] for i, c in enumerate(m) if c == "1") for m, at in places)


def test_items_without_an_id_and_clashing_names(docs_of, spark):
    from pyspark.sql import functions as F

    leak = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu"
    bench = spark.createDataFrame([(None, leak), (7, "one two three four five six"), (7, "ten nine eight seven six five")], "item_id long, text string")
    docs = docs_of([(1, f"so {leak} it", "s"), (2, "one two three four five six", "s"), (3, "ten nine eight seven six five", "s"), (4, "clean", "s")])
    docs = docs.withColumns({c: F.lit("x") for c in ("item_id", "item", "_k1", "_k2", "shift", "codes", "same")})
    found = {(r["doc_id"], r["item_id"]) for r in overlaps(docs, bench).collect()}
    assert found == {(1, None), (2, 7), (3, 7)}
    kept = decontaminate(docs, bench)
    assert kept.columns == docs.columns and [r["doc_id"] for r in kept.collect()] == [4]

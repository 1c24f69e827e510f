import random

from pyspark.sql import functions as F

from tallyloom.llm import lines as line_ops
from tallyloom.llm.lines import drop_repeated_lines, line_links, repeated_lines
from tallyloom.llm.queries import QUERIES


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, last = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
    return row[-1]


def mutate(rng, line, edits):
    for _ in range(edits):
        at, kind = rng.randrange(len(line)), rng.randrange(3)
        line = line[:at] + ("" if kind == 0 else rng.choice("abcé ")) + line[at + (kind != 1) :]
    return line


def test_query_against_all_pairs(docs_of, folder_of, spark):
    rng = random.Random(8)
    lines = ["".join(rng.choices("abcdé ", k=rng.randint(20, 60))) for _ in range(25)]
    lines += [mutate(rng, x, rng.randint(1, 4)) for x in lines * 4]
    texts = ["\n".join(rng.choices(lines, k=rng.randint(0, 5))) for _ in range(60)] + [None, "", "\n\n", texts_tail := lines[0]]
    folder = folder_of(documents=docs_of([(i, t, "s") for i, t in enumerate(texts)]))
    got = {r["doc_id"]: (r["n_lines"], r["removed"]) for r in QUERIES["op10_repeated_lines"](spark, folder).collect()}
    places = {(i, n): x for i, t in enumerate(texts) if t is not None for n, x in enumerate(t.split("\n")) if len(x) >= 24}
    known = sorted(set(places.values()))
    root = {x: x for x in known}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    pairs = 0
    for n, a in enumerate(known):
        for b in known[n + 1 :]:
            if abs(len(a) - len(b)) <= 2 and distance(a, b) <= 2:
                pairs += 1
                root[find(b)] = find(a)
    first = {}
    for place in sorted(places):
        first.setdefault(find(places[place]), place)
    want = {
        i: (0 if t is None else len(t.split("\n")), ",".join(str(n) for n in range(len((t or "").split("\n"))) if (i, n) in places and first[find(places[i, n])] != (i, n)))
        for i, t in enumerate(texts)
    }
    assert got == want and pairs > 20
    assert line_links(spark.read.parquet(f"{folder}/documents.parquet")).count() == pairs
    assert texts_tail


def test_odd_rows_and_empty_table(docs_of, odd):
    docs = docs_of(odd)
    left = drop_repeated_lines(docs)
    assert left.columns == docs.columns and left.count() == len(odd)
    texts = sorted((r["doc_id"] or 0, r["text"] is None, len(r["text"] or "")) for r in left.collect())
    assert texts.count((5, False, 0)) == 2 and (1, False, 27) in texts and (2, True, 0) in texts
    assert drop_repeated_lines(docs_of([])).count() == 0


def test_bit_parallel_distance(spark):
    rng = random.Random(4)
    rows = [("", ""), ("a", ""), ("", "ab"), (None, "a")]
    for _ in range(400):
        a = [rng.choice("abé") for _ in range(rng.randint(0, 14))]
        b = list(a)
        for _ in range(rng.randint(0, 5)):
            at = rng.randint(0, len(b))
            b[at : at + rng.randint(0, 1)] = [rng.choice("abé😀")] * rng.randint(0, 1)
        rows.append(("".join(a), "".join(b)))
    frame = spark.createDataFrame(rows, "u string, v string")
    for edits in (0, 1, 2, 4):
        same = line_ops.within("u", "v", edits).eqNullSafe(F.levenshtein("u", "v") <= edits)
        assert frame.where(~same).count() == 0
        assert frame.where(line_ops.within("u", "v", edits)).count() > 50
        may = frame.select("u", "v", line_ops._counts(F.col("u")).alias("a"), line_ops._counts(F.col("v")).alias("b"))
        assert may.where((F.levenshtein("u", "v") <= edits) & ~line_ops._may_be_close("a", "b", edits)).count() == 0


def test_short_lines_repeat_if_equal(docs_of):
    texts = ["Les.\nAll rights reserved.\n\nx", "\nAll rights reserved.\nx\nLes", "Les.\n\nAll rights reserved!\n ", " \nLes.", None, ""]
    rows = repeated_lines(docs_of([(i, t, "s") for i, t in enumerate(texts)])).collect()
    assert {r["doc_id"]: r["removed"] for r in rows} == {0: [], 1: [1, 2], 2: [0], 3: [0, 1], 4: [], 5: []}

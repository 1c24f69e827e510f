from collections import defaultdict

from pyspark.sql import functions as F

from tallyloom.llm.mixing import mix_sources, mixing_plan, source_targets


def by_rounds(sizes, weights=(3, 1, 2), share=1.5, cap=2.0):
    """Targets by handing out the excess again and again."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    full, left = {}, share * sum(sizes.values())
    while True:
        free = [s for s in names if s not in full]
        goal = {s: left * w[s] / sum(w[x] for x in free) for s in free}
        over = [s for s in free if goal[s] >= cap * sizes[s]]
        if not over:
            return full | goal
        for s in over:
            full[s] = cap * sizes[s]
            left -= full[s]


def test_targets(spark):
    sizes = {"b": 10, "a": 1000, None: 40, "Z": 7, "ä": 300, "zero": 0, "c": 5000}
    df = spark.createDataFrame([(s, n) for s, n in sizes.items()], "source string, size long")
    got = {r["source"]: r["target"] for r in source_targets(df).collect()}
    want = by_rounds(sizes)
    assert got.keys() == want.keys() and all(abs(got[s] - want[s]) < 1e-6 for s in want)


def test_mix_is_near_its_targets_and_repeatable(docs_of):
    rows = [(i, " ".join(["w"] * (1 + i % 9)), "ab"[i % 7 == 0]) for i in range(3000)]
    plan = mixing_plan(docs_of(rows)).select("doc.doc_id", "doc.source", "size", "target", "copies").collect()
    took, target = defaultdict(int), {}
    for r in plan:
        took[r["source"]] += r["size"] * r["copies"]
        target[r["source"]] = r["target"]
        assert 0 <= r["copies"] <= 2
    assert all(abs(took[s] / target[s] - 1) < 0.1 for s in target)
    again = mixing_plan(docs_of(rows, 7)).select("doc.doc_id", "copies").collect()
    assert {(r["doc_id"], r["copies"]) for r in plan} == {(r["doc_id"], r["copies"]) for r in again}


def test_odd_rows_and_clashing_columns(docs_of, odd):
    docs = docs_of(odd).withColumn("size", F.lit("mine")).withColumn("copies", F.lit(9)).withColumn("target", F.lit(0))
    mixed = mix_sources(docs)
    assert mixed.columns == docs.columns and mixed.count() > 0
    assert mixed.where("size <> 'mine' or copies <> 9").count() == 0


def test_empty_table(docs_of):
    assert mix_sources(docs_of([])).count() == 0

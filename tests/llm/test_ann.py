import numpy as np

from tallyloom.llm.queries import QUERIES


def exact(vectors, queries, k=5):
    out = {}
    for q in queries:
        if q not in vectors:
            continue
        a = vectors[q]
        score = {i: float((a * v).sum() / (np.sqrt((v * v).sum()) * np.sqrt((a * a).sum()))) for i, v in vectors.items() if i != q and len(v) == len(a)}
        out[q] = sorted(score.items(), key=lambda x: (-x[1], x[0]))[:k]
    return out


def test_query_against_all_pairs(folder_of, spark):
    rng = np.random.default_rng(3)
    centres = rng.standard_normal((20, 64))
    vectors = {i: (centres[rng.integers(20)] + 0.5 * rng.standard_normal(64)).astype("f4").astype("f8") for i in range(1500)}
    for i in range(200, 420):  # a large group of copies
        vectors[i] = vectors[150]
    vectors[50] = vectors[150] * 2
    rows = [(i, [float(x) for x in v]) for i, v in vectors.items()]
    odd = [(5000, None), (5050, []), (5100, [0.0] * 64), (5150, [1.0] + [None] * 63), (5200, [float("nan")] * 64), (5250, [float("inf")] * 64), (None, [1.0] * 64), (5300, [1.0, 2.0])]
    folder = folder_of(embeddings=spark.createDataFrame([*rows, *odd, rows[7]], "vec_id long, embedding array<float>").repartition(3))
    got = {}
    for r in QUERIES["op5_nearest"](spark, folder).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    want = exact(vectors, range(0, 1500, 50))
    assert got.keys() == want.keys()
    found = 0
    for q, near in got.items():
        assert [r for r, _, _ in near] == [1, 2, 3, 4, 5]
        found += len({i for _, i, _ in near} & {i for i, _ in want[q]})
    assert found / (5 * len(want)) >= 0.98
    # Ties of copies go to the smallest ids.
    assert [i for _, i, _ in got[200]][:5] == [50, 150, 201, 202, 203] or [i for _, i, _ in got[200]][:4] == [150, 201, 202, 203]


def test_few_and_none(folder_of, spark):
    folder = folder_of(embeddings=spark.createDataFrame([(0, [1.0, 0.0]), (1, [1.0, 1.0])], "vec_id long, embedding array<float>"))
    got = QUERIES["op5_nearest"](spark, folder).collect()
    assert [(r["query_id"], r["rank"], r["vec_id"]) for r in got] == [(0, 1, 1)]


def test_empty_table(folder_of, spark):
    folder = folder_of(embeddings=spark.createDataFrame([], "vec_id long, embedding array<float>"))
    assert QUERIES["op5_nearest"](spark, folder).count() == 0

from pathlib import Path

import numpy as np
import pandas as pd
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tallyloom.operators import products, recommend
from tallyloom.operators.products import largest_products
from tallyloom.session import LONG_ROWS, shared_root


def plain_products(users, items, seen, n):
    out = []
    for u, a in users.items():
        scored = [(-sum(x * y for x, y in zip(a, b)), i) for i, b in items.items() if (u, i) not in seen]
        out += [(u, i, k + 1) for k, (_, i) in enumerate(sorted(scored)[:n])]
    return sorted(out)


@pytest.mark.parametrize("blocks", [(7, 5), (1024, 4096)])
def test_largest_products_are_those_of_all_pairs(spark, blocks):
    rng = np.random.default_rng(4)
    # Whole numbers give many ties; a few very long factors let the search stop early for some users.
    users = {10**12 + i: rng.integers(-2, 3, 3).tolist() for i in range(40)} | {7: [0, 0, 0], 8: [100, 1, 1]}
    items = {f"i{k:03d}": (rng.integers(-2, 3, 3) * (20 if k % 37 == 0 else 1)).tolist() for k in range(150)}
    seen = {(u, i) for u in users for i in items if rng.random() < 0.1} | {(8, i) for i in items if i != "i140"}
    table = lambda d, key, kind: spark.createDataFrame([(k, [float(x) for x in v]) for k, v in d.items()], f"{key} {kind}, v array<double>").repartition(3)
    pairs = spark.createDataFrame([*seen, (99, "i001"), (8, "none")], "user long, item string")
    got = largest_products(table(users, "user", "long"), table(items, "item", "string"), pairs, 6, *blocks).collect()
    assert sorted((r["user"], r["item"], r["rank"]) for r in got) == plain_products(users, items, seen, 6)
    for r in got:
        assert r["score"] == sum(x * y for x, y in zip(users[r["user"]], items[r["item"]]))


def test_few_products_are_looked_at(monkeypatch):
    """The numbers that are put in order are the maxima of 16 columns, and the lists stay those of all products."""
    rng = np.random.default_rng(5)
    a, b = rng.integers(-3, 4, (50, 4)).astype(float), rng.integers(-3, 4, (1000, 4)).astype(float)
    seen, tie = np.nonzero(rng.random((50, 1000)) < 0.1), rng.permutation(1000)
    sizes, partition = [], np.partition
    monkeypatch.setattr(np, "partition", lambda x, *rest, **more: sizes.append(x.size) or partition(x, *rest, **more))
    rows, cols, scores = products.best_in_block(a, b, seen, tie, 6)
    assert sum(sizes) <= 50 * 63
    whole = a @ b.T
    whole[seen] = -np.inf
    want = [(u, i) for u in range(50) for i in np.lexsort((tie, -whole[u]))[:6]]
    assert list(zip(rows.tolist(), cols.tolist())) == want and (scores == whole[rows, cols]).all()


def test_largest_products_of_empty_tables(spark):
    none = spark.createDataFrame([], "user long, v array<double>")
    some = spark.createDataFrame([(1, [1.0])], "user long, v array<double>")
    items = some.withColumnRenamed("user", "item")
    seen = spark.createDataFrame([], "user long, item long")
    assert largest_products(none, items, seen, 3).count() == 0
    assert largest_products(some, items.limit(0), seen, 3).count() == 0
    assert largest_products(some, items, seen, 3).count() == 1


def test_als_takes_ids_of_any_size(spark):
    rows = [(10**15 + u, f"item {i}") for u in range(12) for i in range(10) if (u + i) % 3]
    likes = spark.createDataFrame([*rows, (None, "item 1"), (5, None)], "user long, item string")
    found = recommend.als_top_n(recommend.fit_als(likes, rank=3, max_iter=2, seed=1), likes, 3).collect()
    had = set(rows)
    assert found and all((r["user"], r["item"]) not in had for r in found)
    for u in {r["user"] for r in found}:
        assert sorted(r["rank"] for r in found if r["user"] == u) == [1, 2, 3]


def plain_content(likes, items, attrs, n):
    want = []
    for user, mine in likes.groupby("user"):
        got = mine.merge(items, on="item")
        score = sum(items[a].map(got[a].value_counts()).fillna(0) for a in attrs)
        table = items.assign(score=score)[~items["item"].isin(mine["item"])]
        best = table[table["score"] > 0].sort_values(["score", "item"], ascending=[False, True]).head(n)
        want += [(user, i, int(s)) for i, s in zip(best["item"], best["score"])]
    return sorted(want)


@pytest.mark.parametrize("blocks", [(3, 2), (512, 2048)])
def test_content_scores_with_a_user_who_took_nearly_all(spark, blocks):
    rng = np.random.default_rng(3)
    items = pd.DataFrame({"item": rng.permutation(80), "p": rng.choice(list("xyz"), 80), "q": rng.choice(list("uv"), 80), "s": rng.choice(list("klmn"), 80)})
    likes = pd.DataFrame({"user": rng.integers(1, 12, 150), "item": rng.integers(0, 80, 150)})
    hot = pd.DataFrame({"user": 0, "item": rng.permutation(80)[:72]})
    likes = pd.concat([likes, hot, hot.head(30)])
    found = recommend.content_scores(spark.createDataFrame(likes), spark.createDataFrame(items), list("pqs"), 4, *blocks).collect()
    assert sorted((r["user"], r["item"], r["score"]) for r in found) == plain_content(likes, items, list("pqs"), 4)


def test_candidates_hold_the_best_unseen_items():
    rng = np.random.default_rng(8)
    score = rng.integers(0, 6, (300, 40)).astype("i4")
    score[:, 0], score[:, 1] = 0, 1
    spent, seen = rng.random(score.shape) < 0.05, rng.random(score.shape) < 0.2
    rows, cols = recommend._candidates(score.copy(), np.nonzero(spent), np.nonzero(seen), 7)
    for user in range(40):
        found = rows[cols == user]
        usable = np.where(spent[:, user], 0, score[:, user])
        least = max(np.sort(usable)[-7], 1)
        equal = np.flatnonzero(usable == least)
        assert {*np.flatnonzero(usable > least), *equal[: 7 + seen[equal, user].sum()]} - set(found) == set()
        assert (usable[found] >= least).all() and len(found) == len(set(found)) <= 13 + seen[equal, user].sum()


def test_content_scores_without_attributes_or_likes(spark):
    items = spark.createDataFrame([(1, "a", None), (2, "a", "b"), (3, "a", "b")], "item long, p string, q string")
    likes = spark.createDataFrame([(1, 2), (None, 3), (4, 99)], "user long, item long")
    found = recommend.content_scores(likes, items, ["p", "q"], 5).where(F.col("user").isNotNull()).collect()
    assert [(r["user"], r["item"], r["score"]) for r in found] == [(1, 3, 2)]
    assert recommend.content_scores(likes.limit(0), items, ["p", "q"], 5).count() == 0


def test_an_item_never_seen_is_judged(spark):
    rows = [(c, s, int(c == "red")) for c in ("red", "blue", "green") for s in ("big", "small")] * 5
    fit, _, codes = recommend.fit_favourite(spark.createDataFrame(rows, ["color", "size", "label"]), ["color", "size"], "label", model="tree")
    new = spark.createDataFrame([("red", "huge"), ("blue", "huge"), ("green", "small")], ["color", "size"])
    found = recommend.predict_favourite(fit, codes, new)
    assert found.columns == ["color", "size", "prediction"]
    assert {(r["color"], r["size"]): r["prediction"] for r in found.collect()} == {("red", "huge"): 1, ("blue", "huge"): 0, ("green", "small"): 0}


def test_blocks_of_als_follow_the_ratings(spark, monkeypatch):
    """They were ten whatever the ratings, so that a block was too large for a task."""
    assert [recommend.als_blocks(n) for n in (0, 20_000_000, 20_000_001, 216_000_000)] == [10, 10, 11, 108]
    rng = np.random.default_rng(5)
    likes = spark.createDataFrame(pd.DataFrame({"user": rng.integers(0, 40, 600), "item": rng.integers(0, 30, 600)}))
    monkeypatch.setattr(recommend, "ALS_BLOCK", 20)
    used, fit = [], recommend.ALS.fit
    monkeypatch.setattr(recommend.ALS, "fit", lambda als, df: used.append((als.getNumUserBlocks(), als.getNumItemBlocks())) or fit(als, df))
    factors = recommend.fit_als(likes, rank=3, max_iter=2, seed=1)
    ratings = likes.distinct().count()
    assert used == [(-(-ratings // 20),) * 2] and used[0][0] > 10
    assert factors.users.count() == likes.select("user").distinct().count()
    assert factors.items.count() == likes.select("item").distinct().count()
    found = recommend.als_top_n(factors, likes, 3).collect()
    seen = {tuple(r) for r in likes.collect()}
    assert found and not seen & {(r["user"], r["item"]) for r in found}


def test_few_rows_of_long_arrays_to_a_file(spark):
    """A file's rows are read into one batch of columns: there were as many as a task had blocks."""
    rng = np.random.default_rng(6)
    likes = spark.createDataFrame(pd.DataFrame({"user": rng.integers(0, 300, 900), "item": rng.integers(0, 40, 900)}))
    items = spark.createDataFrame(pd.DataFrame({"item": range(40), "p": [f"p{i % 4}" for i in range(40)], "q": [f"q{i % 9}" for i in range(40)]}))
    root = Path(shared_root(spark).removeprefix("file:"))
    before = set(root.glob("*"))
    found = recommend.content_scores(likes, items, ["p", "q"], 3, user_block=2).collect()
    assert sorted((r["user"], r["item"], r["score"]) for r in found) == plain_content(likes.toPandas(), items.toPandas(), ["p", "q"], 3)
    sizes = {}
    for f in (f for folder in set(root.glob("*")) - before for f in folder.glob("**/*.parquet")):
        meta = pq.ParquetFile(f)
        sizes.setdefault(tuple(meta.schema_arrow.names), []).append(meta.metadata.num_rows)
    long = [n for names, ns in sizes.items() if {"us", "hu", "slots"} & set(names) for n in ns]
    assert sum(long) > 3 * LONG_ROWS and max(long) <= LONG_ROWS

"""Nulls, commas and ties are kept apart and lose no row."""

import pytest
from pyspark.sql import functions as F

from tallyloom.operators.aggregate import equal_sets
from tallyloom.operators.components import components
from tallyloom.operators.dbscan import dbscan
from tallyloom.operators.features import kfold_assign, split_stratified
from tallyloom.operators.metrics import confusion_matrix
from tallyloom.operators.order import running_sum, sliding_window
from tallyloom.operators.recommend import als_top_n, fit_als
from tallyloom.streaming.online import OnlineKMeans


def test_equal_sets_with_commas_and_nulls(spark):
    df = spark.createDataFrame([(["a,b"],), (["a", "b"],), (["a", None, "b"],), (["b", "a"],)], "s array<string>")
    assert sorted(r["n"] for r in equal_sets(df, "s").collect()) == [1, 1, 2]


def test_folds_keep_rows_without_a_label(spark):
    df = spark.createDataFrame([(i, [None, "x", "y"][i % 3]) for i in range(90)], "id long, label string")
    folds = kfold_assign(df, "id", "label", 5)
    assert {tuple(r) for r in folds.groupBy("label", "fold").count().select("label", "fold", "count").collect()} == {
        (label, fold, 6) for label in (None, "x", "y") for fold in range(5)
    }


def test_confusion_counts_null_classes(spark):
    df = spark.createDataFrame([("a", "a"), (None, "a"), ("b", None)], "y string, p string")
    rows = {(r["truth"], r["predicted"]): r["n"] for r in confusion_matrix(df, "y", "p").collect()}
    assert len(rows) == 9 and sum(rows.values()) == 3 and rows[None, "a"] == rows["b", None] == 1


@pytest.mark.parametrize("block_rows", [1000, 4, 1])
def test_windows_with_nulls(spark, block_rows):
    df = spark.createDataFrame([(i, None if i == 2 else i) for i in range(5)], "at long, v long")
    got = sliding_window(df, [], ["at"], "v", 3, block_rows=block_rows).orderBy("at").select("window").collect()
    assert [r[0] for r in got] == [[0, 1, None], [1, None, 3], [None, 3, 4]]


def test_components_of_a_long_chain_and_a_hub(spark):
    edges = [(i, i + 1) for i in range(0, 300)] + [(1000, 1000 + i) for i in range(1, 300)] + [(5000, 5000)]
    got = components(spark.createDataFrame(edges, "u long, v long"))
    assert {tuple(r) for r in got.groupBy("component").agg(F.count("*")).collect()} == {(0, 301), (1000, 300)}


def test_running_sums_of_ties_agree_on_both_paths(spark):
    df = spark.createDataFrame([(i % 3, 10 * i) for i in range(12)], "at long, v long")
    whole, blocks = ({tuple(r) for r in running_sum(df, [], "at", "v", block_rows=b).collect()} for b in (1000, 5))
    assert whole == blocks and max(r[2] for r in whole) == 660


def test_rows_without_a_place_are_noise(spark):
    rows = [(i, float("nan"), 0.0) for i in range(6)] + [(10 + i, 0.0, i / 10) for i in range(6)] + [(20, None, 0.0)]
    found = {r["id"]: (r["cluster"], r["core"]) for r in dbscan(spark.createDataFrame(rows, "id long, x double, y double"), "id", ["x", "y"], 1.0, 3).collect()}
    assert len(found) == 13 and all(found[i] == (-1, False) for i in (0, 5, 20)) and found[10] == (0, True)


def test_stratified_split_of_many_labels(spark):
    df = spark.range(6000).select("id", (F.when(F.col("id") % 4 > 0, F.col("id") % 1500)).alias("label"))
    train, test = split_stratified(df, "id", "label", 0.5)
    per = {r["label"]: r["count"] for r in train.groupBy("label").count().collect()}
    assert train.columns == df.columns and train.union(test).distinct().count() == 6000 and train.intersect(test).isEmpty()
    assert per.pop(None) == 750 and set(per.values()) == {2} and len(per) == 1125


def test_online_kmeans_finds_its_start_over_batches(spark, tmp_path):
    learner = OnlineKMeans(spark, ["x"], 3, str(tmp_path / "centres"))
    for i, xs in enumerate([[0.0, 0.0], [], [0.0, 50.0], [100.0, 50.0]]):
        learner.update(spark.createDataFrame([(x,) for x in xs], "x double"), i)
    assert sorted(c[0] for c in learner.fit().centres) == [0.0, 50.0, 100.0] and learner.counts().sum() == 6


def test_als_proposes_unseen_items_only(spark):
    pairs = [(u, i) for u in range(20) for i in range(30) if (u * 7 + i * 3) % 5 < 2] + [(50, i) for i in range(27)]
    likes = spark.createDataFrame(pairs, "user long, item long")
    got = als_top_n(fit_als(likes, seed=1), likes, 3).collect()
    ranks = {}
    for r in got:
        ranks.setdefault(r["user"], []).append(r["rank"])
    assert len(ranks) == 21 and all(sorted(v) == [1, 2, 3] for v in ranks.values())
    assert not {(r["user"], r["item"]) for r in got} & set(pairs)


def test_who_shares_a_set(spark):
    from tallyloom.operators.aggregate import rows_by_set

    rows = [(1, ["a", "b"]), (2, ["b", "a", "a"]), (3, ["a,b"]), (4, []), (5, None), (6, [None, "a"]), (7, ["a", None]), (None, [])]
    got = rows_by_set(spark.createDataFrame(rows, "id long, s array<string>"), "id", "s").collect()
    assert {r["id"]: (r["n"], r["first"]) for r in got} == {1: (2, 1), 2: (2, 1), 3: (1, 3), 4: (2, 4), 5: (1, 5), 6: (2, 6), 7: (2, 6), None: (2, 4)}
    keys = {r["id"]: r["set_key"] for r in got}
    assert keys[1] == keys[2] != keys[3] and keys[4] == keys[None]

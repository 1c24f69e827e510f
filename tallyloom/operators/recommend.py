"""Profiles and recommendations from ``likes(user, item)`` and ``items(item, attributes…)``."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml.recommendation import ALS
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallyloom.operators.classify import MlFit, fit_svm, fit_tree
from tallyloom.operators.features import encode_with, label_encode
from tallyloom.operators.order import enumerate_rows
from tallyloom.operators.products import largest_products
from tallyloom.session import cut_lineage
from tallyloom.sources.generate import unit_hash


def recommend_peers(df: DataFrame, item: str, cluster: str, n: int = 3, seed: int = 0) -> DataFrame:
    """``item, peer, rank``: up to n other members of each item's cluster.

    The members of a cluster are put in a seeded random order, and each item takes the n that follow it, the
    last ones starting again at the first. So n rows per item are made, never all pairs of a cluster.
    """
    shuffled = df.select(F.col(item).alias("item"), F.col(cluster).alias("cluster"))
    placed = enumerate_rows(shuffled, ["cluster", unit_hash(F.col("item"), seed=seed), F.col("item")], name="pos")
    size = placed.groupBy("cluster").agg(F.min("pos").alias("start"), F.count("*").alias("size"))
    ring = placed.join(size, "cluster")
    steps = F.sequence(F.lit(1).cast("long"), F.least(F.lit(n), F.col("size") - 1))
    wanted = ring.where("size > 1").select("item", "pos", "start", "size", F.explode(steps).alias("rank"))
    wanted = wanted.select("item", "rank", (F.col("start") + (F.col("pos") - F.col("start") + F.col("rank")) % F.col("size")).alias("pos"))
    return wanted.join(placed.select("pos", F.col("item").alias("peer")), "pos").select("item", "peer", "rank")


def recommend_for(df: DataFrame, item_col: str, cluster_col: str, item: object, n: int = 3, seed: int = 0) -> DataFrame:
    """Up to n members of the cluster of one item, the item itself included, as a seeded sample."""
    home = df.where(F.col(item_col) == F.lit(item)).select(cluster_col).limit(1).scalar()
    members = df.where(F.col(cluster_col) == home)
    return members.orderBy(unit_hash(F.col(item_col), seed=seed), item_col).limit(n)


def fit_favourite(
    df: DataFrame, attrs: Sequence[str], label: str, model: str = "svm", seed: int = 0
) -> tuple[MlFit, DataFrame, dict[str, DataFrame]]:
    """Learn a 0/1 label from encoded attributes: the fit, the encoded table and the code tables."""
    coded, codes = label_encode(df, attrs)
    coded = cut_lineage(coded)
    columns = [f"{a}_code" for a in attrs]
    fit = fit_svm(coded, columns, label, kernel="rbf", seed=seed) if model == "svm" else fit_tree(coded, columns, label, seed=seed)
    return fit, coded, codes


def predict_favourite(fit: MlFit, codes: dict[str, DataFrame], items: DataFrame, name: str = "prediction") -> DataFrame:
    """The prediction for items that were not there when the fit was made; a value never seen has the code -1."""
    coded = items
    for attr, table in codes.items():
        coded = encode_with(coded, attr, table, unseen=-1)
    return fit.predict(coded, name).select(*items.columns, name)


def _long(df: DataFrame, ids: Sequence[str], attrs: Sequence[str]) -> DataFrame:
    return df.unpivot(list(ids), list(attrs), "attr", "value")


def preference_counts(likes: DataFrame, items: DataFrame, attrs: Sequence[str]) -> DataFrame:
    """``user, attr, value, n``: how often a user liked each attribute value."""
    liked = likes.join(items, "item").select("user", *attrs)
    return _long(liked, ["user"], attrs).where("value IS NOT NULL").groupBy("user", "attr", "value").agg(F.count("*").alias("n"))


def user_profile(likes: DataFrame, items: DataFrame, attrs: Sequence[str]) -> DataFrame:
    """``user, attr, value, n``: the favourite value of every attribute (ties: smaller value)."""
    counts = preference_counts(likes, items, attrs)
    best = F.min(F.struct((-F.col("n")).alias("neg"), "value"))
    found = counts.groupBy("user", "attr").agg(best.alias("b"))
    return found.select("user", "attr", F.col("b.value").alias("value"), (-F.col("b.neg")).alias("n"))


def _combos(items: DataFrame, attrs: Sequence[str]) -> DataFrame:
    """Distinct attribute combinations: ``combo, <attrs>, size, first`` (the smallest item)."""
    grouped = items.dropna(subset=list(attrs)).groupBy(*attrs).agg(F.count("*").alias("size"), F.min("item").alias("first"))
    return cut_lineage(enumerate_rows(grouped, list(attrs), name="combo"))


def _candidates(score: np.ndarray, out: tuple[np.ndarray, np.ndarray], gone: tuple[np.ndarray, np.ndarray], n: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows (combinations, by their first item) and columns (users) that can hold one of a user's n best unseen items.

    Every combination with unseen items holds at least one, so those below the n-th best score are out; ``out`` says where
    all items are seen. Among equal scores the items with the smallest numbers win: a combination whose first unseen item
    comes after n others cannot win, and ``gone`` says where the first item is seen. Only scores from the n-th best maximum
    of 32 combinations up are looked at one by one, as the n-th best of all is no smaller.
    """
    score[out] = 0
    tops = np.maximum.reduceat(score, np.arange(0, len(score), 32), axis=0)
    least = np.partition(tops, -n, axis=0)[-n] if len(tops) >= n else np.zeros(score.shape[1], score.dtype)
    rows, cols = np.nonzero(score >= np.maximum(least, 1))
    if not len(rows):
        return rows, cols
    # By user and falling score; equal scores stay in the order of their first items.
    order = np.lexsort((-score[rows, cols], cols))
    rows, cols = rows[order], cols[order]
    value = score[rows, cols].astype("i8")
    place = np.arange(len(rows))
    new_user = np.r_[True, cols[1:] != cols[:-1]]
    new_level = new_user | np.r_[True, value[1:] != value[:-1]]
    level = np.flatnonzero(new_level)
    user_start, level_start = np.flatnonzero(new_user)[np.cumsum(new_user) - 1], level[np.cumsum(new_level) - 1]
    taken = np.zeros(score.shape, bool)
    taken[gone] = True
    more = np.add.reduceat(taken[rows, cols].astype("i8"), level)[np.cumsum(new_level) - 1]
    keep = (level_start - user_start < n) & (place - level_start < n + more)
    return rows[keep], cols[keep]


def _block_scores(profile: DataFrame, seen: DataFrame, combos: DataFrame, attrs: Sequence[str], n: int, users: int, width: int) -> DataFrame:
    """``user, combo, score, first`` of the combinations that can hold a user's n best unseen items.

    Users and combinations are cut into blocks. An equi-join on (attribute, value) gives each pair of blocks the counts of its
    users for the values that occur in it; the scores of the pair are then sums of columns of one matrix. No block grows
    with the data, and no user is handled alone.
    """
    numbered = cut_lineage(enumerate_rows(profile.select("user").distinct(), "user", name="_n"))
    numbered = numbered.select("user", F.floor(F.col("_n") / users).alias("ub"), (F.col("_n") % users).cast("int").alias("u"))
    placed = combos.withColumns({"cb": F.floor(F.col("combo") / width), "c": (F.col("combo") % width).cast("int")})
    long = _long(placed.select("cb", "c", *attrs), ["cb", "c"], attrs)
    values = long.select("cb", "attr", "value").distinct()
    slot = F.row_number().over(W.partitionBy("cb").orderBy("attr", "value")) - 1
    values = cut_lineage(values.withColumn("slot", slot))
    # Of each block: for every combination the slots of its values, its size and its first item.
    codes = long.join(values, ["cb", "attr", "value"]).groupBy("cb", "c").agg(F.sort_array(F.collect_list("slot")).alias("slots"))
    row = F.struct("c", "slots", "size", "first")
    blocks = codes.join(placed.select("cb", "c", "size", "first"), ["cb", "c"]).groupBy("cb").agg(F.sort_array(F.collect_list(row)).alias("r"))
    blocks = blocks.select("cb", F.flatten("r.slots").alias("slots"), F.col("r.size").alias("sizes"), F.col("r.first").alias("firsts"))
    blocks = cut_lineage(blocks, long_rows=True)
    counts = profile.join(numbered, "user").join(values, ["attr", "value"])
    counts = counts.groupBy("ub", "cb").agg(F.collect_list("u").alias("us"), F.collect_list("slot").alias("at_slots"), F.collect_list("n").alias("ns"))
    had = seen.join(numbered, "user").select("ub", "u", F.floor(F.col("combo") / width).alias("cb"), (F.col("combo") % width).cast("int").alias("c"), "had", "has_first")
    had = had.groupBy("ub", "cb").agg(F.collect_list("u").alias("hu"), F.collect_list("c").alias("hc"), F.collect_list("had").alias("hn"), F.collect_list("has_first").alias("hf"))
    tasks = max(int(profile.sparkSession.conf.get("spark.sql.shuffle.partitions")), profile.sparkSession.sparkContext.defaultParallelism)
    counts, had = cut_lineage(counts, long_rows=True), cut_lineage(had, long_rows=True)
    pairs = counts.join(blocks, "cb").join(had, ["ub", "cb"], "left").repartition(tasks, "ub", "cb")
    arity = len(attrs)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for p in frame.itertuples():
                slots, first = np.asarray(p.slots, int).reshape(-1, arity), np.asarray(p.firsts)
                by_first = np.argsort(first, kind="stable")
                # Values that nobody in the block likes share one row of zeros.
                liked, row = np.unique(np.asarray(p.at_slots, int), return_inverse=True)
                place = np.full(int(slots.max()) + 1, len(liked))
                place[liked] = np.arange(len(liked))
                slots = place[slots[by_first]]
                held, at = np.unique(np.asarray(p.us, int), return_inverse=True)
                ns = np.asarray(p.ns, "i8")
                kind = "i4" if int(ns.max()) * arity < 2**31 else "i8"
                hr = hc = hn = np.zeros(0, int)
                hf = np.zeros(0, bool)
                if p.hu is not None:
                    hu = np.asarray(p.hu, int)
                    some = np.isin(hu, held)
                    back = np.argsort(by_first)
                    hr, hc = np.searchsorted(held, hu[some]), back[np.asarray(p.hc, int)[some]]
                    hn, hf = np.asarray(p.hn, "i8")[some], np.asarray(p.hf, bool)[some]
                spent = np.asarray(p.sizes, "i8")[by_first][hc] <= hn
                # So few users at a time that their scores stay in the processor's caches.
                step = max(16, 2**20 // len(slots))
                for lo in range(0, len(held), step):
                    here, now = (at >= lo) & (at < lo + step), (hr >= lo) & (hr < lo + step)
                    matrix = np.zeros((len(liked) + 1, min(step, len(held) - lo)), kind)
                    matrix[row[here], at[here] - lo] = ns[here]
                    score = matrix[slots[:, 0]]
                    for k in range(1, arity):
                        score += matrix[slots[:, k]]
                    out, gone = ((hc[now & x], hr[now & x] - lo) for x in (spent, hf))
                    rows, cols = _candidates(score, out, gone, n)
                    which = by_first[rows]
                    yield pd.DataFrame({"ub": p.ub, "u": held[lo + cols], "combo": p.cb * width + which, "score": score[rows, cols].astype("i8"), "first": first[which]})

    kind = dict(combos.dtypes)["first"]
    found = pairs.mapInPandas(run, f"ub long, u int, combo long, score long, first {kind}")
    return found.join(numbered, ["ub", "u"]).select("user", "combo", "score", "first")


def content_scores(likes: DataFrame, items: DataFrame, attrs: Sequence[str], n: int, user_block: int = 512, combo_block: int = 16384) -> DataFrame:
    """``user, item, score, rank``: the n best unseen items of each user.

    The score adds up how often the user liked each attribute value of the item; items scoring 0 are left out,
    ties go to the smaller item. Items with the same attributes score the same, so combinations are scored, and
    only those that can reach the first n are opened up into items.
    """
    attrs = list(attrs)
    combos = _combos(items, attrs)
    placed = cut_lineage(items.join(combos.select("combo", "first", *attrs), attrs).select("item", "combo", "first"))
    bought = cut_lineage(likes.select("user", "item").distinct())
    seen = bought.join(placed, "item").groupBy("user", "combo").agg(
        F.count("*").alias("had"), F.bool_or(F.col("item") == F.col("first")).alias("has_first")
    )
    seen = cut_lineage(seen)
    profile = cut_lineage(preference_counts(likes, items, attrs))
    found = cut_lineage(_block_scores(profile, seen, combos, attrs, n, user_block, combo_block))
    # The same choice once more over all blocks: at most n combinations have a better score, and of those that score the same
    # the first n whose first item is unseen are enough.
    gone = seen.where("has_first").groupBy("user").agg(F.count("*").alias("gone"))
    level, equal = W.partitionBy("user").orderBy(F.desc("score")), W.partitionBy("user", "score").orderBy("first")
    best = found.withColumns({"level": F.rank().over(level)}).where(F.col("level") <= n).withColumn("place", F.row_number().over(equal))
    scores = best.join(gone, "user", "left").where(F.col("place") <= n + F.coalesce("gone", F.lit(0))).select("user", "combo", "score")
    # The first n + had items of a combination are enough: at most `had` of them drop out.
    listed = enumerate_rows(placed.select("combo", "item"), ["combo", "item"], name="pos")
    starts = listed.groupBy("combo").agg(F.min("pos").alias("start"))
    most = seen.groupBy("combo").agg(F.max("had").alias("most"))
    ranked = listed.join(starts, "combo").join(most, "combo", "left").withColumn("at", F.col("pos") - F.col("start") + 1)
    ranked = ranked.where(F.col("at") <= n + F.coalesce("most", F.lit(0))).select("combo", "item", "at")
    open_items = scores.join(seen.select("user", "combo", "had"), ["user", "combo"], "left").join(ranked, "combo")
    open_items = open_items.where(F.col("at") <= n + F.coalesce("had", F.lit(0)))
    fresh = open_items.select("user", "item", "score").join(bought, ["user", "item"], "left_anti")
    rank = F.row_number().over(W.partitionBy("user").orderBy(F.desc("score"), "item"))
    return fresh.withColumn("rank", rank).where(F.col("rank") <= n)


@dataclass(frozen=True)
class Factors:
    """``user, v`` and ``item, v``: a product of two vectors estimates how often the user takes the item."""

    users: DataFrame
    items: DataFrame


def _numbered(ids: DataFrame, key: str) -> DataFrame:
    """The different ids with numbers that Spark's solver takes."""
    return cut_lineage(enumerate_rows(ids.select(key).where(F.col(key).isNotNull()).distinct(), key, name=f"{key}_n"))


# A block of the solver is built, and gets the vectors it needs, in the memory of one task.
ALS_BLOCK = 2_000_000


def als_blocks(ratings: int) -> int:
    """Blocks on either side: those Spark takes by default, or more, so that no block grows with the ratings."""
    return max(10, -(-ratings // ALS_BLOCK))


def fit_als(likes: DataFrame, rank: int = 10, max_iter: int = 5, seed: int = 0) -> Factors:
    """Collaborative filtering on how often a user took an item. Ids of any type; rows with a null id take no part.

    The random start follows the blocks, so it is another one beyond 20 million ratings than a fixed number of blocks would have.
    """
    users, items = _numbered(likes, "user"), _numbered(likes, "item")
    ratings = likes.groupBy("user", "item").agg(F.count("*").cast("float").alias("rating"))
    ratings = ratings.join(users, "user").join(items, "item").select(F.col("user_n").cast("int"), F.col("item_n").cast("int"), "rating")
    ratings = cut_lineage(ratings)
    als = ALS(userCol="user_n", itemCol="item_n", ratingCol="rating", rank=rank, maxIter=max_iter, seed=seed)
    # More blocks need more copies of the vectors: where there is a checkpoint folder, those of a step go before the next but one.
    als = als.setNumBlocks(als_blocks(ratings.count())).setCheckpointInterval(1)
    model = als.fit(ratings)
    sides = ((model.userFactors, users, "user"), (model.itemFactors, items, "item"))
    found = [cut_lineage(f.join(ids, f["id"] == ids[f"{key}_n"]).select(key, F.col("features").alias("v"))) for f, ids, key in sides]
    return Factors(*found)


def als_top_n(factors: Factors, likes: DataFrame, n: int) -> DataFrame:
    """``user, item, score, rank``: the n best items of each user in ``likes`` that are not among their likes."""
    had = likes.select("user", "item").distinct()
    users = factors.users.join(had.select("user").distinct(), "user", "left_semi")
    return largest_products(users, factors.items, had, n)


def hybrid(content: DataFrame, collaborative: DataFrame, weight: float, n: int) -> DataFrame:
    """``user, item, score, rank``: weighted mean of both scores, each scaled to [0, 1] over its table.

    An item only one of the two lists proposes scores 0 in the other.
    """

    def scaled(df: DataFrame, name: str) -> DataFrame:
        ends = df.agg(F.min("score").alias("a"), F.max("score").alias("b")).first()
        span = (ends["b"] - ends["a"]) if ends["a"] is not None else 0
        value: Column = (F.col("score") - F.lit(ends["a"])) / F.lit(float(span)) if span else F.lit(1.0)
        return df.select("user", "item", value.alias(name))

    both = scaled(content, "_c").join(scaled(collaborative, "_k"), ["user", "item"], "full").fillna(0.0, ["_c", "_k"])
    mixed = both.select("user", "item", (F.lit(weight) * F.col("_c") + F.lit(1 - weight) * F.col("_k")).alias("score"))
    rank = F.row_number().over(W.partitionBy("user").orderBy(F.desc("score"), "item"))
    return mixed.withColumn("rank", rank).where(F.col("rank") <= n)


def catalogue_counts(items: DataFrame, attrs: Sequence[str], likes: DataFrame | None = None, user: object = None) -> DataFrame:
    """``attr, value, n`` over all items, or over the different items one user likes."""
    if user is not None:
        items = items.join(likes.where(F.col("user") == F.lit(user)).select("item").distinct(), "item", "left_semi")
    return _long(items.select(*attrs), [], attrs).groupBy("attr", "value").agg(F.count("*").alias("n"))


def clean_tags(tags: Column) -> Column:
    """Lower case, ``#`` and outer blanks dropped, empty ones and repeats left out."""
    bare = F.transform(tags, lambda x: F.trim(F.regexp_replace(F.lower(x), "^\\s*#+", "")))
    return F.array_distinct(F.filter(bare, lambda x: x != ""))


def tag_freq(df: DataFrame, tags: str) -> DataFrame:
    """``tag, n``: rows per cleaned tag."""
    return df.select(F.explode(clean_tags(F.col(tags))).alias("tag")).groupBy("tag").agg(F.count("*").alias("n"))

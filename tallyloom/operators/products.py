"""Largest inner products: for each user the items whose factors have the largest product with theirs.

Items are ordered by the length of their factors and cut into blocks; a round compares users with the next blocks, eight times
as many as the round before. A product is no larger than the product of the lengths (Cauchy-Schwarz), so a user whose n-th
best score exceeds that of the next block is done. Blocks meet by an equi-join, dealt out one pair a task row.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallyloom.operators.order import enumerate_rows
from tallyloom.session import cut_lineage

USERS, ITEMS = 1024, 4096


def _first_n(scores: np.ndarray, rows: np.ndarray, tie: np.ndarray, n: int) -> np.ndarray:
    """Of candidates the first n of each row by score, ties to the smaller ``tie``."""
    order = np.lexsort((tie, -scores, rows))
    starts = np.flatnonzero(np.r_[True, rows[order][1:] != rows[order][:-1]])
    rank = np.arange(len(order)) - np.repeat(starts, np.diff(np.r_[starts, len(order)]))
    return order[rank < n]


def best_in_block(a: np.ndarray, b: np.ndarray, seen: tuple[np.ndarray, np.ndarray], tie: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, column and product of the n largest products of each row, without the pairs in ``seen``.

    A matrix product, whose rounding depends on its shape, finds candidates with some slack; their scores are summed alike.
    Candidates start at the n-th best maximum of 16 columns, as the n-th best product of all is no smaller.
    """
    rough = a @ b.T
    rough[seen] = -np.inf
    if rough.shape[1] > n:
        slack = 1e-12 * np.linalg.norm(a, axis=1, keepdims=True) * np.linalg.norm(b, axis=1).max()
        wide = rough.shape[1] // 16
        tops = rough if wide < n else rough[:, : 16 * wide].reshape(len(rough), 16, wide).max(axis=1)
        least = np.partition(tops, -n, axis=1)[:, -n, None]
        rows, cols = np.nonzero(rough >= least - slack)
        finite = np.isfinite(rough[rows, cols])
        rows, cols = rows[finite], cols[finite]
    else:
        rows, cols = np.nonzero(np.isfinite(rough))
    scores = (a[rows] * b[cols]).sum(axis=1)
    keep = _first_n(scores, rows, tie[cols], n)
    return rows[keep], cols[keep], scores[keep]


def largest_products(users: DataFrame, items: DataFrame, seen: DataFrame, n: int, user_block: int = USERS, item_block: int = ITEMS) -> DataFrame:
    """``user, item, score, rank``: for each row of ``users`` (``user, v``) the n rows of ``items`` (``item, v``) with the
    largest products, without the pairs ``user, item`` of ``seen``; ties go to the smaller item.

    Ids are of any type that can be ordered. The lists are those of a comparison of all pairs.
    """
    length = F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x))
    plain = lambda df, key: df.select(F.col(key), F.col("v").cast("array<double>").alias("v")).withColumn("length", length)
    by_item = enumerate_rows(plain(items, "item").select("item"), "item", name="tie")
    placed_items = plain(items, "item").join(by_item, "item")
    placed_items = cut_lineage(enumerate_rows(placed_items, [F.desc("length"), "tie"], name="n").withColumns({"ib": F.floor(F.col("n") / item_block), "place": F.col("n") % item_block}))
    placed_users = enumerate_rows(plain(users, "user"), [F.desc("length"), "user"], name="n")
    placed_users = cut_lineage(placed_users.withColumns({"ub": F.floor(F.col("n") / user_block), "place": F.col("n") % user_block}))
    held = F.sort_array(F.collect_list(F.struct("place", "tie", "v")))
    item_rows = placed_items.groupBy("ib").agg(held.alias("r"), F.max("length").alias("longest"))
    item_rows = item_rows.select("ib", "longest", F.col("r.tie").alias("ties"), F.flatten("r.v").alias("factors"))
    item_rows = cut_lineage(item_rows, long_rows=True)
    bounds = item_rows.select("ib", "longest")
    last = item_rows.agg(F.max("ib").alias("m")).first()["m"]
    taken = seen.join(placed_users.select("user", "ub", F.col("place").alias("u")), "user").join(placed_items.select("item", "ib", F.col("place").alias("i")), "item")
    taken = cut_lineage(taken.select("ub", "ib", "u", "i").distinct())

    def compare(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for p in frame.itertuples():
                a, b = (np.asarray(x, float).reshape(-1, len(x) // len(of)) for x, of in ((p.vectors, p.places), (p.factors, p.ties)))
                places = np.asarray(p.places)
                us, its = (np.asarray(x, int) if x is not None else np.zeros(0, int) for x in (p.us, p.its))
                still = np.isin(us, places)
                # The places of a block are in order.
                gone = np.searchsorted(places, us[still]), its[still]
                rows, cols, scores = best_in_block(a, b, gone, np.asarray(p.ties), n)
                yield pd.DataFrame({"ub": p.ub, "place": places[rows], "ib": p.ib, "i": cols, "tie": np.asarray(p.ties)[cols], "score": scores})

    best = None
    open_users = placed_users.select("ub", "place", "v", "length")
    low, step = 0, 1
    tasks = max(int(users.sparkSession.conf.get("spark.sql.shuffle.partitions")), users.sparkSession.sparkContext.defaultParallelism)
    while last is not None and low <= last:
        high = min(low + step, last + 1)
        held = F.sort_array(F.collect_list(F.struct("place", "v")))
        user_rows = open_users.groupBy("ub").agg(held.alias("r")).select("ub", F.col("r.place").alias("places"), F.flatten("r.v").alias("vectors"))
        user_rows = user_rows.withColumn("ib", F.explode(F.sequence(F.lit(low), F.lit(high - 1)).cast("array<bigint>")))
        gone = taken.where(F.col("ib").between(low, high - 1)).groupBy("ub", "ib").agg(F.collect_list("u").alias("us"), F.collect_list("i").alias("its"))
        pairs = user_rows.join(item_rows.drop("longest"), "ib").join(gone, ["ub", "ib"], "left")
        pairs = pairs.select("ub", "ib", "places", "vectors", "ties", "factors", "us", "its").repartition(tasks, "ub", "ib")
        found = pairs.mapInPandas(compare, "ub long, place long, ib long, i long, tie long, score double")
        merged = found if best is None else best.unionByName(found)
        rank = F.row_number().over(W.partitionBy("ub", "place").orderBy(F.desc("score"), "tie"))
        best = cut_lineage(merged.withColumn("rank", rank).where(F.col("rank") <= n).drop("rank"))
        low, step = high, step * 8
        if low <= last:
            reach = bounds.where(F.col("ib") == low).select("longest").limit(1).scalar()
            nth = best.groupBy("ub", "place").agg(F.count("*").alias("found"), F.min("score").alias("nth"))
            rest = placed_users.select("ub", "place", "v", "length").join(nth, ["ub", "place"], "left")
            # Rounding must not end a search: the bound gets some slack.
            done = (F.col("found") >= n) & (F.col("nth") > F.col("length") * reach * (1 + 1e-9))
            open_users = cut_lineage(rest.where(~F.coalesce(done, F.lit(False))).select("ub", "place", "v", "length"))
            if open_users.isEmpty():
                break
    if best is None:
        kinds = dict(users.dtypes)["user"], dict(items.dtypes)["item"]
        return users.sparkSession.createDataFrame([], f"user {kinds[0]}, item {kinds[1]}, score double, rank int")
    named = best.join(placed_users.select("ub", "place", "user"), ["ub", "place"]).join(placed_items.select("ib", F.col("place").alias("i"), "item"), ["ib", "i"])
    order = F.row_number().over(W.partitionBy("user").orderBy(F.desc("score"), "item"))
    return named.select("user", "item", "score", order.alias("rank"))

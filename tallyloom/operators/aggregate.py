"""Counts, summaries, histograms and top items."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from functools import reduce as fold

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallyloom.operators.quantiles import exact_quantiles
from tallyloom.session import cut_lineage


def total_chars(lines: DataFrame, col: str = "value") -> DataFrame:
    return lines.agg(F.coalesce(F.sum(F.length(col)), F.lit(0)).alias("chars"))


def total_tokens(lines: DataFrame, sep: str, col: str = "value") -> DataFrame:
    """Tokens between separators; empty ones count."""
    return lines.agg(F.coalesce(F.sum(F.size(F.split(col, r"\Q" + sep + r"\E"))), F.lit(0)).alias("tokens"))


def pattern_count(lines: DataFrame, regex: str, col: str = "value") -> DataFrame:
    """Matches of a pattern over all lines."""
    return lines.agg(F.coalesce(F.sum(F.regexp_count(col, F.lit(regex))), F.lit(0)).alias("matches"))


def count_where(df: DataFrame, cond: Column) -> DataFrame:
    """``rows, hits, share``: how many rows there are and for how many the condition holds."""
    hits = F.count_if(cond)
    return df.agg(F.count("*").alias("rows"), hits.alias("hits"), (hits / F.count("*")).alias("share"))


def group_size(df: DataFrame, keys: Sequence[Column | str]) -> DataFrame:
    """Rows per key."""
    return df.groupBy(*keys).agg(F.count("*").alias("n"))


def group_counts(df: DataFrame, key: str) -> DataFrame:
    """Non-null values per key, for every other column."""
    return df.groupBy(key).agg(*[F.count(c).alias(c) for c in df.columns if c != key])


def value_counts(df: DataFrame, col: str) -> DataFrame:
    """Rows per value, most frequent first, nulls left out."""
    counts = df.where(F.col(col).isNotNull()).groupBy(col).agg(F.count("*").alias("n"))
    return counts.orderBy(F.desc("n"), col)


def distinct_values(df: DataFrame, col: str) -> DataFrame:
    return df.select(col).distinct()


def describe_numeric(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """``column, count, mean, std, min, q25, q50, q75, max`` with sample deviation and exact quartiles."""
    stats = {"count": F.count, "mean": F.avg, "std": F.stddev_samp, "min": F.min, "max": F.max}
    rows = [
        F.struct(F.lit(c).alias("column"), *[fn(F.col(c).cast("double")).alias(s) for s, fn in stats.items()])
        for c in cols
    ]
    base = df.agg(F.array(*rows).alias("r")).select(F.inline("r"))
    quarts = exact_quantiles(df, cols, [0.25, 0.5, 0.75])
    q = quarts.groupBy("column").agg(
        *[F.max(F.when(F.col("prob") == p, F.col("value"))).alias(f"q{int(p * 100)}") for p in (0.25, 0.5, 0.75)]
    )
    return base.join(q, "column").select("column", "count", "mean", "std", "min", "q25", "q50", "q75", "max")


def describe_text(df: DataFrame, col: str) -> DataFrame:
    """``count, unique, top, freq``; the smaller text wins a tie."""
    counts = df.where(F.col(col).isNotNull()).groupBy(col).agg(F.count("*").alias("n"))
    best = F.min_by(F.struct(F.col(col).alias("top"), F.col("n").alias("freq")), F.struct(-F.col("n"), F.col(col)))
    summed = counts.agg(F.sum("n").alias("count"), F.count("*").alias("unique"), best.alias("best"))
    return summed.select("count", "unique", "best.top", "best.freq")


def extremes(df: DataFrame, value: str, label: str) -> DataFrame:
    """Smallest and largest value with the label of their row (ties: smallest label)."""
    low = F.min(F.struct(value, label))
    high = F.min_by(F.struct(value, label), F.struct(-F.col(value), F.col(label)))
    both = df.where(F.col(value).isNotNull()).agg(low.alias("low"), high.alias("high"))
    return both.select(
        F.col(f"low.{value}").alias("min_value"),
        F.col(f"low.{label}").alias("min_label"),
        F.col(f"high.{value}").alias("max_value"),
        F.col(f"high.{label}").alias("max_label"),
    )


def fold_aggs(df: DataFrame, value: str, factor: Column) -> DataFrame:
    """``total, product, largest``: sum and maximum of a column, product of a factor."""
    return df.agg(F.sum(value).alias("total"), F.product(factor).alias("product"), F.max(value).alias("largest"))


def total_value(df: DataFrame, price: Column, qty: Column, by: str | None = None) -> DataFrame:
    """Sum of price × quantity, over all rows or per category."""
    grouped = df.groupBy(by) if by else df.groupBy()
    return grouped.agg(F.sum(price * qty).alias("total"))


def net_balance(df: DataFrame, is_income: Column, amount: Column, by: Sequence[str] = ()) -> DataFrame:
    """``income, expense, balance, largest_expense`` over all rows or per group."""
    spent = F.when(~is_income, amount)
    return df.groupBy(*by).agg(
        F.coalesce(F.sum(F.when(is_income, amount)), F.lit(0.0)).alias("income"),
        F.coalesce(F.sum(spent), F.lit(0.0)).alias("expense"),
        F.sum(F.when(is_income, amount).otherwise(-amount)).alias("balance"),
        F.max(spent).alias("largest_expense"),
    )


def module_stats(df: DataFrame, id_cols: Sequence[str], modules: Sequence[str]) -> DataFrame:
    """Mean, best and worst grade per module, from one column per module."""
    long = df.unpivot(list(id_cols), list(modules), "module", "grade")
    return long.groupBy("module").agg(
        F.avg("grade").alias("mean"), F.max("grade").alias("best"), F.min("grade").alias("worst")
    )


def safe_mean(df: DataFrame, col: str, digits: int = 2) -> DataFrame:
    """Rounded mean; 0 for no rows."""
    return df.agg(F.coalesce(F.round(F.avg(col), digits), F.lit(0.0)).alias("mean"))


def three_means(df: DataFrame, col: str) -> DataFrame:
    """Arithmetic, geometric and harmonic mean of positive values."""
    x = F.col(col)
    return df.agg(
        F.avg(x).alias("arithmetic"),
        F.exp(F.avg(F.ln(x))).alias("geometric"),
        (F.count(x) / F.sum(1 / x)).alias("harmonic"),
    )


def binned_stats(hist: DataFrame, bin_col: str, n: str, by: Sequence[str] = ()) -> DataFrame:
    """Mean, population variance and deviation of values given as bins with counts."""
    x, w = F.col(bin_col), F.col(n)
    mean = F.sum(x * w) / F.sum(w)
    square = F.sum(x * x * w) / F.sum(w)
    stats = hist.groupBy(*by).agg(mean.alias("mean"), (square - mean * mean).alias("variance"))
    return stats.withColumn("std", F.sqrt(F.greatest("variance", F.lit(0.0))))


def latest_per_key(df: DataFrame, key: str, year: Column, ties: Sequence[str]) -> DataFrame:
    """The row with the last year of each key; ties go to the smallest of the tie columns.

    A partial aggregate keeps one row per key and task, so a key with very many rows is no burden.
    """
    rest = [c for c in df.columns if c != key]
    rank = F.struct((-year.cast("double")).alias("_y"), *[F.col(t) for t in ties])
    best = df.groupBy(key).agg(F.min_by(F.struct(*rest), rank).alias("_row"))
    return best.select(key, "_row.*")


def latest_extremes(df: DataFrame, key: str, year: Column, value: str, ties: Sequence[str]) -> DataFrame:
    """The keys whose latest value is smallest and largest."""
    return extremes(latest_per_key(df, key, year, ties), value, key)


def top_per_group(df: DataFrame, group: str, item: str, n: int = 1) -> DataFrame:
    """The n most frequent items of each group: ``group, item, n, rank`` (ties: smaller item)."""
    counts = df.groupBy(group, item).agg(F.count("*").alias("n"))
    rank = F.row_number().over(W.partitionBy(group).orderBy(F.desc("n"), F.asc(item)))
    return counts.withColumn("rank", rank).where(F.col("rank") <= n)


def top_items(df: DataFrame, item: str, n: int) -> DataFrame:
    """The n most frequent items (ties: smaller item)."""
    return df.groupBy(item).agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.asc(item)).limit(n)


def find_duplicates(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Combinations that occur more than once, with their count."""
    return df.groupBy(*cols).agg(F.count("*").alias("n")).where("n > 1")


def pivot_counts(df: DataFrame, row: str, col: str, values: Sequence[str]) -> DataFrame:
    """Counts with one column per given value; 0 where there are none."""
    return df.groupBy(row).pivot(col, list(values)).count().fillna(0, list(values))


def daily_counts(df: DataFrame, ts: Column) -> DataFrame:
    """Rows per day."""
    return df.groupBy(F.date_trunc("day", ts).alias("day")).agg(F.count("*").alias("n"))


def histogram(df: DataFrame, col: str, bins: int, density: bool = False) -> DataFrame:
    """Equal-width bins between minimum and maximum, the last one closed: ``bin, lo, hi, n``.

    Empty bins are listed; ``density`` adds a column so that the bars have area 1.
    """
    x = F.col(col).cast("double")
    ends = df.agg(F.min(x).alias("lo"), F.max(x).alias("hi")).first()
    if ends["lo"] is None:
        return df.sparkSession.createDataFrame([], "bin int, lo double, hi double, n long" + ", density double" * density)
    lo, hi = float(ends["lo"]), float(ends["hi"])
    if lo == hi:
        lo, hi = lo - 0.5, hi + 0.5
    width = (hi - lo) / bins
    slot = F.least(F.width_bucket(x, F.lit(lo), F.lit(hi), F.lit(bins).cast("int")), F.lit(bins)) - 1
    counts = df.where(x.isNotNull()).groupBy(slot.cast("int").alias("bin")).agg(F.count("*").alias("n"))
    frame = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    table = frame.join(counts, "bin", "left").select(
        "bin",
        (F.lit(lo) + F.col("bin") * width).alias("lo"),
        (F.lit(lo) + (F.col("bin") + 1) * width).alias("hi"),
        F.coalesce("n", F.lit(0)).alias("n"),
    )
    if density:
        rows = df.agg(F.count(x)).scalar()
        table = table.withColumn("density", F.col("n") / (rows * F.lit(width)))
    return table


def set_popularity(df: DataFrame, set_col: str) -> DataFrame:
    """Per element: rows that hold it, and whether all or just one of them do."""
    rows = df.agg(F.count("*")).scalar()
    held = df.select(F.explode(F.array_distinct(set_col)).alias("element")).groupBy("element").agg(F.count("*").alias("n"))
    return held.select("element", "n", (F.col("n") == rows).alias("in_all"), (F.col("n") == 1).alias("in_one"))


def rows_by_set(df: DataFrame, id_col: str, set_col: str) -> DataFrame:
    """Who shares a set: ``id, members, set_key, n, first`` for each row, however many share it.

    ``set_key`` is the same for equal sets, ``n`` counts their rows and ``first`` is the smallest id among them. A row a set,
    never a list of the rows that share it; ``members`` as in ``equal_sets``. Null is a set of its own.
    """
    sets = df.select(F.col(id_col).alias("id"), F.sort_array(F.array_distinct(set_col)).alias("_set"))
    keyed = cut_lineage(sets.select("id", F.array_join("_set", ",").alias("members"), F.sha2(F.to_json(F.struct("_set")), 256).alias("set_key")))
    sizes = keyed.groupBy("set_key").agg(F.count("*").alias("n"), F.min("id").alias("first"))
    return keyed.join(cut_lineage(sizes), "set_key").select("id", "members", "set_key", "n", "first")


def equal_sets(df: DataFrame, set_col: str) -> DataFrame:
    """How many rows share each set: ``members, n``; members are sorted and joined by commas.

    Sets are told apart by their members, whatever commas or nulls these hold; only the label may read the same then.
    """
    sets = df.groupBy(F.sort_array(F.array_distinct(set_col)).alias("_set")).agg(F.count("*").alias("n"))
    return sets.select(F.array_join("_set", ",").alias("members"), "n")


def monthly_extremes(df: DataFrame, month: Column, value: Column, n: int) -> DataFrame:
    """The n best and n worst months by total, each against the monthly average."""
    months = df.groupBy(month.alias("month")).agg(F.sum(value).alias("total"))
    average = months.agg(F.avg("total")).scalar()
    best = months.orderBy(F.desc("total"), "month").limit(n).withColumn("kind", F.lit("best"))
    worst = months.orderBy(F.asc("total"), "month").limit(n).withColumn("kind", F.lit("worst"))
    return best.unionByName(worst).select("kind", "month", "total", (F.col("total") - average).alias("above_average"))


def correlation(df: DataFrame, x: Column, y: Column) -> DataFrame:
    return df.agg(F.corr(x, y).alias("corr"))


def map_reduce(
    df: DataFrame,
    col: str,
    map_fn: Callable[[object], object],
    reduce_fn: Callable[[object, object], object],
    result_type: str = "long",
    fan_in: int = 64,
) -> DataFrame:
    """Fold a column with Python callables: one partial result per partition, merged in two more steps.

    ``reduce_fn`` must be associative and commutative. Returns one row ``result`` (null without rows).
    """
    schema = f"result {result_type}"

    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        state = [fold(reduce_fn, (map_fn(v) for v in b.iloc[:, 0])) for b in batches if len(b)]
        if state:
            yield pd.DataFrame({"result": [fold(reduce_fn, state)]})

    def merge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        state = [fold(reduce_fn, b["result"].tolist()) for b in batches if len(b)]
        if state:
            yield pd.DataFrame({"result": [fold(reduce_fn, state)]})

    partials = df.select(col).mapInPandas(partial, schema)
    merged = partials.repartition(fan_in).mapInPandas(merge, schema).repartition(1).mapInPandas(merge, schema)
    # One row at most; the aggregate turns none into a null.
    return merged.agg(F.first("result").alias("result"))

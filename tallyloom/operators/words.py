"""Corpus-level text work: statistics, frequencies, folds, logs and pages."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.functions import text
from tallyloom.operators.order import Order, enumerate_rows


def words_of(df: DataFrame, col: str) -> DataFrame:
    """One row per lower-case word."""
    return df.select(F.explode(text.split_text(F.lower(F.col(col)))).alias("word"))


def corpus_stats(df: DataFrame, col: str, id_col: str) -> DataFrame:
    """``texts, words, mean_words, unique_words, longest_id``: the longest text is the one with most characters.

    Distinct words are counted through a grouping, so their number is no matter of one task's memory.
    """
    n = text.word_count(F.col(col))
    longest = F.min_by(id_col, F.struct(-F.length(col), F.col(id_col)))
    sums = df.agg(
        F.count("*").alias("texts"), F.sum(n).alias("words"), F.avg(n).alias("mean_words"), longest.alias("longest_id")
    )
    unique = words_of(df, col).distinct().agg(F.count("*")).scalar()
    return sums.select("texts", "words", "mean_words", unique.alias("unique_words"), "longest_id")


def word_freq(df: DataFrame, col: str, n: int | None = None) -> DataFrame:
    """Case-insensitive word counts; the n most frequent if asked (ties: smaller word)."""
    counts = words_of(df, col).groupBy("word").agg(F.count("*").alias("n"))
    return counts if n is None else counts.orderBy(F.desc("n"), "word").limit(n)


def longest(df: DataFrame, col: str, id_col: str) -> DataFrame:
    """The id and length of the longest text (ties: smallest id)."""
    best = F.min(F.struct((-F.length(col)).alias("l"), F.col(id_col).alias("id")))
    found = df.where(F.col(col).isNotNull()).agg(best.alias("b"))
    return found.select(F.col("b.id").alias("id"), (-F.col("b.l")).alias("length"))


def join_rows(df: DataFrame, part: Sequence[str], col: str, sep: str, order: Order | Sequence[Order]) -> DataFrame:
    """Concatenate the texts of each group in a stated order: ``joined``.

    The result is one value, so a group has to fit into one row in any case.
    """
    keys = [order] if isinstance(order, (str, Column)) else list(order)
    keyed = df.select(*part, F.struct(*[F.col(k) if isinstance(k, str) else k for k in keys], F.col(col).alias("_t")).alias("_r"))
    packed = keyed.groupBy(*part).agg(F.sort_array(F.collect_list("_r")).alias("_rows"))
    return packed.select(*part, F.array_join(F.transform("_rows", lambda r: r["_t"]), sep).alias("joined"))


def parse_log(df: DataFrame, col: str) -> DataFrame:
    """``ts, level, message`` of the lines that have the log form."""
    return df.select(text.log_fields(F.col(col)).alias("_l")).where("_l IS NOT NULL").select("_l.*")


def errors(df: DataFrame, col: str, level: str = "ERROR") -> DataFrame:
    """Time and message of the lines at a level."""
    return parse_log(df, col).where(F.col("level") == level).select("ts", "message")


def sum_first_numbers(lines: DataFrame, col: str, n: int = 100) -> DataFrame:
    """Sum of the n smallest numbers found in ``Line N: …`` lines."""
    numbers = lines.select(text.line_number(F.col(col)).alias("number")).where("number IS NOT NULL")
    return numbers.orderBy("number").limit(n).agg(F.sum("number").alias("total"), F.count("*").alias("lines"))


def html_stats(df: DataFrame, id_col: str, col: str, first: int = 20) -> DataFrame:
    """Characters, lines, words, distinct words and the first words of each page."""
    words = text.split_text(F.col(col))
    return df.select(
        id_col,
        F.length(col).alias("chars"),
        F.size(F.split(col, "\n")).alias("lines"),
        F.size(words).alias("words"),
        F.size(F.array_distinct(words)).alias("distinct_words"),
        F.array_join(F.slice(words, 1, first), " ").alias("first_words"),
    )


def most_links(df: DataFrame, id_col: str, col: str) -> DataFrame:
    """The page with most anchors (ties: smallest id)."""
    best = F.min(F.struct((-text.link_count(F.col(col))).alias("l"), F.col(id_col).alias("id")))
    return df.agg(best.alias("b")).select(F.col("b.id").alias("id"), (-F.col("b.l")).alias("links"))


def numbered_lines(df: DataFrame, col: str, order: Order | Sequence[Order]) -> DataFrame:
    """``Line N: text`` lines from a table, numbered in order."""
    placed = enumerate_rows(df, order, name="_n")
    return placed.select(F.concat(F.lit("Line "), F.col("_n").cast("string"), F.lit(": "), F.col(col)).alias("value"))



"""Running results over arriving rows; each function is a plan, batch or streaming alike."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.functions import text
from tallyloom.functions.numbers import is_prime


def prime_stream(numbers: DataFrame, col: str) -> DataFrame:
    """``is_prime, n, largest``: a running summary of the primes among arriving numbers."""
    tested = numbers.select(F.col(col).alias("v"), is_prime(F.col(col)).alias("is_prime"))
    return tested.groupBy("is_prime").agg(F.count("*").alias("n"), F.max("v").alias("largest"))


def error_stream(lines: DataFrame, col: str = "value", level: str = "ERROR") -> DataFrame:
    """``ts, message`` of the log lines at a level; one line in, at most one row out."""
    parsed = lines.select(text.log_fields(F.col(col)).alias("l"))
    return parsed.where(F.col("l.level") == level).select("l.ts", "l.message")


def running_word_count(lines: DataFrame, col: str = "value") -> DataFrame:
    """``word, n`` over all lines so far, ignoring case."""
    words = lines.select(F.explode(text.split_text(F.lower(F.col(col)))).alias("word"))
    return words.groupBy("word").agg(F.count("*").alias("n"))


def running_value_count(rows: DataFrame, col: str) -> DataFrame:
    """``value, n`` over all rows so far."""
    return rows.groupBy(F.col(col).alias("value")).agg(F.count("*").alias("n"))

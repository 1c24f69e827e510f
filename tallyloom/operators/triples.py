"""Pattern matching on statement tables ``triples(s, p, o, lang)`` and ``statements(s, p, st, value, date)``."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _values(triples: DataFrame, prop: str, name: str, lang: str | None = None) -> DataFrame:
    hit = F.col("p") == prop
    if lang is not None:
        hit = hit & (F.col("lang") == lang)
    return triples.where(hit).select("s", F.col("o").alias(name))


def match_triples(
    triples: DataFrame, of_type: str, props: Mapping[str, str], lang: str | None = None
) -> DataFrame:
    """Subjects of a type with one column per property (``{column: property}``).

    A subject must have every property; ``lang`` restricts the ``label`` property.
    """
    found = triples.where((F.col("p") == "type") & (F.col("o") == of_type)).select("s")
    for name, prop in props.items():
        found = found.join(_values(triples, prop, name, lang if prop == "label" else None), "s")
    return found


def match_statements(
    triples: DataFrame, statements: DataFrame, prop: str, qualifier: str, of_type: str | None = None
) -> DataFrame:
    """Distinct ``s, value, qualifier`` of the qualified statements with a property, for subjects of a type."""
    facts = statements.where(F.col("p") == prop).select("s", "value", qualifier)
    if of_type is not None:
        kind = triples.where((F.col("p") == "type") & (F.col("o") == of_type)).select("s").distinct()
        facts = facts.join(kind, "s", "left_semi")
    return facts.distinct()


def with_labels(df: DataFrame, triples: DataFrame, cols: Sequence[str], lang: str) -> DataFrame:
    """Add ``<col>_label`` for each id column; an id without a label in the language labels itself."""
    for col in cols:
        names = _values(triples, "label", f"{col}_label", lang).withColumnRenamed("s", col)
        df = df.join(names, col, "left").withColumn(f"{col}_label", F.coalesce(f"{col}_label", col))
    return df

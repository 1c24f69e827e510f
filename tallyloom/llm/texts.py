"""What the text operators share: the definition of a word and rows without a usable text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# A word is a run of bytes other than space, tab, line feed, vertical tab, form feed and carriage return.
WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: str | Column) -> Column:
    """Number of words of a text; null counts as empty."""
    return F.size(F.regexp_extract_all(F.coalesce(text if isinstance(text, Column) else F.col(text), F.lit("")), F.lit(WORD), 0)).cast("long")


def words_of(text: str | None) -> list[bytes]:
    """The words of a text as UTF-8, A-Z lower-cased. ``bytes`` knows exactly the six white space bytes above."""
    return (text or "").encode("utf-8", "replace").lower().split()

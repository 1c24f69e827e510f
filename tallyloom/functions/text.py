"""Text, URL, HTML and log-line functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Patterns shared by the functions below. White space is what Unicode counts as such. Both classes
# settle printable ASCII with their first range, which is what most characters need.
_BLANKS = r"\t-\r\x1c-\x20\u0085\u00a0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
SPACE = rf"[[^!-~]&&[{_BLANKS}]]"
WORD = rf"[!-~[^{_BLANKS}]]+"
PUNCTUATION = r"[!-/:-@\[-`{-~]"
LOG_LINE = r"^(\S+ \S+) \[(\w+)\] (.*)$"
NUMBERED_LINE = r"^Line (\d+):"
WKT_POINT = r"^Point\(\s*(-?[0-9.]+)\s+(-?[0-9.]+)\s*\)$"


def concat_text(*cols: Column) -> Column:
    """Join values as text; null if any is null."""
    return F.concat(*[c.cast("string") for c in cols])


def char_at(col: Column, index: int) -> Column:
    """Character at a 0-based index; negative counts from the end; null outside."""
    inside = F.length(col) > index if index >= 0 else F.length(col) >= -index
    return F.when(inside, F.substring(col, index + 1 if index >= 0 else index, 1))


def is_capitalised(col: Column) -> Column:
    """True if the first character is an upper-case letter."""
    return col.rlike(r"^\p{Lu}")


def starts_with_vowel(col: Column) -> Column:
    return col.rlike("^[AEIOUaeiou]")


def longer_than(col: Column, n: int) -> Column:
    return F.length(col) > n


def split_text(col: Column, sep: str | None = None) -> Column:
    """Split by a literal separator (empty parts kept) or, by default, by runs of white space (none kept)."""
    if sep is None:
        return F.regexp_extract_all(col, F.lit(WORD), F.lit(0))
    return F.split(col, r"\Q" + sep + r"\E")


def normalise_text(col: Column) -> Column:
    """Lower case, ASCII punctuation dropped, white space squeezed to single blanks, ends stripped."""
    bare = F.regexp_replace(F.lower(col), PUNCTUATION, "")
    return F.trim(F.regexp_replace(bare, SPACE + "+", " "))


def title_case(col: Column) -> Column:
    """Upper-case every letter that follows a non-letter, lower-case the rest (``x-ray`` → ``X-Ray``)."""
    pieces = F.regexp_extract_all(col, F.lit(r"(\p{L}+|[^\p{L}]+)"), F.lit(1))
    cased = F.transform(
        pieces, lambda p: F.concat(F.upper(F.substring(p, 1, 1)), F.lower(F.substr(p, F.lit(2))))
    )
    return F.array_join(cased, "")


def is_palindrome(col: Column) -> Column:
    return F.reverse(col) == col


def has_palindrome_word(col: Column, min_len: int = 2) -> Column:
    """True if some word of at least ``min_len`` letters reads the same backwards, whatever its case."""
    words = split_text(F.lower(col))
    return F.exists(words, lambda w: (F.length(w) >= min_len) & (F.reverse(w) == w))


def word_count(col: Column) -> Column:
    return F.size(split_text(col))


def contains_ci(col: Column, word: str) -> Column:
    """Case-insensitive containment."""
    return F.contains(F.lower(col), F.lit(word.lower()))


def mean_word_len(col: Column) -> Column:
    """Letters outside white space per word; null without words."""
    solid = F.length(F.regexp_replace(col, SPACE, ""))
    return F.when(word_count(col) > 0, solid / word_count(col))


def path_ext(col: Column) -> Column:
    """Extension after the last dot of the file name, without the dot; empty if none."""
    return F.regexp_extract(col, r"\.([^./]+)$", 1)


def path_stem(col: Column) -> Column:
    """File name without folders and without its extension."""
    return F.regexp_replace(F.element_at(F.split(col, "/"), -1), r"\.[^.]+$", "")


def path_depth(col: Column) -> Column:
    """Number of folders above the file."""
    return F.size(F.split(col, "/")) - 1


def log_fields(col: Column) -> Column:
    """``struct<ts, level, message>`` of a ``YYYY-MM-DD HH:MM:SS [LEVEL] message`` line; null if it does not match."""
    ts = F.try_to_timestamp(F.regexp_extract(col, LOG_LINE, 1), F.lit("yyyy-MM-dd HH:mm:ss"))
    parts = F.struct(
        ts.cast("timestamp_ntz").alias("ts"),
        F.regexp_extract(col, LOG_LINE, 2).alias("level"),
        F.regexp_extract(col, LOG_LINE, 3).alias("message"),
    )
    return F.when(col.rlike(LOG_LINE), parts)


def line_number(col: Column) -> Column:
    """The number N of a ``Line N: …`` line; null elsewhere."""
    return F.regexp_extract(col, NUMBERED_LINE, 1).try_cast("long")


def tag_count(col: Column, tag: str, literal: bool = False) -> Column:
    """How often an opening tag occurs; ``literal`` counts only ``<tag>`` and ``<tag/>``."""
    pattern = rf"<{tag}/?>" if literal else rf"(?i)<{tag}\b[^>]*>"
    return F.regexp_count(col, F.lit(pattern))


def link_count(col: Column) -> Column:
    """Anchors on a page."""
    return tag_count(col, "a")


def token_hits(col: Column, needle: str, sep: str = ",") -> Column:
    """Tokens between separators that contain the needle."""
    return F.size(F.filter(split_text(col, sep), lambda t: F.contains(t, F.lit(needle))))


def uri_tail(col: Column) -> Column:
    """Text after the last slash."""
    return F.element_at(F.split(col, "/"), -1)


def url_basename(col: Column, max_len: int = 100) -> Column:
    """Last path segment without query or fragment, cut to ``max_len`` characters."""
    return F.substring(F.regexp_extract(col, r"([^/?#]*)(?:[?#].*)?$", 1), 1, max_len)


def to_day(col: Column, fmt: str | None = None) -> Column:
    """Timestamp (or text in ``fmt``) at midnight of its day."""
    ts = col if fmt is None else F.try_to_timestamp(col, F.lit(fmt))
    return F.date_trunc("day", ts)


def wkt_lon(col: Column) -> Column:
    """Longitude, which the text form stores first."""
    return F.regexp_extract(col, WKT_POINT, 1).try_cast("double")


def wkt_lat(col: Column) -> Column:
    """Latitude, which the text form stores second."""
    return F.regexp_extract(col, WKT_POINT, 2).try_cast("double")

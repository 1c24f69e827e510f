"""Near-duplicate lines by a segment-partition edit join, in DataFrame operations only.

A line is split into one segment more than the edits allowed; two lines within that distance share a segment that is shifted
by no more than the edits. Lines are indexed by their segments and probed, for each length that is possible, with just the
substrings whose shift the remaining edits allow; what meets is verified by a banded bit-parallel edit distance.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.operators.components import components
from tallyloom.session import cut_lineage

# So many candidate lines (8 bytes each) are sent to every task when their texts are looked up; beyond, they are shuffled.
BROADCAST_LINES = 2_000_000


def _shifts(edits: int) -> list[tuple[int, int, int]]:
    """``(longer, segment, shift)``: where a line may hold a segment of a line that is up to ``edits`` shorter.

    With ``longer`` = the difference in length, segment i of the other line can start only where both the part before it and
    the part after it leave their share of the edits.
    """
    return [
        (longer, i, shift)
        for longer in range(edits + 1)
        for i in range(edits + 1)
        for shift in range(max(-i, longer - (edits - i)), min(i, longer + (edits - i)) + 1)
    ]


def _signatures(lines: DataFrame, places: list[tuple[int, int, int]], edits: int, side: str) -> DataFrame:
    """``sig``, ``id`` and ``counts``, prefixed, for each place that is inside of the line.

    The places are rows, not columns: one short expression for all of them is compiled, many long ones are not.
    """
    at = F.array(*[F.struct(*[F.lit(v).alias(n) for v, n in zip(place, ("longer", "i", "shift"))]) for place in places])
    other = F.col("length") - F.col("at.longer")
    lo, hi = (F.floor(other * n / F.lit(edits + 1)).cast("int") for n in (F.col("at.i"), F.col("at.i") + 1))
    placed = lines.withColumn("at", F.explode(at)).withColumns({"other": other, "lo": lo + F.col("at.shift"), "size": hi - lo})
    sig = F.xxhash64("other", "at.i", F.substring(F.col("line"), F.col("lo") + 1, F.col("size")))
    inside = (F.col("lo") >= 0) & (F.col("lo") + F.col("size") <= F.col("length"))
    return placed.where(inside).select(sig.alias("sig"), *[F.col(c).alias(f"{side}_{c}") for c in ("id", "counts")])


# Counted one by one; all other characters are counted together. Which ones is of no consequence for the result.
COUNTED = "etanhoirsld"
# Bits of a count.
COUNT_BITS = 5


def _counts(line: Column) -> Column:
    """The counts of characters in one number, each modulo 2^``COUNT_BITS``."""
    per = [F.octet_length(line) - F.octet_length(F.replace(line, F.lit(c), F.lit(""))) for c in COUNTED]
    rest = F.char_length(line) - sum(per[1:], per[0])
    return reduce(Column.bitwiseOR, [F.shiftleft((x % (1 << COUNT_BITS)).cast("long"), COUNT_BITS * i) for i, x in enumerate([*per, rest])])


def _may_be_close(a: str, b: str, edits: int) -> Column:
    """Count filter: an edit changes the counts by two in all at most, so lines that differ by more cannot be meant."""
    apart = []
    for i in range(len(COUNTED) + 1):
        one, other = (F.shiftrightunsigned(c, COUNT_BITS * i).bitwiseAND(F.lit((1 << COUNT_BITS) - 1)) for c in (a, b))
        apart.append(F.least(F.abs(one - other), F.lit(1 << COUNT_BITS) - F.abs(one - other)))
    return sum(apart[1:], apart[0]) <= 2 * edits


def within(u: str, v: str, edits: int) -> Column:
    """True if the texts in columns ``u`` and ``v`` are within ``edits`` (at most 4) edits; null if one is null.

    One number holds, for each number of edits used, a bit for each diagonal of the band that can be reached with it; a
    character of ``v`` moves all of them at once. A bit stays where the characters agree; otherwise it goes to the next number of
    edits: in place (substitution), one diagonal down (a character of ``v`` alone) or up (a character of ``u`` alone).
    """
    band, lane = 2 * edits + 1, 2 * edits + 2
    inside = F.lit(sum(((1 << band) - 1) << lane * e for e in range(edits + 1)))
    everywhere = F.lit(sum(1 << lane * e for e in range(edits + 1)))

    def skip_u(bits: Column) -> Column:
        for _ in range(edits):
            bits = bits.bitwiseOR(F.shiftleft(F.shiftleft(bits, 1).bitwiseAND(inside), lane)).bitwiseAND(inside)
        return bits

    def step(bits: Column, same: Column) -> Column:
        used = F.shiftleft(bits.bitwiseOR(F.shiftright(bits, 1).bitwiseAND(inside)), lane)
        # No diagonal can come back once all are gone.
        return F.when(bits != 0, skip_u(bits.bitwiseAND(same.cast("long") * everywhere).bitwiseOR(used))).otherwise(bits)

    # Where no step is taken the middle diagonal is reached without an edit, and those above it by leaving out characters of u.
    start = sum(1 << lane * e + edits + up for e in range(edits + 1) for up in range(e + 1))

    def run(pair: Column) -> Column:
        # Outside of u there is null, which agrees with nothing.
        at = lambda c, j: reduce(Column.bitwiseOR, [F.when(F.get(pair["u"], j + (b - edits)) == c, 1 << b).otherwise(0) for b in range(band)])
        return F.aggregate(F.transform(pair["v"], at), F.lit(start).cast("long"), step)

    # Both lists of characters are made once for a pair: as the fields of the only element of an array.
    chars = F.array(F.struct(F.split(u, "").alias("u"), F.filter(F.split(v, ""), lambda c: c != "").alias("v")))
    reached = F.element_at(F.transform(chars, run), 1)
    longer = F.char_length(u) - F.char_length(v)
    at = F.least(F.greatest(longer + (lane * edits + edits), F.lit(0)), F.lit(62))
    return F.when(longer.isNotNull(), (F.abs(longer) <= edits) & (F.call_function("shiftright", reached, at).bitwiseAND(F.lit(1)) == 1))


def _split(docs: DataFrame, min_chars: int) -> DataFrame:
    """``doc_id, text_hash, at, id, line`` of the lines that take part."""
    each = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), F.posexplode(F.split("text", "\n")).alias("at", "line"))
    return each.where(F.char_length("line") >= min_chars).withColumn("id", F.xxhash64("line"))


def line_links(docs: DataFrame, edits: int = 2, min_chars: int = 24) -> DataFrame:
    """``u, v``: hashes of different lines that are within ``edits`` edits, each pair once (``u`` > ``v``).

    Only lines of at least ``min_chars`` characters take part; a line of fewer characters than segments could not be split.
    """
    if min_chars <= edits:
        raise ValueError("lines must be longer than the edits allowed")
    # Both sides of the join are made from one shuffle of the different lines, which is not written a second time.
    each = _split(docs, min_chars).select("id", "line")
    lines = each.select("id", "line", F.char_length("line").alias("length"), _counts(F.col("line")).alias("counts")).distinct()
    index = _signatures(lines, [(0, i, 0) for i in range(edits + 1)], edits, "v")
    probe = _signatures(lines, _shifts(edits), edits, "u")
    # The count filter is part of the join: variants of one line that share a segment but differ elsewhere make no row. Lines of
    # equal length find each other; the pair counts once.
    met = (F.col("u_id") != F.col("v_id")) & _may_be_close("u_counts", "v_counts", edits)
    joined = probe.join(index, "sig").where(met)
    pairs = cut_lineage(joined.select(F.greatest("u_id", "v_id").alias("u"), F.least("u_id", "v_id").alias("v")).distinct())
    wanted = cut_lineage(pairs.select(F.explode(F.array("u", "v")).alias("id")).distinct())
    if wanted.count() <= BROADCAST_LINES:
        wanted = F.broadcast(wanted)
    texts = cut_lineage(each.join(wanted, "id", "left_semi").distinct())
    sides = {c: texts.select(F.col("id").alias(c), F.col("line").alias(f"{c}_line")) for c in ("u", "v")}
    # Adaptive execution would put pairs together by their few bytes; verification costs time, not bytes.
    tasks = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    found = pairs.repartition(tasks, "u", "v").join(sides["u"], "u").join(sides["v"], "v").where(within("u_line", "v_line", edits))
    return found.select("u", "v")


def repeated_lines(docs: DataFrame, edits: int = 2, min_chars: int = 24) -> DataFrame:
    """``doc_id, text_hash, n_lines, removed``: for each document the numbers (from 0, ascending) of its lines that repeat an
    earlier one.

    Lines are of one class if they are equal or linked by lines within ``edits`` edits. Of each class the line with the
    smallest (``doc_id``, text hash, number) stays; null is the smallest id. Rows equal in id and text count as one document.
    Lines shorter than ``min_chars`` are of one class only if they are equal; empty lines stay. A null text has no line, an
    empty one has one.
    """
    named = components(line_links(docs, edits, min_chars)).select(F.col("node").alias("id"), "component")
    place = F.struct(F.coalesce(F.col("doc_id"), F.lit(-(1 << 63))).alias("doc"), "text_hash", "at")
    lines = _split(docs, 1).select("id", place.alias("place")).distinct()
    rooted = cut_lineage(lines.join(cut_lineage(named), "id", "left").select("place", F.coalesce("component", "id").alias("root")))
    # The first line of each class, and the classes with more than one: partial minima, no list of a class.
    firsts = cut_lineage(rooted.groupBy("root").agg(F.min("place").alias("first"), F.count("*").alias("n")).where("n > 1"))
    later = rooted.join(firsts, "root").where(F.col("place") != F.col("first"))
    removed = later.groupBy("place.doc", "place.text_hash").agg(F.sort_array(F.collect_list("place.at")).alias("removed"))
    per = docs.select(
        "doc_id",
        F.coalesce(F.col("doc_id"), F.lit(-(1 << 63))).alias("doc"),
        F.xxhash64("text").alias("text_hash"),
        F.when(F.col("text").isNull(), 0).otherwise(F.size(F.split("text", "\n"))).cast("long").alias("n_lines"),
    )
    none = F.array().cast("array<int>")
    return per.join(cut_lineage(removed), ["doc", "text_hash"], "left").select("doc_id", "text_hash", "n_lines", F.coalesce("removed", none).alias("removed"))


def drop_repeated_lines(docs: DataFrame, edits: int = 2, min_chars: int = 24) -> DataFrame:
    """``docs`` with the repeated lines taken out of ``text``; same rows and columns."""
    marks = cut_lineage(repeated_lines(docs, edits, min_chars).where(F.size("removed") > 0).select("doc_id", "text_hash", "removed").distinct())
    packed = docs.select(F.struct("*").alias("doc"), F.col("doc_id").alias("id"), F.xxhash64("text").alias("hash"))
    joined = packed.join(marks, F.col("id").eqNullSafe(F.col("doc_id")) & (F.col("hash") == F.col("text_hash")), "left")
    left = F.filter(F.split("doc.text", "\n"), lambda line, i: ~F.coalesce(F.array_contains("removed", i), F.lit(False)))
    return joined.select(*[(F.array_join(left, "\n") if c == "text" else F.col("doc")[c]).alias(c) for c in docs.columns])

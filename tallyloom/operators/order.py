"""Row order: positions, top-k, runs and windows that survive one very long series.

A window partitioned by a series key puts the whole series into one task. The operators here number all rows, cut them into
blocks of ``block_rows`` rows and carry what a block needs from the one before.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallyloom.session import cut_lineage

# Rows of a block: a window holds no more of a series.
BLOCK_ROWS = 1_000_000

Order = str | Column


def _cols(order: Order | Sequence[Order]) -> list[Column]:
    items = [order] if isinstance(order, (str, Column)) else list(order)
    return [F.col(o) if isinstance(o, str) else o for o in items]


def sort_by(df: DataFrame, directions: Mapping[str, str]) -> DataFrame:
    """Sort by columns given as ``{name: "asc" | "desc"}``."""
    return df.orderBy(*[F.desc(c) if d == "desc" else F.asc(c) for c, d in directions.items()])


def ci_order(col: str, desc: bool = False) -> Column:
    """Case-insensitive sort key."""
    key = F.lower(F.col(col))
    return key.desc() if desc else key.asc()


def sort_ci(df: DataFrame, col: str, desc: bool = True) -> DataFrame:
    return df.orderBy(ci_order(col, desc))


def enumerate_rows(
    df: DataFrame, order: Order | Sequence[Order], start: int = 0, name: str = "position"
) -> DataFrame:
    """Number the rows in a declared order, without ever sorting them in one task.

    Rows are range-partitioned and sorted, numbered inside each partition, and shifted by the sizes of the
    partitions before. Ties are broken by a hash of the row, which also spreads a repeated key over
    partitions. The sorted rows are written out, as the ranges may differ if they were computed twice.
    """
    keys = [*_cols(order), _tie(df)]
    ranged = df.repartitionByRange(*keys).sortWithinPartitions(*keys)
    placed = cut_lineage(ranged.withColumn("_at", F.monotonically_increasing_id()))
    part = F.shiftrightunsigned("_at", 33)
    sizes = placed.groupBy(part.alias("_part")).agg(F.count("*").alias("_n"))
    # One row per partition.
    offsets = sizes.select(
        "_part",
        F.coalesce(F.sum("_n").over(W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("_off"),
    )
    local = F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    numbered = placed.withColumn("_part", part).join(F.broadcast(offsets), "_part")
    return numbered.select(*df.columns, (local + F.col("_off") + F.lit(start)).alias(name))


def _tie(df: DataFrame) -> Column:
    """Breaks ties of an order by the content of the row."""
    return F.xxhash64(*_hashable(df))


def _hashable(df: DataFrame) -> list[Column]:
    maps = {f.name for f in df.schema.fields if "map<" in f.dataType.simpleString()}
    return [F.to_json(F.struct(c)) if c in maps else F.col(c) for c in df.columns]


def reverse_rows(df: DataFrame, position: str) -> DataFrame:
    """Descending order of an existing position column."""
    return df.orderBy(F.desc(position))


def top_k(df: DataFrame, order: Order | Sequence[Order], k: int) -> DataFrame:
    """The first ``k`` rows in the order given; each task keeps only k rows."""
    return df.orderBy(*_cols(order)).limit(k)


def top_k_distinct(df: DataFrame, col: str, k: int, desc: bool = True) -> DataFrame:
    """The k largest (or smallest) different values."""
    key = F.desc(col) if desc else F.asc(col)
    return df.select(col).distinct().orderBy(key).limit(k)


def skip_first(df: DataFrame, order: Order | Sequence[Order], n: int) -> DataFrame:
    """Everything but the first ``n`` rows in the order given."""
    numbered = enumerate_rows(df, order, name="_pos")
    return numbered.where(F.col("_pos") >= n).drop("_pos")


def first_n(df: DataFrame, cond: Column, order: Order | Sequence[Order], n: int) -> DataFrame:
    """The first ``n`` rows, in order, the condition holds for."""
    return top_k(df.where(cond), order, n)


def batch_ids(df: DataFrame, order: Order | Sequence[Order], n: int, name: str = "batch") -> DataFrame:
    """Cut the ordered rows into batches of ``n``, numbered from 0; keeps ``position``."""
    return enumerate_rows(df, order).withColumn(name, F.floor(F.col("position") / n))


def peak_groups(df: DataFrame, key: Column, k: int, name: str = "key") -> DataFrame:
    """Rows per group with a flag on the k largest ones (ties by key)."""
    sizes = df.groupBy(key.alias(name)).agg(F.count("*").alias("n"))
    top = top_k(sizes, [F.desc("n"), F.asc(name)], k).select(name, F.lit(True).alias("peak"))
    return sizes.join(F.broadcast(top), name, "left").withColumn("peak", F.coalesce("peak", F.lit(False)))


def range_top_groups(df: DataFrame, key: Column, lo: object, hi: object, k: int, name: str = "key") -> DataFrame:
    """The k largest groups among keys in a closed range."""
    sizes = df.where(key.between(lo, hi)).groupBy(key.alias(name)).agg(F.count("*").alias("n"))
    return top_k(sizes, [F.desc("n"), F.asc(name)], k)


def _blocked(df: DataFrame, part: Sequence[str], order: Order | Sequence[Order], block_rows: int) -> DataFrame:
    """Rows numbered over all series (``_pos``) and cut into blocks (``_block``)."""
    numbered = enumerate_rows(df, [*[F.col(p) for p in part], *_cols(order)], name="_pos")
    return numbered.withColumn("_block", F.floor(F.col("_pos") / block_rows))


def _running_blocked(blocked: DataFrame, part: Sequence[str], value: str, name: str) -> DataFrame:
    local = F.sum(value).over(
        W.partitionBy("_block", *part).orderBy("_pos").rowsBetween(W.unboundedPreceding, 0)
    )
    pieces = blocked.groupBy(*part, "_block").agg(F.sum(value).alias("_sum"))
    whole = W.partitionBy(*part)
    before = F.sum("_sum").over(whole.orderBy("_block").rowsBetween(W.unboundedPreceding, -1))
    # Only series that reach into another block have a carry: at most two rows per block.
    carry = pieces.select(*part, "_block", before.alias("_carry")).where(F.col("_carry").isNotNull())
    joined = blocked.withColumn("_local", local).join(carry, [*part, "_block"], "left")
    return joined.withColumn(name, F.col("_local") + F.coalesce("_carry", F.lit(0))).drop("_local", "_carry")


def running_sum(
    df: DataFrame,
    part: Sequence[str],
    order: Order | Sequence[Order],
    col: str,
    name: str = "running",
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Cumulative sum within each series."""
    blocked = _blocked(df, part, order, block_rows)
    return _running_blocked(blocked, part, col, name).drop("_pos", "_block")


def consecutive_groups(
    df: DataFrame,
    part: Sequence[str],
    order: Order | Sequence[Order],
    key: str,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Runs of equal neighbouring keys: the series columns, ``run`` (from 0), the key and ``n`` rows."""
    blocked = _with_halo(_blocked(df, part, order, block_rows), 1, block_rows)
    w = W.partitionBy("_block", *part).orderBy("_pos")
    start = F.row_number().over(w) == 1
    flag = F.when(start, 0).otherwise((~F.col(key).eqNullSafe(F.lag(key).over(w))).cast("long"))
    own = blocked.withColumn("_new", flag).where("NOT _halo").drop("_halo")
    runs = _running_blocked(own, part, "_new", "run")
    # Counted with partial sums, so a long run does not gather its rows.
    return runs.groupBy(*part, "run", key).agg(F.count("*").alias("n"))


def _with_halo(blocked: DataFrame, rows: int, block_rows: int) -> DataFrame:
    """Give each block the ``rows`` rows before it, marked ``_halo``, from as many blocks as they fill."""
    last = F.floor((F.col("_pos") + rows) / block_rows)
    tail = blocked.where(last > F.col("_block"))
    halo = tail.withColumn("_block", F.explode(F.sequence(F.col("_block") + 1, last))).withColumn("_halo", F.lit(True))
    return blocked.withColumn("_halo", F.lit(False)).unionByName(halo)


def sliding_window(
    df: DataFrame,
    part: Sequence[str],
    order: Order | Sequence[Order],
    col: str,
    k: int,
    name: str = "window",
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """The last k values up to each row as an array; rows without k values behind them are left out."""
    blocked = _with_halo(_blocked(df, part, order, block_rows), k - 1, block_rows)
    w = W.partitionBy("_block", *part).orderBy("_pos").rowsBetween(-(k - 1), 0)
    # Structs, as a list of plain values would leave out nulls.
    full = blocked.withColumn(name, F.collect_list(F.struct(F.col(col).alias("v"))).over(w)).where((F.size(name) == k) & ~F.col("_halo"))
    return full.withColumn(name, F.col(name)["v"]).drop("_pos", "_block", "_halo")

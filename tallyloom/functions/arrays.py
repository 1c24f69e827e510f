"""Arrays, maps and short vectors held in one row."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def array_set(col: Column, index: int, value: object) -> Column:
    """Replace the element at a 0-based index."""
    return F.transform(col, lambda x, i: F.when(i == index, F.lit(value)).otherwise(x))


def array_put(col: Column, index: int, value: object) -> Column:
    """Insert before a 0-based index; past the end it is appended."""
    at = F.least(F.lit(index), F.size(col)) + 1
    return F.array_insert(col, at, F.lit(value))


def array_cut(col: Column, start: int, stop: int) -> Column:
    """Elements ``start`` (0-based) up to but not including ``stop``."""
    return F.slice(col, start + 1, max(stop - start, 0))


def comprehend(
    col: Column, map_fn: Callable[[Column], Column], where_fn: Callable[[Column], Column] | None = None
) -> Column:
    """Keep the elements the condition holds for, then map them."""
    kept = col if where_fn is None else F.filter(col, where_fn)
    return F.transform(kept, map_fn)


def flatten3(col: Column) -> Column:
    """Three levels of nesting to one."""
    return F.flatten(F.flatten(col))


def zip_arrays(x: Column, y: Column, fn: Callable[[Column, Column], Column]) -> Column:
    """Element-wise map of two arrays; stops at the shorter one."""
    n = F.least(F.size(x), F.size(y))
    return F.zip_with(F.slice(x, F.lit(1), n), F.slice(y, F.lit(1), n), fn)


def cross_pairs(x: Column, y: Column) -> Column:
    """Every pair of two short lists held in the same row, as an array of ``struct<left, right>``."""
    return F.flatten(
        F.transform(x, lambda a: F.transform(y, lambda b: F.struct(a.alias("left"), b.alias("right"))))
    )


def sort_pairs(col: Column, field: str, desc: bool = False) -> Column:
    """Sort an array of structs by one field; equal fields keep the order of the whole struct."""
    name = F.transform(col, lambda p: F.struct(p[field].alias("_k"), p.alias("_p")))
    ordered = F.sort_array(name, asc=not desc)
    return F.transform(ordered, lambda q: q["_p"])


def set_add(col: Column, value: object) -> Column:
    """Add an element unless it is there."""
    return F.array_union(col, F.array(F.lit(value)))


def set_remove(col: Column, value: object) -> Column:
    return F.array_remove(col, value)


def map_put(col: Column, key: Column, value: Column) -> Column:
    """Set one key; an old value is replaced."""
    return F.map_concat(map_drop(col, key), F.create_map(key, value))


def map_drop(col: Column, key: Column) -> Column:
    return F.map_filter(col, lambda k, _: k != key)


def map_sorted_keys(col: Column) -> Column:
    return F.sort_array(F.map_keys(col))


def map_items(col: Column) -> Column:
    """Entries as an array of ``struct<key, value>``, by key."""
    return F.sort_array(F.map_entries(col))


def dot(x: Column, y: Column) -> Column:
    """Inner product of two equally long vectors, added up in double precision."""
    products = F.zip_with(x, y, lambda a, b: a.cast("double") * b.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda acc, v: acc + v)


def scale(col: Column, k: float) -> Column:
    return F.transform(col, lambda v: v * F.lit(k))


def array_mean(col: Column) -> Column:
    """Mean of the elements; null for an empty array."""
    total = F.aggregate(col, F.lit(0.0), lambda acc, v: acc + v.cast("double"))
    return F.when(F.size(col) > 0, total / F.size(col))


def squared_distance(x: Column, y: Column) -> Column:
    """Squared Euclidean distance of two vectors."""
    parts = F.zip_with(x, y, lambda a, b: (a.cast("double") - b) * (a.cast("double") - b))
    return F.aggregate(parts, F.lit(0.0), lambda acc, v: acc + v)

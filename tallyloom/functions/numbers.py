"""Predicates and arithmetic on numeric columns."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def in_range(col: Column, lo: object, hi: object) -> Column:
    """Both ends included."""
    return col.between(lo, hi)


def equals(col: Column, value: object) -> Column:
    return col == F.lit(value)


def divisible(col: Column, *divisors: int) -> Column:
    """True where every divisor divides the value."""
    test = F.lit(True)
    for d in divisors:
        test = test & (col % d == 0)
    return test


def range_filter(lo: object, hi: object) -> Callable[[Column], Column]:
    """A predicate builder for a closed range."""
    return lambda col: in_range(col, lo, hi)


# The comparison signs a threshold filter understands.
_COMPARE: dict[str, Callable[[Column, object], Column]] = {
    ">": lambda c, t: c > t,
    ">=": lambda c, t: c >= t,
    "<": lambda c, t: c < t,
    "<=": lambda c, t: c <= t,
    "==": lambda c, t: c == t,
    "!=": lambda c, t: c != t,
}


def threshold_filter(threshold: object, op: str = ">") -> Callable[[Column], Column]:
    """A predicate builder comparing with a threshold."""
    if op not in _COMPARE:
        raise ValueError(f"unknown comparison {op!r}")
    return lambda col: _COMPARE[op](col, threshold)


def case_bucket(rules: Sequence[tuple[Column, object]], default: object = None) -> Column:
    """The value of the first rule that holds, else the default."""
    if not rules:
        return F.lit(default)
    bucket = F.when(*rules[0])
    for test, value in rules[1:]:
        bucket = bucket.when(test, value)
    return bucket.otherwise(default)


# The first primes. As witnesses of a strong test the first four decide every number below 3,215,031,751, all of
# them every number of 64 bits; the first two decide every number below 1,373,653.
_FIRST_PRIMES = (2, 3, 5, 7, 11, 13, 17, 19, 23, 29, 31, 37)
# Squares of numbers up to this one fit into 64 bits.
_ROOT_OF_LONG = 3_037_000_499


def _strong_test(n: Column, witnesses: Sequence[int], kind: str) -> Column:
    """Whether an odd ``n`` passes the strong test (Miller and Rabin) for all witnesses.

    With n - 1 = d * 2^r and an odd d, a witness w passes if w^d is 1 or one of w^d, w^2d, ... before w^(n-1) is n - 1. The powers
    come up while w^(n-1) is built from the bits of n - 1, the last r of which are zeros. ``kind`` holds products of two rests.
    """
    m = n.cast(kind)
    size = F.length(F.bin(n - 1))
    zeros = F.length(F.bin((n - 1).bitwiseAND(-(n - 1)))) - 1
    places = F.sequence(F.lit(1), size)

    def passes(w: int) -> Column:
        def step(state: Column, place: Column) -> Column:
            bit = F.call_function("shiftright", n - 1, size - place).bitwiseAND(F.lit(1).cast("long"))
            square = (state["x"] * state["x"] % m).cast(kind)
            x = F.when(bit == 1, (square * F.lit(w).cast(kind) % m).cast(kind)).otherwise(square)
            left = size - place
            seen = state["hit"] | ((left == zeros) & (x == 1)) | ((left <= zeros) & (left > 0) & (x == m - 1))
            return F.struct(x.alias("x"), seen.alias("hit"))

        start = F.struct(F.lit(1).cast(kind).alias("x"), F.lit(False).alias("hit"))
        return F.aggregate(places, start, step)["hit"]

    out = passes(witnesses[-1])
    for w in reversed(witnesses[:-1]):
        out = F.when(passes(w), out).otherwise(F.lit(False))
    return out


def is_prime(col: Column) -> Column:
    """Small primes by division, all others by a strong test with fixed witnesses, which is exact for 64 bits.

    The work for a number grows with its digits, not with its root.
    """
    n = col.cast("long")
    test = F.when(n.isNull(), F.lit(None).cast("boolean")).when(n < 2, F.lit(False))
    test = test.when(n.isin(*_FIRST_PRIMES), F.lit(True))
    for p in _FIRST_PRIMES:
        test = test.when(n % p == 0, F.lit(False))
    test = test.when(n < 41 * 41, F.lit(True))
    test = test.when(n < 1_373_653, _strong_test(n, _FIRST_PRIMES[:2], "long"))
    test = test.when(n <= _ROOT_OF_LONG, _strong_test(n, _FIRST_PRIMES[:4], "long"))
    return test.otherwise(_strong_test(n, _FIRST_PRIMES, "decimal(38,0)"))


def power(col: Column, n: int) -> Column:
    """Whole-number power by multiplication, so that integers stay exact."""
    if n < 0:
        raise ValueError("the exponent must not be negative")
    result = F.lit(1).cast("long")
    for _ in range(n):
        result = result * col
    return result


def weighted_sum(*cols: Column) -> Column:
    """a + 2b + 3c + …"""
    total = cols[0]
    for weight, col in enumerate(cols[1:], start=2):
        total = total + col * weight
    return total


def discount(price: Column, percent: float, where: Column | None = None) -> Column:
    """The price less ``percent``, for the rows the condition names (all by default)."""
    reduced = price * F.lit(1 - percent / 100)
    return reduced if where is None else F.when(where, reduced).otherwise(price)


def decade(col: Column) -> Column:
    """1957 → ``1950s``; rounds down for negative years too."""
    return F.concat((F.floor(col / 10) * 10).cast("string"), F.lit("s"))


def century(year: Column) -> Column:
    """Whole part of year / 100, plus one; so 1900 gives 20."""
    return (F.floor(year / 100) + 1).cast("long")


def modulus(re: Column, im: Column) -> Column:
    """Absolute value of a complex number."""
    return F.hypot(re, im)


def coerce(col: Column, dtype: str) -> Column:
    """Cast; a value that does not fit becomes null."""
    return col.try_cast(dtype)

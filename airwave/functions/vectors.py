"""Vectors as arrays of doubles: algebra by higher-order functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ZERO = 1e-13


def concat(*vs: Column) -> Column:
    return F.concat(*vs)


def add(a: Column, b: Column) -> Column:
    return F.zip_with(a, b, lambda x, y: x + y)


def divide(a: Column, d: Column) -> Column:
    """a / d; null where d is as good as zero."""
    return F.when(F.abs(d) > ZERO, F.transform(a, lambda x: x / d))


def dot(a: Column, b: Column) -> Column:
    """Null where the sizes differ."""
    return F.when(F.size(a) == F.size(b), F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x))


def dot_of(a: Column, b: Column, size: int) -> Column:
    """The dot product of vectors of known size, written out so that it is compiled: for all-pairs scores."""
    return sum((F.get(a, F.lit(k)) * F.get(b, F.lit(k)) for k in range(size)), F.lit(0.0))


def norm_l2(a: Column) -> Column:
    n = F.sqrt(F.aggregate(a, F.lit(0.0), lambda s, x: s + x * x))
    return F.when(n > ZERO, F.transform(a, lambda x: x / n)).otherwise(a)


def norm_max(a: Column) -> Column:
    """Divided by the largest value (not the largest magnitude)."""
    m = F.array_max(a)
    return F.when(F.abs(m) > ZERO, F.transform(a, lambda x: x / m)).otherwise(a)


def take(a: Column, positions: list[int]) -> Column:
    return F.array(*(F.get(a, F.lit(p)) for p in positions))


def to_sparse(a: Column) -> Column:
    """(index, value) of what is not zero."""
    return F.filter(F.transform(a, lambda x, i: F.struct(i.alias("idx"), x.alias("value"))), lambda e: e["value"] != 0)


def to_dense(entries: Column, size: int) -> Column:
    positions = F.sequence(F.lit(0), F.lit(size - 1))
    return F.transform(positions, lambda p: F.aggregate(F.filter(entries, lambda e: e["idx"] == p), F.lit(0.0), lambda s, e: s + e["value"]))

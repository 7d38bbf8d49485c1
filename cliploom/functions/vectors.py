"""Number and vector columns (arrays of doubles)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def clamp(value: Column, low, high) -> Column:
    low = low if isinstance(low, Column) else F.lit(low)
    high = high if isinstance(high, Column) else F.lit(high)
    return F.greatest(low, F.least(high, value))


def smooth01(value: Column) -> Column:
    t = clamp(value, 0.0, 1.0)
    return t * t * (F.lit(3.0) - F.lit(2.0) * t)


def total(vector: Column) -> Column:
    return F.aggregate(vector, F.lit(0.0), lambda acc, v: acc + v)


def sq_dist(a: Column, b: Column) -> Column:
    return total(F.zip_with(a, b, lambda x, y: (x - y) * (x - y)))


def dist(a: Column, b: Column) -> Column:
    return F.sqrt(sq_dist(a, b))


def dot(a: Column, b: Column) -> Column:
    return total(F.zip_with(a, b, lambda x, y: x * y))


def norm(a: Column) -> Column:
    return F.sqrt(total(F.transform(a, lambda v: v * v)))


def lerp(a: Column, b: Column, weight: Column) -> Column:
    return F.zip_with(a, b, lambda x, y: x + (y - x) * weight)


def half_even(value: Column, digits: int = 0) -> Column:
    """Rounding to the even neighbour on ties."""
    return F.bround(value, digits)

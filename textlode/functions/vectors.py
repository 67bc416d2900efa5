"""Vector functions as Column -> Column."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _doubles(vector: Column) -> Column:
    return vector.cast("array<double>")


def inner_product(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(_doubles(a), _doubles(b), lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def norm(vector: Column) -> Column:
    return F.sqrt(F.aggregate(_doubles(vector), F.lit(0.0), lambda s, x: s + x * x))


def normalise(vector: Column) -> Column:
    n = norm(vector)
    return F.when(n > 0, F.transform(_doubles(vector), lambda x: x / n))


def problems(vector: Column, dim: int, tolerance: float = 1e-4) -> Column:
    """Names of what is wrong with a vector that should be finite, of one dimension and unit length."""
    finite = ~F.coalesce(F.exists(_doubles(vector), lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))), F.lit(True))
    checks = [
        F.when(vector.isNull(), "missing"),
        F.when(F.size(vector) != dim, "dimension"),
        F.when(vector.isNotNull() & ~finite, "not_finite"),
        F.when(finite & (F.abs(norm(vector) - 1) > tolerance), "norm"),
    ]
    return F.filter(F.array(*checks), lambda p: p.isNotNull())

"""Vector columns for small joins; all-pairs work goes through operators.tiles."""
from __future__ import annotations

from pyspark.sql import Column, functions as F


def as_double(v: Column) -> Column:
    return v.cast("array<double>")


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(as_double(a), as_double(b), lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def norm(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def normalised(a: Column) -> Column:
    """Unit-length copy; the zero vector stays as it is."""
    n = norm(a)
    return F.when(n > 0, F.transform(as_double(a), lambda x: x / n)).otherwise(as_double(a))


def cosine(a: Column, b: Column) -> Column:
    d = norm(a) * norm(b)
    return F.when(d > 0, dot(a, b) / d).otherwise(F.lit(0.0))


def constant_vector(values) -> Column:
    return F.array(*[F.lit(float(v)) for v in values])

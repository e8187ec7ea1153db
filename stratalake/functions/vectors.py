"""Vector expressions on array columns; sums run in double precision."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def dot(a: Column, b: Column) -> Column:
    products = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda acc, x: acc + x)


def l2_norm(v: Column) -> Column:
    """Euclidean length (O-10)."""
    return F.sqrt(F.aggregate(v, F.lit(0.0), lambda acc, x: acc + x.cast("double") * x.cast("double")))


def normalised(v: Column) -> Column:
    """Unit vector as array<float>; a zero vector stays zero."""
    norm = l2_norm(v)
    return F.transform(v, lambda x: F.when(norm > 0, x / norm).otherwise(F.lit(0.0)).cast("float"))


def cosine(a: Column, b: Column, guard: float = 1e-9) -> Column:
    """Cosine similarity; ``guard`` keeps the denominator above zero (O-11)."""
    return dot(a, b) / (l2_norm(a) * l2_norm(b) + F.lit(guard))

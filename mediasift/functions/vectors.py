"""Dense-vector Column helpers (ARRAY<DOUBLE>), JVM-side higher-order functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def dot(a: Column | str, b: Column | str) -> Column:
    return F.aggregate(F.zip_with(_c(a), _c(b), lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def norm(a: Column | str) -> Column:
    return F.sqrt(F.aggregate(F.transform(_c(a), lambda x: x * x), F.lit(0.0), lambda s, x: s + x))


def cosine(a: Column | str, b: Column | str) -> Column:
    """Cosine similarity; a zero vector gives 0 (scikit-learn convention), NULL input gives NULL."""
    d = norm(a) * norm(b)
    return F.when(d > 0, dot(a, b) / d).when(d.isNotNull(), F.lit(0.0))


def normalize(a: Column | str, scale: Column | float = 1.0) -> Column:
    """``a / |a| * scale``; a zero vector stays zero."""
    n = norm(a)
    s = scale if isinstance(scale, Column) else F.lit(float(scale))
    return F.transform(_c(a), lambda x: F.when(n > 0, x / n * s).otherwise(F.lit(0.0)))


def as_double_array(a: Column | str) -> Column:
    return _c(a).cast("array<double>")

"""Vector functions as JVM expressions, in double precision."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def dot(a: str | Column, b: str | Column) -> Column:
    return F.aggregate(F.zip_with(_col(a), _col(b), lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def norm(a: str | Column) -> Column:
    """Euclidean length; null for null, and where an element is null."""
    return F.sqrt(F.aggregate(_col(a), F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))


def cosine_distance(a: str | Column, b: str | Column) -> Column:
    return F.lit(1.0) - dot(a, b) / (norm(a) * norm(b))


def fault(v: str, dim: int, tolerance: float) -> Column:
    """The first of ``missing``, ``dim``, ``finite``, ``norm`` that a vector fails, else null."""
    c = _col(v)
    finite = F.forall(c, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return (
        F.when(c.isNull(), "missing").when(F.size(c) != dim, "dim").when(~F.coalesce(finite, F.lit(False)), "finite").when(F.abs(norm(c) - 1) > tolerance, "norm")
    )

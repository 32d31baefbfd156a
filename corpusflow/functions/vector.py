"""Vector arithmetic as built-in expressions over ``ARRAY<FLOAT|DOUBLE>``."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def as_double(v) -> Column:
    return _col(v).cast("array<double>")


def dimension(v) -> Column:
    return F.size(_col(v))


def head(v, n: int = 5) -> Column:
    return F.slice(_col(v), 1, n)


def dot(a, b) -> Column:
    products = F.zip_with(as_double(a), as_double(b), lambda x, y: x * y)
    return F.aggregate(products, F.lit(0.0), lambda acc, x: acc + x)


def norm(v) -> Column:
    return F.sqrt(F.aggregate(as_double(v), F.lit(0.0), lambda acc, x: acc + x * x))


def cosine(a, b) -> Column:
    return dot(a, b) / (norm(a) * norm(b))


def squared_l2(a, b) -> Column:
    squares = F.zip_with(as_double(a), as_double(b), lambda x, y: (x - y) * (x - y))
    return F.aggregate(squares, F.lit(0.0), lambda acc, x: acc + x)


def distance_similarity(distance) -> Column:
    """Map a distance in [0, inf) to a similarity in (0, 1]."""
    return F.lit(1.0) / (F.lit(1.0) + _col(distance))


def all_close(a, b, rtol: float = 1e-5, atol: float = 1e-8) -> Column:
    """Equality of two vectors within a tolerance relative to the second."""
    near = F.zip_with(as_double(a), as_double(b),
                      lambda x, y: F.abs(x - y) <= F.lit(atol) + F.lit(rtol) * F.abs(y))
    return (F.size(_col(a)) == F.size(_col(b))) & F.forall(near, lambda ok: ok)

"""Vector functions on ``array<float>`` columns.

Spark 4.1 has no built-in vector functions, so these are higher-order SQL
expressions (JVM side, no Python). Arithmetic is done in double. They suit
one-query scans; pair work over many rows goes through the block kernels in
``tessera.operators.similarity`` instead.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _sum(arr: Column) -> Column:
    return F.aggregate(arr, F.lit(0.0).cast("double"), lambda s, x: s + x)


def dot(a: str | Column, b: str | Column) -> Column:
    """Sum of products."""
    return _sum(F.zip_with(_c(a), _c(b), lambda x, y: x.cast("double") * y.cast("double")))


def norm(a: str | Column) -> Column:
    """L2 norm."""
    return F.sqrt(_sum(F.transform(_c(a), lambda x: x.cast("double") * x.cast("double"))))


def scale(a: str | Column, divisor: Column) -> Column:
    """``x / divisor`` element-wise. The divisor is passed in as an array
    argument: a column referenced *inside* a lambda is re-evaluated for
    every element, which would make a norm cost O(dim^2) per row."""
    arr = _c(a)
    return F.zip_with(arr, F.array_repeat(divisor, F.size(arr)), lambda x, d: x.cast("double") / d)


def normalize(a: str | Column) -> Column:
    """``x / ||x||``; a zero vector gives NULL (never NaN, which would win a top-k)."""
    n = F.nullif(norm(a), F.lit(0.0))
    return F.when(n.isNull(), F.lit(None)).otherwise(scale(a, n))


def cosine(a: str | Column, b: str | Column) -> Column:
    """Cosine similarity in double; NULL when either side is a zero vector."""
    return dot(a, b) / F.nullif(norm(a) * norm(b), F.lit(0.0))


def literal_vector(values) -> Column:
    """A small query vector as a literal array (folded by the optimizer)."""
    return F.array(*[F.lit(float(v)).cast("double") for v in values])


def to_ml_vector(a: str | Column) -> Column:
    """Array -> MLlib vector (only at MLlib boundaries)."""
    from pyspark.ml.functions import array_to_vector

    return array_to_vector(_c(a))


def from_ml_vector(v: str | Column) -> Column:
    """MLlib vector -> array<double>."""
    from pyspark.ml.functions import vector_to_array

    return vector_to_array(_c(v))

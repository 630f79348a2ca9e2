"""Vector algebra on ``array<double>`` columns, all inside the JVM.

A short vector whose length the caller knows (``len(w) <= UNROLL``) becomes a plain sum of products, which takes part in
whole-stage code generation. Longer ones use higher-order functions, whose plan does not grow with the vector.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

import numpy as np
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column
from pyspark.sql import functions as F

UNROLL = 16

Vector = Column | Sequence[float]


def vector_literal(values: Sequence[float]) -> Column:
    """One ``array<double>`` literal, however long it is."""
    return F.lit(np.asarray(values, dtype=np.float64))


def entries(vector: Column, n: int) -> list[Column]:
    """The first ``n`` entries of a vector column as separate columns."""
    return [vector.getItem(i) for i in range(n)]


def required(value: Column, what: str) -> Column:
    """``value``, and an error where it is null."""
    return F.when(value.isNull(), F.raise_error(F.lit(f"{what} must not be null"))).otherwise(value)


def of_width(value: Column, vector: Column, n: int | Column) -> Column:
    """``value``, and an error where ``vector`` is null or has not ``n`` entries."""
    n = n if isinstance(n, Column) else F.lit(n)
    return F.when(F.size(vector) == n, value).otherwise(F.raise_error(F.lit("a vector has another width")))


def dot(features: Column, w: Vector) -> Column:
    """Inner product of a vector column with a literal vector or with another vector column of the same width.

    A null vector or one of another width is an error; a null entry gives null.
    """
    width = F.size(w) if isinstance(w, Column) else len(w)
    if not isinstance(w, Column):
        if len(w) <= UNROLL:
            terms = [x * F.lit(float(v)) for x, v in zip(entries(features, len(w)), w)]
            return of_width(reduce(lambda a, b: a + b, terms, F.lit(0.0)), features, width)
        w = vector_literal(w)
    products = F.zip_with(features, w, lambda x, v: x * v)
    return of_width(F.aggregate(products, F.lit(0.0), lambda total, p: total + p), features, width)


def axpy(a: float | Column, x: Column, y: Column) -> Column:
    """``a * x + y``, entry by entry. A null vector or vectors of different widths are an error; a null entry gives null."""
    a = a if isinstance(a, Column) else F.lit(float(a))
    return of_width(F.zip_with(x, y, lambda p, q: a * p + q), x, F.size(y))


def scale(vector: Column, factor: Column | float) -> Column:
    """Multiply every entry by ``factor``.

    ``factor`` enters as a repeated array and not as a captured expression: a lambda would evaluate it again for every
    entry, which is quadratic when the factor is itself an inner product.
    """
    factor = factor if isinstance(factor, Column) else F.lit(float(factor))
    return F.zip_with(vector, F.array_repeat(factor, F.size(vector)), lambda x, s: x * s)


def divide(vector: Column, divisor: float) -> Column:
    """Divide every entry by a constant."""
    if divisor == 0:
        raise ValueError("cannot divide a vector by zero")
    return F.transform(vector, lambda x: x / F.lit(float(divisor)))


def gemv(features: Column, w: Vector, y: Column, alpha: float = 1.0, beta: float = 0.0) -> Column:
    """``alpha * (features . w) + beta * y`` for each row."""
    return F.lit(float(alpha)) * dot(features, w) + F.lit(float(beta)) * y


def complete(vector: Column, what: str = "features") -> Column:
    """``vector``, and an error where it or one of its entries is null."""
    return F.when(vector.isNull() | F.exists(vector, lambda x: x.isNull()), F.raise_error(F.lit(f"{what} must not be null"))).otherwise(vector)


def total(vector: Column) -> Column:
    """Sum of the entries."""
    return F.aggregate(vector, F.lit(0.0), lambda acc, x: acc + x)


def as_doubles(vector: Column) -> Column:
    """Cast a numeric array to ``array<double>``."""
    return vector.cast("array<double>")


def vector_sum(vector: Column) -> Column:
    """Aggregate: sum of equally long vectors, reduced in each task first and never spread into cells."""
    return vector_to_array(Summarizer.sum(array_to_vector(vector)))

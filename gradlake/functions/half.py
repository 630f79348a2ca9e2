"""Rounding to half precision (IEEE 754 binary16) with plain column arithmetic."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the binary16 format.
MIN_EXPONENT = -14
FRACTION_BITS = 10
OVERFLOW = 65520.0


def to_half(x: Column) -> Column:
    """The double nearest to ``x`` that half precision can hold, ties to even, overflow to infinity."""
    size = F.abs(x)
    exponent = F.greatest(F.floor(F.log2(size)), F.lit(MIN_EXPONENT))
    # log2 can be off by one ulp next to a power of two
    exponent = F.when(F.pow(F.lit(2.0), exponent) > size, F.greatest(exponent - 1, F.lit(MIN_EXPONENT))).otherwise(exponent)
    step = F.pow(F.lit(2.0), (exponent - FRACTION_BITS).cast("double"))
    rounded = F.rint(x / step) * step
    return (
        F.when(x.isNull() | F.isnan(x) | (x == 0.0), x)
        .when(size >= OVERFLOW, F.signum(x) * F.lit(float("inf")))
        .otherwise(rounded)
    )

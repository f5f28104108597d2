"""Doubles as longs in the same order."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def with_ordered_bits(df: DataFrame, value_col: str, name: str) -> DataFrame:
    """Add ``name``: a long that orders like the double and is equal for equal doubles.

    The bits of the number's size (exponent, then fraction), negated for
    negative numbers: exact steps of built-in functions (a power of two and a
    division by it), each computed once, so it stays inside generated code.
    Both zeros are 0, infinities are the ends, NaN is above all; null is null.
    """
    at, power = f"_{name}_e", f"_{name}_p"
    x = F.col(value_col).cast("double")
    size = F.abs(x)
    # the logarithm may be one off at powers of two: corrected by doubling or halving
    out = df.withColumn(at, F.least(F.greatest(F.floor(F.log2(size)), F.lit(-1022)), F.lit(1023))) \
        .withColumn(power, F.pow(F.lit(2.0), F.col(at)))
    over, under = size / F.col(power) >= 2.0, (size < F.col(power)) & (F.col(at) > -1022)
    exponent = F.when(over, F.col(at) + 1).when(under, F.col(at) - 1).otherwise(F.col(at))
    scale = F.when(over, F.col(power) * 2).when(under, F.col(power) / 2).otherwise(F.col(power))
    # below the least normal number fractions count from 0: the formula gives that by itself
    normal = (exponent + 1023) * F.lit(1 << 52) + ((size / scale - 1.0) * 2.0 ** 52).cast("long")
    bits = F.when(F.isnan(x), F.lit((1 << 63) - 1)).when(size == float("inf"), F.lit(2047 << 52)) \
        .when(size == 0.0, F.lit(0).cast("long")).otherwise(normal)
    return out.withColumn(name, F.when(x < 0, -bits).otherwise(bits)).drop(at, power)

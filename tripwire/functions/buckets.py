"""Monotone, data-independent buckets for numeric order keys.

``log_bucket(x)`` is non-decreasing in x: sign, binary exponent and the top
``sub_bits`` bits of the mantissa. It needs no pass over the data (unlike
quantile boundaries) and splits a sorted numeric domain into many buckets, so
cumulative sums can be computed bucket by bucket in parallel.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def log_bucket(x: Column, sub_bits: int = 6) -> Column:
    """Infinities lie beyond all finite buckets, NaN beyond +infinity (Spark's own
    order); NULL has no bucket."""
    sub = 2 ** sub_bits
    inf = float("inf")
    odd = x.isNull() | F.isnan(x) | (x == inf) | (x == -inf) | (x == 0)
    a = F.when(odd, F.lit(1.0)).otherwise(F.abs(x))
    e = F.floor(F.log2(a))
    m = a / F.pow(F.lit(2.0), e)
    # k grows with |x|; an off-by-one exponent at a power of two lands on the
    # neighbouring key, so the order is kept.
    k = ((e + 1100) * sub + F.floor((m - 1.0) * sub)).cast("bigint")
    return (F.when(x.isNull(), F.lit(None).cast("bigint")).when(F.isnan(x), F.lit(1 << 41)).when(x == inf, F.lit(1 << 40))
            .when(x == -inf, F.lit(-(1 << 40))).when(x > 0, k).when(x < 0, -k).otherwise(F.lit(0)).cast("bigint"))


def sig_round(x: Column, digits: int = 9) -> Column:
    """Round to ``digits`` significant digits (report/oracle edge only)."""
    e = F.pow(F.lit(10.0), F.floor(F.log10(F.abs(x))))
    return F.when(x == 0, F.lit(0.0)).when(x.isNull() | F.isnan(x), x).otherwise(
        F.round(x / e, digits - 1) * e)


def sig_round_sql(x: str, digits: int = 9) -> str:
    """The same rounding as DuckDB SQL text."""
    e = f"pow(10.0, floor(log10(abs({x}))))"
    return f"(CASE WHEN ({x}) = 0 THEN 0.0 ELSE round(({x}) / {e}, {digits - 1}) * {e} END)"

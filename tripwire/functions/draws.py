"""Seeded, partition-independent pseudo-random draws from md5 of (key, seed).

A draw depends only on the row key and the seed, never on partitioning or
task order, so a rerun after an executor loss reproduces the same rows.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def draw_key(key, seed) -> Column:
    """md5 hex of ``'<key>:<seed>'`` (seed may be a literal or a column)."""
    seed_c = F.lit(str(seed)) if not isinstance(seed, Column) else seed.cast("string")
    return F.md5(F.concat(_c(key).cast("string"), F.lit(":"), seed_c))


def uniform_bits(hex_col: Column, digits: int = 15) -> Column:
    """Integer in [0, 16^digits) from the first hex digits of an md5 string (15: 60 bits)."""
    return F.conv(F.substring(hex_col, 1, digits), 16, 10).cast("bigint")


def uniform01(key, seed, slot: int = 0) -> Column:
    """Uniform double in (0, 1) for (key, seed, slot); slots are independent streams."""
    seed_c = F.lit(str(seed)) if not isinstance(seed, Column) else seed.cast("string")
    h = F.md5(F.concat(_c(key).cast("string"), F.lit(":"), seed_c, F.lit(f"#{slot}")))
    # 52 bits, so that neither end is reached after rounding to a double
    return (uniform_bits(h, 13).cast("double") + F.lit(0.5)) / F.lit(float(2 ** 52))


def standard_normal(key, seed, slot: int = 0) -> Column:
    """N(0,1) by Box-Muller from two independent uniforms."""
    u1 = uniform01(key, seed, 2 * slot)
    u2 = uniform01(key, seed, 2 * slot + 1)
    return F.sqrt(F.lit(-2.0) * F.log(u1)) * F.cos(F.lit(2 * math.pi) * u2)

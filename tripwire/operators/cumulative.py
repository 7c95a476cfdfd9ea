"""Cumulative sums along a sorted key, bucket by bucket (KS, AUC, AP frames).

A window ordered over a whole partition puts every distinct value of that
partition in one task. Here the rows are dealt to ranges of about equal size by
splitters that Spark samples from the keys themselves, so values crowded in a
narrow band are parted like any others; the totals of the ranges (one row each)
give each range's offset, and the running sum runs inside each range only.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripwire.functions.buckets import log_bucket

_B = "_cs_b"


def prefix_sums(df: DataFrame, order_col: str, sum_cols: Sequence[str], parts: Sequence[str] = (),
                suffix: str = "_before", totals: bool = False) -> DataFrame:
    """Add ``<c>_before`` = sum of ``c`` over rows with a smaller ``order_col``
    (same ``parts``). ``order_col`` must be unique within ``parts`` (aggregate
    to distinct values first). ``totals`` also adds ``<c>_total`` per part,
    taken from the range totals (no second pass over the rows).

    The ranges are pinned by one write, since a recomputed sample could cut
    elsewhere; a range never holds rows of two places in the order."""
    from tripwire.session import materialize
    parts = list(parts)
    d = materialize(df.repartitionByRange(*parts, order_col).withColumn(_B, F.spark_partition_id()), "ranges")
    tot = d.groupBy(*parts, _B).agg(*[F.sum(c).alias(f"_cs_t_{c}") for c in sum_cols])
    wp = Window.partitionBy(*parts) if parts else Window.partitionBy(F.lit(0))
    wb = wp.orderBy(_B).rowsBetween(Window.unboundedPreceding, -1)
    extra = [F.sum(f"_cs_t_{c}").over(wp).cast("bigint").alias(f"{c}_total") for c in sum_cols] if totals else []
    tot = tot.select(*parts, _B, *[F.coalesce(F.sum(f"_cs_t_{c}").over(wb), F.lit(0)).alias(f"_cs_o_{c}")
                                   for c in sum_cols], *extra)
    w = Window.partitionBy(*parts, _B).orderBy(order_col).rowsBetween(Window.unboundedPreceding, -1)
    j = d.join(tot, [*parts, _B])
    return j.select(*df.columns, *[(F.col(f"_cs_o_{c}") + F.coalesce(F.sum(c).over(w), F.lit(0)))
                                   .cast("bigint").alias(f"{c}{suffix}") for c in sum_cols],
                    *[F.col(f"{c}_total") for c in sum_cols if totals])


def exact_percentile(df: DataFrame, col: str | Column, q: float) -> float | None:
    """Exact linear-interpolated percentile (numpy's default); see
    ``exact_percentiles``."""
    return exact_percentiles(df, col, [q])[0]


#: Buckets of a selection round; each round returns at most this many rows a rank to the driver.
SELECT_BUCKETS = 1024


def exact_percentiles(df: DataFrame, col: str | Column, qs: Sequence[float]) -> list[float | None]:
    """Exact linear-interpolated percentiles (numpy's default).

    Distributed selection: the values are written once; each round counts the
    rows per bucket of the interval that still holds a wanted rank (map-side
    combined, so a value held by a third of the rows is one row per task) and
    goes on with that bucket's least and greatest value, until they are equal.
    The first buckets are those of ``log_bucket``, the next ones equal parts,
    so values crowded in a narrow band are parted like any others. No value is
    shuffled, only counts. NULL is ignored, NaN is greater than all.
    """
    from tripwire.session import materialize
    c = F.col(col) if isinstance(col, str) else col
    vals = materialize(df.select(c.cast("double").alias("v")).filter(F.col("v").isNotNull()), "percentile")
    v = F.col("v")
    stat = [F.count(F.lit(1)).alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi")]
    first = sorted(vals.groupBy(log_bucket(v, sub_bits=2).alias("b")).agg(*stat).collect(), key=lambda r: r.b)
    n = sum(r.n for r in first)
    if n == 0:
        return [None for _ in qs]
    ranks = sorted({r for q in qs for r in (math.floor(q * (n - 1)), math.ceil(q * (n - 1)))})

    def holding(buckets, rank: int, before: int):
        for r in buckets:
            if rank < before + r.n:
                return before, r.lo, r.hi
            before += r.n
        raise AssertionError("rank beyond the counts")

    at = {rank: holding(first, rank, 0) for rank in ranks}
    same = lambda a, b: a == b or (a != a and b != b)
    while open_ := sorted({x for x in at.values() if not same(x[1], x[2])}):
        parts = []
        for i, (_, lo, hi) in enumerate(open_):
            # a quotient of halves stays finite for any lo and hi
            share = (v / 2 - F.lit(lo / 2)) / F.lit(hi / 2 - lo / 2)
            b = F.when(v == hi, F.lit(SELECT_BUCKETS)).otherwise(F.least(F.floor(share * SELECT_BUCKETS), F.lit(SELECT_BUCKETS - 1)))
            parts.append(F.when((v >= lo) & (v <= hi), F.struct(F.lit(i).alias("i"), b.cast("int").alias("b"))))
        got = vals.select("v", F.explode(F.array_compact(F.array(*parts))).alias("x")).groupBy("x.i", "x.b").agg(*stat).collect()
        for rank, x in at.items():
            if x in open_:
                i = open_.index(x)
                at[rank] = holding(sorted((r for r in got if r.i == i), key=lambda r: r.b), rank, x[0])
    out = []
    for q in qs:
        pos = q * (n - 1)
        lo, hi = at[math.floor(pos)][1], at[math.ceil(pos)][1]
        out.append(lo if lo == hi else lo + (hi - lo) * (pos - math.floor(pos)))
    return out

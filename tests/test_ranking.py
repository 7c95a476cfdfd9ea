"""Exact-n selection, rank cuts and global ranks against brute force."""

import hashlib

import pandas as pd
from pyspark.sql import functions as F

from tripwire.functions.draws import draw_key
from tripwire.operators.ranking import first_n, global_rank, segment_by_rank


def _md5(k, seed):
    return hashlib.md5(f"{k}:{seed}".encode()).hexdigest()


def test_first_n_matches_brute_force(spark):
    df = spark.range(5000).withColumnRenamed("id", "k")
    got = sorted(r.k for r in first_n(df, "k", 7, 1234).collect())
    want = sorted(sorted(range(5000), key=lambda k: (_md5(k, 7), k))[:1234])
    assert got == want


def test_first_n_larger_than_table_keeps_all(spark):
    df = spark.range(10).withColumnRenamed("id", "k")
    assert first_n(df, "k", 1, 50).count() == 10


def test_first_n_callable_per_part(spark):
    df = spark.range(3000).withColumnRenamed("id", "k").withColumn("g", F.col("k") % 3)
    got = first_n(df, "k", 3, lambda tot: F.floor(tot * F.lit(0.1)), parts=["g"])
    counts = {r.g: r["count"] for r in got.groupBy("g").count().collect()}
    assert counts == {0: 100, 1: 100, 2: 100}
    pdf = df.toPandas()
    pdf["h"] = [_md5(k, 3) for k in pdf.k]
    want = set(pdf.sort_values(["g", "h", "k"]).groupby("g").head(100).k)
    assert set(r.k for r in got.collect()) == want


def test_segment_by_rank_cuts(spark):
    df = spark.range(1000).withColumnRenamed("id", "k")
    seg = segment_by_rank(df, draw_key("k", 5), ["k"], lambda tot: [F.lit(100), F.lit(250)], out="s")
    counts = {r.s: r["count"] for r in seg.groupBy("s").count().collect()}
    assert counts == {0: 100, 1: 150, 2: 750}
    order = sorted(range(1000), key=lambda k: (_md5(k, 5), k))
    got = {r.k: r.s for r in seg.collect()}
    assert all(got[k] == 0 for k in order[:100]) and all(got[k] == 1 for k in order[100:250])


def test_global_rank_dense_and_ordered(spark):
    df = spark.range(2000).withColumnRenamed("id", "k")
    r = global_rank(df, draw_key("k", 9), ["k"]).toPandas().sort_values("rank")
    assert list(r["rank"]) == list(range(1, 2001))
    assert list(r["k"]) == sorted(range(2000), key=lambda k: (_md5(k, 9), k))


def test_global_rank_numeric_bucket(spark):
    from tripwire.operators.ranking import int_range_bucket
    df = spark.createDataFrame(pd.DataFrame({"k": [5, 1, 99, 42, 7, 1000, 3]}))
    r = global_rank(df, F.col("k"), [], bucket=int_range_bucket(df, "k", 4)).toPandas().sort_values("rank")
    assert list(r["k"]) == [1, 3, 5, 7, 42, 99, 1000]


def test_smallest_k_hot_value_split_across_tasks(spark):
    """A third of the rows share one value; the cut falls inside that tie group.
    The result must equal brute force and the tie group must not be ranked in
    one range partition."""
    from tripwire.operators.inject import smallest_k
    n = 6000
    df = spark.range(n).withColumnRenamed("id", "k").withColumn(
        "v", F.when(F.col("k") % 3 == 0, F.lit(2.5)).otherwise((F.col("k") * 7919 % 1000).cast("double")))
    for k in (1, 1500, 2500, 4000, n):
        got = sorted(r.k for r in smallest_k(df, F.col("v"), "k", k).select("k").collect())
        pdf = df.toPandas().sort_values(["v", "k"])
        assert got == sorted(pdf.k.head(k)), k
    # the hot tie group is spread over several range partitions
    r = (df.withColumn("_rk_h", F.col("v")).filter(F.col("v") == 2.5)
         .repartitionByRange(8, F.col("_rk_h"), F.col("k"))
         .select(F.spark_partition_id().alias("p")).distinct().count())
    assert r > 1

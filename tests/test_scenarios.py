import math
from decimal import Decimal, localcontext

import numpy as np
import pytest
from pyspark.sql import functions as F

from tripwire.functions.buckets import log_bucket
from tripwire.operators import metrics, models, nearest, prep, scenarios
from tripwire.operators.cumulative import exact_percentiles


def _hits(spark, n, hits):
    return spark.range(n).select(F.col("id").alias("pos"), F.when(F.col("id") < hits, F.when(F.col("id") % 2 == 0, "a").otherwise("b")).alias("hit_zone"))


@pytest.mark.parametrize("n, d, k", [(100, 3, 10), (20, 20, 1), (1000, 1, 999), (50, 5, 46), (7, 0, 3), (12, 2, 0), (100000, 7, 30000)])
def test_uniform_access_is_hypergeometric(spark, n, d, k):
    r = scenarios.uniform_access(_hits(spark, n, d), [("s", lambda t: F.lit(k))]).first()
    assert r.detection_rate == pytest.approx(1 - math.comb(n - d, k) / math.comb(n, k), abs=1e-9)
    assert r.n_rows == k and r.decoy_ratio == pytest.approx(d / n if k else 0)


def test_false_alarms_with_planted_hits(spark):
    r = scenarios.false_alarm_rate(_hits(spark, 1000, 4), 50).first()
    assert 0 < r.false_positive_rate < 1 and r.false_positive_rate == pytest.approx(1 - math.comb(996, 50) / math.comb(1000, 50), abs=1e-9)
    assert (r.n_clean, r.n_false_hits, r.draw_size) == (1000, 4, 50)
    assert scenarios.false_alarm_rate(_hits(spark, 0, 0)).first().false_positive_rate == 0


def test_alarm_probability_on_large_tables(spark):
    cases = [(n, d, k) for n in (60, 10**4, 10**7, 10**9, 10**10, 10**12) for d in (1, 10, 45, 3000, 10**5) for k in (1, 50, 5000, 10**5) if d + k <= n]
    cases += [(60, 30, 30), (2, 1, 1), (70, 20, 50)]

    def want(n, d, k):
        with localcontext(prec=60):
            none = Decimal(1)
            for i in range(min(d, k)):
                none *= 1 - Decimal(max(d, k)) / (n - i)
            return float(1 - none)

    df = spark.createDataFrame(cases, "n long, d long, k long").withColumn("p", scenarios.alarm_probability(F.col("n"), F.col("d"), F.col("k")))
    for r in df.collect():
        assert r.p == pytest.approx(want(r.n, r.d, r.k), rel=1e-10), (r.n, r.d, r.k)


def test_selected_access(spark):
    r = scenarios.selected_access(_hits(spark, 10, 3), "t").first()
    assert tuple(r) == ("t", 10, 1.0, 0.3, '{"a":2,"b":1}')


def test_repeated_anchors(spark):
    rng = np.random.default_rng(0)
    a = rng.normal(size=(600, 3))
    a[:200] = a[0]  # a third of the anchors are one row
    q = rng.normal(size=(150, 3))
    ad = spark.createDataFrame([tuple(map(float, x)) for x in a], "a double, b double, c double")
    qd = spark.createDataFrame([(i, *map(float, x)) for i, x in enumerate(q)], "k int, a double, b double, c double")
    got = {r.k: r.min_dist for r in nearest.min_dist_cells(qd, ad, "k", ["a", "b", "c"], max_group=50).collect()}
    want = np.sqrt(((q[:, None] - a[None]) ** 2).sum(-1)).min(1)
    assert all(got[i] == pytest.approx(want[i], rel=1e-12) for i in range(150))


@pytest.mark.parametrize("n", [300, 5000, 120000])
def test_forest_samples_the_same_way_at_every_size(spark, n):
    df = spark.range(n).select(F.col("id").alias("k"), F.rand(1).alias("x"), F.rand(2).alias("y"))
    nodes = models.fit_isolation_forest(df, ["x", "y"], "k", n_trees=20, psi=256)
    roots = nodes.filter("node = 0").collect()
    assert len(roots) == 20 and all(r["size"] == 256 for r in roots)


def test_buckets_of_odd_values(spark):
    inf = float("inf")
    vals = [-inf, -1e300, -2.0, -1e-300, 0.0, 1e-300, 3.0, 1e300, inf, float("nan"), None]
    got = [r.b for r in spark.createDataFrame([(v,) for v in vals], "x double").select(log_bucket(F.col("x")).alias("b")).collect()]
    assert got[:-1] == sorted(got[:-1]) and len(set(got)) == len(got) and got[-1] is None


def test_nan_ranks_highest(spark):
    nan = float("nan")
    df = spark.createDataFrame([(nan, 1), (0.5, 0), (2.0, 1), (3.0, 0)], "score double, label int")
    assert metrics.auc_roc(df).first()["auc_roc"] == pytest.approx(0.75)
    assert exact_percentiles(spark.createDataFrame([(1.0,), (float("inf"),), (None,), (0.0,)], "v double"), "v", [0.0, 0.5]) == [0.0, 1.0]


def test_null_type_has_no_dummy(spark):
    r = prep.one_hot_type(spark.createDataFrame([(None,), ("DEBIT",)], "type string")).collect()
    assert sum(r[0]) == 0 and sum(r[1]) == 1


def test_percentiles_of_crowded_and_odd_values(spark):
    rng = np.random.default_rng(3)
    cases = {"band": 1.7e9 + rng.integers(0, 5_000_000, 20000).astype(float), "ties": np.repeat([5.0, 1.0, 2.0], [7000, 100, 50]),
             "tails": np.concatenate([rng.normal(size=3000), [1e300, -1e300, 0.0, 1e-300]]), "one": np.array([3.5])}
    for name, x in cases.items():
        df = spark.createDataFrame([(float(a),) for a in x], "v double")
        qs = [0.0, 0.1, 0.5, 0.8, 0.965, 1.0]
        assert exact_percentiles(df, "v", qs) == pytest.approx([float(np.quantile(x, q)) for q in qs], rel=1e-12), name
    assert exact_percentiles(spark.createDataFrame([(None,)], "v double"), "v", [0.5]) == [None]
    assert math.isnan(exact_percentiles(spark.createDataFrame([(1.0,), (float("nan"),)], "v double"), "v", [1.0])[0])

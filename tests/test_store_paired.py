"""Saved lookup with upserts, paired AUC, prefix sums in crowded bands, optional subpackage."""
import math
import random
import subprocess
import sys

import numpy as np
import pytest
from pyspark.sql import functions as F

from tripwire.operators import metrics
from tripwire.operators.cumulative import prefix_sums
from tripwire.sources.lookup_store import LookupStore

ROWS = "row_hash string, zone string"


def test_lookup_store(spark, tmp_path):
    frame = lambda *r: spark.createDataFrame(list(r), ROWS)
    held = lambda s: {r.row_hash: r.zone for r in s.lookup().collect()}
    store = LookupStore(spark, str(tmp_path / "lookup"))
    assert held(store) == {} and not store.compact()
    assert store.register(1, frame(("a", "random"), ("a", "cluster"), ("a", None), ("b", "random"), ("c", "other"), ("d", None), (None, "random")))
    assert held(store) == {"a": "cluster", "b": "random", "c": "other", "d": None}
    # a later id first, then a smaller one: the greater id stays the last registration
    assert store.register(3, frame(("a", "random"), ("e", "high_value")))
    assert store.compact() and not store.compact()
    assert store.register(2, frame(("a", "high_value"), ("b", "edge_case"), ("b", "edge_case")))
    assert not store.register(2, frame(("z", "random"))) and not store.register(1, frame(("z", "random")))
    want = {"a": "random", "b": "edge_case", "c": "other", "d": None, "e": "high_value"}
    assert held(store) == want and store.batches() == [1, 2, 3]
    summary = {r.zone: (r.n_registered, r.n_hashes) for r in store.summary().collect()}
    assert summary == {"random": (3, 1), "cluster": (1, 0), "other": (1, 1), None: (2, 1), "high_value": (2, 1), "edge_case": (2, 1)}
    assert store.compact() and held(LookupStore(spark, str(tmp_path / "lookup"))) == want
    assert {r.zone: (r.n_registered, r.n_hashes) for r in store.summary().collect()} == summary
    assert store.register(4, frame().limit(0)) and held(store) == want
    # a batch that never got its name is not read, and a second writer of an id loses
    (tmp_path / "lookup/unfinished/9-x/rows").mkdir(parents=True)
    made = f"{store.path}/unfinished/4-abc"
    frame(("q", "random")).write.parquet(f"{made}/rows")
    assert not store._place(made, "batches", "batch=4") and held(store) == want


def brute_paired(rows):
    pos, neg = ([r for r in rows if r[2] == y] for y in (1, 0))
    k = lambda x, y: 1.0 if x > y else 0.5 if x == y else 0.0
    v10 = [[np.mean([k(p[i], n[i]) for n in neg]) for p in pos] for i in (0, 1)]
    v01 = [[np.mean([k(p[i], n[i]) for p in pos]) for n in neg] for i in (0, 1)]
    var = np.var(np.subtract(v10[1], v10[0]), ddof=1) / len(pos) + np.var(np.subtract(v01[1], v01[0]), ddof=1) / len(neg)
    a, b = np.mean(v10[0]), np.mean(v10[1])
    return len(pos), len(neg), a, b, b - a, var, (b - a) / math.sqrt(var)


def test_paired_auc(spark):
    rng = random.Random(6)
    rows = [(float(rng.randint(0, 30)) + y * 4, rng.random() * 10 + y, y) for y in (rng.random() < .3 for _ in range(300))]
    rows = [(a, b, int(y)) for a, b, y in rows]
    df = lambda r: spark.createDataFrame(r, "a double, b double, label int")
    got = metrics.paired_auc(df(rows), "a", "b").first()
    assert tuple(got) == pytest.approx(brute_paired(rows), rel=1e-9)
    same = metrics.paired_auc(df(rows), "a", "a").first()
    assert same.auc_delta == 0 and same.var_delta == pytest.approx(0, abs=1e-15) and same.z is None
    one = metrics.paired_auc(df([(1.0, 2.0, 1), (0.5, 3.0, 0), (0.1, 0.2, 0)]), "a", "b").first()
    assert (one.auc_a, one.auc_b, one.var_delta) == (1.0, 0.5, None)
    assert tuple(metrics.paired_auc(df([(1.0, 2.0, 1)]), "a", "b").first()) == (1, 0, None, None, None, None, None)
    assert metrics.paired_auc(df(rows).limit(0), "a", "b").first().n_pos == 0


def test_models_are_compared_on_the_same_rows(spark):
    """SQL recomputes both AUCs from the scores of two fitted forests."""
    import duckdb
    from tripwire.operators.models import paired_forest_scores
    rng = random.Random(1)
    make = lambda n, noise: [(i, *(x := [rng.gauss(0, 1) for _ in range(3)]), int(x[0] + noise * rng.gauss(0, 1) > .8)) for i in range(n)]
    schema = "k long, f0 double, f1 double, f2 double, label int"
    clean, test = (spark.createDataFrame(make(n, .7), schema) for n in (400, 200))
    decoys = spark.createDataFrame([(*r[:4], 0) for r in make(150, .1)], schema)
    scores = paired_forest_scores(clean, clean.union(decoys), test, ["f0", "f1", "f2"], "label", "k", num_trees=10, max_depth=4)
    got = metrics.paired_auc(scores, "score_clean", "score_injected").first()
    s = scores.toPandas()  # noqa: F841
    assert len(s) == 200 and (s.score_clean != s.score_injected).any()
    for col, value in (("score_clean", got.auc_a), ("score_injected", got.auc_b)):
        want = duckdb.sql(f"SELECT avg(CASE WHEN p.{col} > n.{col} THEN 1 WHEN p.{col} = n.{col} THEN 0.5 ELSE 0 END) FROM s p, s n WHERE p.label = 1 AND n.label = 0").fetchall()[0][0]
        assert value == pytest.approx(want, rel=1e-9)
    assert got.var_delta > 0


def test_prefix_sums_in_a_crowded_band(spark):
    """All values within 0.4 %, and one part far larger than the others."""
    n = 4000
    df = spark.range(n).select((F.lit(1.0) + F.col("id") * 1e-9).alias("v"), F.when(F.col("id") % 100 == 0, "b").otherwise("a").alias("p"), F.lit(1).cast("long").alias("c"))
    got = prefix_sums(df, "v", ["c"], parts=["p"], totals=True).toPandas().sort_values(["p", "v"])
    for _, g in got.groupby("p"):
        assert g.c_before.tolist() == list(range(len(g))) and set(g.c_total) == {len(g)}
    from tripwire.operators import cumulative
    ranges = df.repartitionByRange(8, "p", "v").groupBy(F.spark_partition_id()).count().toPandas()["count"]
    assert ranges.max() < 3 * ranges.median() and cumulative.prefix_sums(df.limit(0), "v", ["c"]).count() == 0


@pytest.mark.parametrize("module", ["xxhash", "public_tokenizers", "tripwire.llm", "corpus_pipeline"])
def test_core_queries_without_the_optional_subpackage(module):
    code = f"import sys; sys.modules[{module!r}] = None; import __spark_entry__ as e; from tripwire.plans import QUERIES; " \
           "assert set(e.queries()) == set(QUERIES) and len(QUERIES) > 100 and set(e.oracle_sql()) <= set(QUERIES)"
    subprocess.run([sys.executable, "-c", code], check=True, cwd=__file__.rsplit("/tests/", 1)[0])


def test_keys_at_ranks(spark):
    from tripwire.operators.ranking import at_ranks, int_range_bucket
    rng = random.Random(9)
    keys = sorted(rng.sample(range(10 ** 6), 3000)) + [10 ** 12]  # one outlying key
    df = spark.createDataFrame([(k,) for k in keys], "k long").repartition(7)
    asked = [1, 2, 2, 1500, 3000, 3001, 3002, 0, None] + [rng.randint(1, 3001) for _ in range(200)]
    wanted = spark.createDataFrame(list(enumerate(asked)), "draw int, r long")
    for n in (1, 64, 4096):
        got = {r.draw: r.k for r in at_ranks(df, "k", wanted, "r", int_range_bucket(df, "k", n_buckets=n)).collect()}
        assert got == {i: keys[r - 1] for i, r in enumerate(asked) if r and 1 <= r <= len(keys)}
    assert at_ranks(df.limit(0), "k", wanted, "r", int_range_bucket(df.limit(0), "k")).count() == 0


def test_snap_discrete(spark):
    from tripwire.operators.synth import snap_discrete
    rows = [(0.2, 0.9, 0.4, 0.6, 1), (0.5, 0.5, 0.1, 0.5, 2), (-3.0, -2.0, -9.0, 7.0, 3), (None, float("nan"), None, None, 4)]
    df = spark.createDataFrame(rows, "a double, b double, c double, f double, k int")
    snapped = [tuple(r) for r in snap_discrete(df, ["a", "b", "c"], ["f"]).orderBy("k").collect()]
    assert snapped == [(0, 1, 0, 1, 1), (1, 0, 0, 0, 2), (0, 1, 0, 1, 3), (1, 0, 0, 0, 4)]
    # z-scores: the nearest valid row by brute force, and the results are z-scores too
    rng = random.Random(3)
    params = {c: (rng.uniform(.1, .9), rng.uniform(.2, 2)) for c in "abcf"}
    z = lambda c, v: (v - params[c][0]) / params[c][1]
    rows = [(*(rng.gauss(0, 2) for _ in range(4)), i) for i in range(50)]
    got = snap_discrete(spark.createDataFrame(rows, df.schema), ["a", "b", "c"], ["f"], params).orderBy("k").collect()
    for x, g in zip(rows, got):
        best = min(range(3), key=lambda t: sum((x[i] - z(c, float(i == t))) ** 2 for i, c in enumerate("abc")))
        flag = min((0.0, 1.0), key=lambda v: abs(x[3] - z("f", v)))
        assert tuple(g) == pytest.approx((*(z(c, float(i == best)) for i, c in enumerate("abc")), z("f", flag), x[4]))


def test_top_up_rechecks_the_cut(spark, monkeypatch):
    """All rows are farther from the real rows than the first draws' percentile."""
    from tripwire.operators import nearest, synth
    rng = np.random.default_rng(4)
    cols = [f"x{j}" for j in range(3)]
    real = spark.createDataFrame([(i, *map(float, rng.normal(size=3))) for i in range(300)], "tx_id long, " + ", ".join(f"{c} double" for c in cols))
    kw = {"features": cols, "n_components": 3, "mixture_k": 2, "max_iter": 10}
    # one fit for all: fits of the same rows differ in their last bits from run to run
    p = synth.fit_pca(real, cols, 3)
    mix = synth.fit_mixture(synth.project(real, p), p.k, 2, 42, 10)
    monkeypatch.setattr(synth, "fit_pca", lambda *a, **k: p)
    monkeypatch.setattr(synth, "fit_mixture", lambda *a, **k: mix)
    out, plain = (synth.mixture_decoys(real, 200, recheck=r, **kw).toPandas() for r in (True, False))
    assert len(out) == len(plain) == 200 and out[synth.ID].is_unique
    anchors = real.toPandas()[cols].to_numpy()
    dist = lambda d: np.sqrt(((d[cols].to_numpy()[:, None] - anchors[None]) ** 2).sum(-1)).min(1)
    first = synth.inverse(synth.draw_mixture(spark, mix, 200, "gmm42"), p).toPandas()
    threshold = np.percentile(dist(first), 10)
    assert dist(out).min() > threshold and (out[synth.ID] < 200).sum() == (dist(first) > threshold).sum() < 200
    assert set(plain[synth.ID][plain[synth.ID] < 200]) == set(out[synth.ID][out[synth.ID] < 200])

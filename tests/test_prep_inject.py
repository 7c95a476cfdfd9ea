"""Preparation quirks, splits, scaling, nearest-anchor paths, injection."""

import math

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from tripwire.operators import inject, nearest, prep
from tripwire.schema import FEATURES, TYPE_COLUMNS


def _raw(spark, rows):
    return spark.createDataFrame(rows, "tx_id long, step int, type string, amount double, nameOrig string, "
                                       "oldbalanceOrg double, newbalanceOrig double, nameDest string, "
                                       "oldbalanceDest double, newbalanceDest double, isFraud int, isFlaggedFraud int")


def test_zero_balance_ratio_and_risky_quirk(spark):
    raw = _raw(spark, [(1, 1, "CASH-OUT", 100.0, "a", 0.0, 0.0, "b", 0.0, 100.0, 0, 0),
                       (2, 1, "TRANSFER", 10.0, "a", 50.0, 40.0, "b", 5.0, 15.0, 1, 0)])
    f = {r.tx_id: r for r in prep.feature_frame(raw).collect()}
    assert math.isclose(f[1].amount_to_orig_ratio, 100.0 / 1e-9)
    assert f[1].is_risky_type == 0.0 and f[2].is_risky_type == 1.0      # raw CASH-OUT is not risky
    assert f[1].type_CASH_OUT == 1.0 and f[1].orig_zeroed == 1.0
    assert all(getattr(f[2], c) == (1.0 if c == "type_TRANSFER" else 0.0) for c in TYPE_COLUMNS)
    g = {r.tx_id: r for r in prep.feature_frame(raw, normalize_first=True).collect()}
    assert g[1].is_risky_type == 1.0


def test_feature_order(views):
    assert prep.feature_frame(views.raw).columns == ["tx_id", *FEATURES, "isFraud"]


def test_stratified_split_exact(views):
    s = prep.stratified_split(views.ledger.select("tx_id", "isFraud"))
    c = {(r.isFraud, r.split): r["count"] for r in s.groupBy("isFraud", "split").count().collect()}
    for y in (0, 1):
        n = sum(v for (yy, _), v in c.items() if yy == y)
        t = math.floor(n * 0.2 + 0.5)
        v = math.floor((n - t) * 0.125 + 0.5)
        assert c.get((y, "test"), 0) == t and c.get((y, "val"), 0) == v


def test_scaler_population_std(spark):
    df = spark.createDataFrame(pd.DataFrame({"a": [1.0, 2.0, 3.0], "b": [5.0, 5.0, 5.0]}))
    p = prep.scaler_params(prep.fit_scaler(df, ["a", "b"]))
    assert math.isclose(p["a"][1], np.std([1, 2, 3])) and p["b"][1] == 0.0
    out = prep.apply_scaler(df, p, ["a", "b"]).collect()
    assert [r.b for r in out] == [0.0, 0.0, 0.0]


def test_clip_bounds(spark):
    real = spark.createDataFrame(pd.DataFrame({"a": [0.0, 1.0, 2.0, 3.0]}))
    dec = spark.createDataFrame(pd.DataFrame({"a": [-100.0, 1.5, 100.0]}))
    m, s = 1.5, float(np.std([0, 1, 2, 3]))
    got = sorted(r.a for r in prep.clip_to_real(dec, real, ["a"]).collect())
    assert got == [m - 3 * s, 1.5, m + 3 * s]


def _pts(spark, n, seed, off=0.0):
    rng = np.random.default_rng(seed)
    x = rng.normal(off, 1.0, (n, 3))
    return spark.createDataFrame(pd.DataFrame({"k": np.arange(n), "a": x[:, 0], "b": x[:, 1], "c": x[:, 2]})), x


def test_nearest_asks_few_leaves_and_skips_null_rows(spark, monkeypatch):
    """A point goes to its own leaf and to the few whose box is nearer, however many
    there are; an anchor or a point with a NULL feature has no distance."""
    rng = np.random.default_rng(5)
    feats = ["a", "b", "c", "d", "e"]
    an, q = (rng.normal(size=(n, 5)) * [3, 2, 1, 0.01, 0] for n in (8000, 400))
    q[:40] = an[:40]
    rows = [(i, *map(float, x)) for i, x in enumerate(q)] + [(400, None, 0.0, 0.0, 0.0, 0.0)]
    schema = ", ".join(f"{f} double" for f in feats)
    anchors = spark.createDataFrame([tuple(map(float, x)) for x in an] + [(None, 0.0, 0.0, 0.0, 0.0)] * 30, schema)
    written, write = [], nearest.materialize
    def record(df, *name):
        out = write(df, *name)
        if "k" in out.columns:
            written.append(out.count())
        return out
    monkeypatch.setattr(nearest, "materialize", record)
    got = {r.k: r.min_dist for r in nearest.min_dist_cells(spark.createDataFrame(rows, "k long, " + schema), anchors, "k", feats, n_cells=200).collect()}
    want = np.sqrt(((q[:, None, :] - an[None, :, :]) ** 2).sum(-1)).min(1)
    assert sorted(got) == list(range(400)) and max(abs(got[i] - want[i]) for i in got) < 1e-12
    assert max(written) <= 12 * 400      # the cells before sent them to 22,714


def test_high_value_placement_asks_only_leaves_within_the_kth_distance(spark, monkeypatch):
    rng = np.random.default_rng(9)
    an, q = rng.normal(size=(6000, 4)), rng.normal(size=(900, 4)) * 1.5
    q[:40] = an[-40:]                       # forty ties at distance 0
    feats = ["a", "b", "c", "d"]
    schema = "tx_id long, isFraud int, " + ", ".join(f"{f} double" for f in feats) + ", amount double"
    real = spark.createDataFrame([(i, 0, *map(float, x), 10.0 if i >= 4000 else 1.0) for i, x in enumerate(an)], schema)
    pool = spark.createDataFrame([(i, 0, *map(float, x), 1.0) for i, x in enumerate(q)], schema)
    asked, write = [], nearest.materialize

    def record(df, name):
        out = write(df, name)
        if name == "others":
            asked.append(out.count())
        return out
    monkeypatch.setattr(nearest, "materialize", record)
    ctx = inject.InjectContext(features=feats, high_value_pct=100 / 3)
    dist = np.sqrt(((q[:, None, :] - an[None, 4000:, :]) ** 2).sum(-1)).min(1)
    for k in (90, 25, 900):                 # 25: inside the ties, which the key breaks
        got = inject.strategy_high_value(real, pool, k, ctx, n_cells=100)
        assert sorted(r.tx_id for r in got.collect()) == sorted(sorted(range(900), key=lambda i: (dist[i], i))[:k])
    assert asked[0] < asked[2] / 4 and asked[1] <= asked[0]     # before, every point asked whatever k was
    kept = {r.tx_id: r.min_dist for r in nearest.min_dist_cells(pool, real.filter("tx_id >= 4000"), "tx_id", feats, k=90).collect()}
    assert 90 <= len(kept) < 200 and max(abs(kept[i] - dist[i]) for i in kept) < 1e-12


def test_nearest_paths_agree_with_brute_force(spark):
    q, xq = _pts(spark, 300, 1)
    a, xa = _pts(spark, 2000, 2, 0.5)
    brute = np.sqrt(((xq[:, None, :] - xa[None, :, :]) ** 2).sum(-1)).min(1)
    b = {r.k: r.min_dist for r in nearest.min_dist_broadcast(q, a, "k", ["a", "b", "c"]).collect()}
    c = {r.k: r.min_dist for r in nearest.min_dist_cells(q, a, "k", ["a", "b", "c"], max_group=150).collect()}
    assert len(c) == 300
    for i in range(300):
        assert math.isclose(b[i], brute[i], rel_tol=1e-12) and math.isclose(c[i], brute[i], rel_tol=1e-12)


def test_budget_and_quotas():
    assert inject.decoy_budget(10500, 1438, 0.05) == int(10500 * 0.05 / 0.95)
    assert inject.decoy_budget(10 ** 6, 10, 0.05) == 10
    assert inject.zone_quotas(2) == {"random": 1, "edge_case": 1, "cluster": 1, "high_value": 1}


def test_smallest_k_ties_by_key(spark):
    df = spark.createDataFrame([(i, float(i % 3)) for i in range(30)], "k long, v double")
    got = sorted(r.k for r in inject.smallest_k(df, F.col("v"), "k", 12).collect())
    assert got == sorted([i for i in range(30) if i % 3 == 0] + [1, 4])


def test_unknown_zone_is_random(spark):
    real = spark.createDataFrame([(i, 0) for i in range(20)], "tx_id long, isFraud int")
    dec = spark.createDataFrame([(i,) for i in range(100, 150)], "tx_id long")
    got = inject.place("mystery", real, dec, 7, inject.InjectContext())
    assert got.count() == 7 and got.columns == dec.columns


def test_unscaled_train_keeps_train_rows_unscaled(spark):
    from tripwire.operators import prep
    feats = spark.createDataFrame([(i, float(i) * 10, i % 2) for i in range(10)], "tx_id long, amount double, isFraud int")
    split = spark.createDataFrame([(i, "train" if i < 6 else "test") for i in range(10)], "tx_id long, split string")
    got = prep.unscaled_train(feats.join(split, "tx_id"))
    assert got.columns == feats.columns
    assert sorted((r.tx_id, r.amount) for r in got.collect()) == [(i, float(i) * 10) for i in range(6)]


def test_injection_reads_its_inputs_once(spark):
    """Before, every zone and count computed the real rows and the pool anew."""
    rng = np.random.default_rng(11)
    seen = {n: spark.sparkContext.accumulator(0) for n in ("real", "pool")}
    frames = {}
    for name, n in (("real", 400), ("pool", 60)):
        x = rng.normal(size=(n, 2))
        df = spark.createDataFrame(pd.DataFrame({"tx_id": np.arange(n) + (0 if name == "real" else 1000), "a": x[:, 0], "b": x[:, 1], "amount": np.abs(x[:, 0]),
                                                 "isFraud": (x[:, 1] > 0.5).astype(int), "row_hash": [f"{name}{i}" for i in range(n)]}))
        frames[name] = df.filter(F.udf(lambda k, at=seen[name]: at.add(1) or True, "boolean")("tx_id"))
    ctx = inject.InjectContext(features=["a", "b"], rf_trees=2, rf_depth=2)
    rows, _, quotas = inject.inject_decoys(frames["real"], frames["pool"], ctx, ratio=0.1)
    assert rows.count() == 400 + sum(quotas.values())
    assert {n: a.value for n, a in seen.items()} == {"real": 400, "pool": 60}

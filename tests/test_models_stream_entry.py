"""Isolation forest, synthesis invariants, streaming = batch, driver contract."""

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from tripwire.operators import models, synth
from tripwire.session import materialize

from .conftest import SF001


def _blob(spark, n=2000, seed=0):
    rng = np.random.default_rng(seed)
    x = rng.normal(0, 1, (n, 4))
    x[:20] += 8.0                                  # 1 % obvious outliers
    pdf = pd.DataFrame(x, columns=list("abcd"))
    pdf.insert(0, "k", np.arange(n))
    return spark.createDataFrame(pdf)


def test_isolation_forest_ranks_outliers_and_contamination(spark):
    df = _blob(spark)
    forest = models.fit_isolation_forest(df, list("abcd"), "k", n_trees=30)
    assert forest.select("tree").distinct().count() == 30
    sizes = forest.filter(F.col("node") == 0).select("size").distinct().collect()
    assert [r.size for r in sizes] == [256]
    s = models.score_isolation_forest(df, forest, list("abcd"), "k")
    top = {r.k for r in s.orderBy(F.desc("anomaly_score")).limit(20).collect()}
    assert len(top & set(range(20))) >= 18
    thr = models.contamination_threshold(s, 0.05)
    share = models.flag_outliers(s, thr).agg(F.avg(F.col("is_outlier").cast("double"))).first()[0]
    assert abs(share - 0.05) < 0.01


def test_isolation_forest_samples_on_large_input(spark):
    df = spark.range(120_000).withColumnRenamed("id", "k").select(
        "k", *[(F.rand(i) * 10).alias(c) for i, c in enumerate("abcd")])
    forest = models.fit_isolation_forest(df, list("abcd"), "k", n_trees=100)
    roots = forest.filter(F.col("node") == 0)
    assert roots.count() == 100
    assert {r.size for r in roots.select("size").distinct().collect()} == {256}


def test_mixture_draw_moments(spark):
    mix = synth.Mixture(np.array([1.0]), np.array([[2.0, -1.0]]),
                        np.array([np.linalg.cholesky(np.array([[1.0, 0.5], [0.5, 2.0]]))]))
    z = synth.draw_mixture(spark, mix, 20000, "t").toPandas()
    assert abs(z.z0.mean() - 2.0) < 0.05 and abs(z.z1.mean() + 1.0) < 0.05
    assert abs(np.cov(z.z0, z.z1)[0, 1] - 0.5) < 0.06 and abs(z.z1.var() - 2.0) < 0.1
    z2 = synth.draw_mixture(spark, mix, 20000, "t").toPandas()
    assert np.array_equal(z.sort_values("decoy_id").z0.to_numpy(), z2.sort_values("decoy_id").z0.to_numpy())


def test_forest_is_the_same_with_kept_node_ids(spark, monkeypatch):
    df = spark.range(600).select(*[F.randn(j).alias(c) for j, c in enumerate("abcd")]).withColumn("y", (F.col("a") * F.col("b") > F.col("c")).cast("int"))
    vec = models.fit_input(df.withColumn("y", F.col("y").cast("double")), list("abcd"), ["y"])
    monkeypatch.setattr(models, "fit_input", lambda *a, **k: vec)
    kept = models.fit_random_forest(df, list("abcd"), "y", 5, 6)
    monkeypatch.setattr(models, "NODE_IDS", 600 * 5 - 1)
    walked = models.fit_random_forest(df, list("abcd"), "y", 5, 6)
    assert kept.getCacheNodeIds() and not walked.getCacheNodeIds()
    assert [t.toDebugString.split("\n", 1)[1] for t in kept.trees] == [t.toDebugString.split("\n", 1)[1] for t in walked.trees]


def test_mixture_decoys_exact_count(spark):
    df = _blob(spark, 1500, 3).withColumnRenamed("k", "tx_id")
    out = synth.mixture_decoys(df, 300, features=list("abcd"), n_components=3, mixture_k=2, max_iter=10)
    assert out.count() == 300 and out.select("decoy_id").distinct().count() == 300


def test_stream_first_alarm_equals_batch(spark):
    from tripwire.plans import QUERIES
    s = {r.actor: tuple(r)[1:] for r in QUERIES["stream_first_alarm"](spark, SF001).collect()}
    b = {r.actor: (r.n_rows, r.n_decoys, r.first_alarm_batch) for r in QUERIES["first_alarm"](spark, SF001).collect()}
    assert s == b


def test_late_accesses_are_counted_and_a_replay_counts_once(spark, tmp_path):
    import datetime as dt
    import os
    import shutil
    from tripwire.streaming import detect_stream as ds
    base, src = ds.stream_dir(spark, "late"), str(tmp_path / "src")
    at = lambda day, hour=12: dt.datetime(2024, 1, day, hour)
    schema = "actor long, ts timestamp, hit_zone string"
    first = [(1, at(1), None), (1, at(1), "z"), (1, at(5), None)]
    # closed, closed, open (its end is 5 January midnight, the mark 5 January 11:00: closed too), same day, no time
    second = [(1, at(1), "z"), (2, at(2), None), (1, at(4, 23), None), (1, at(5, 1), "z"), (3, None, None)]
    for rows in (first, second):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(src)
        out = ds.run_windows_with_late(spark.readStream.schema(schema).parquet(src), base)
    want = {(1, 1): (2, 1, 1, 1), (1, 5): (2, 1, 0, 0), (2, 2): (0, 0, 1, 0), (1, 4): (0, 0, 1, 0), (3, None): (0, 0, 1, 0)}

    def got():
        return {(r.actor, r.window_start and r.window_start.day): (r.n_rows, r.n_decoys, r.n_late, r.n_late_decoys)
                for r in ds.windows_and_late(spark, out).collect()}
    assert got() == want
    for name in ("commits/1", "commits/.1.crc"):  # as if the driver was lost before batch 1 was committed
        if os.path.exists(f"{base}/checkpoint/{name}"):
            shutil.move(f"{base}/checkpoint/{name}", str(tmp_path / name.replace("/", "-")))
    ds.run_windows_with_late(spark.readStream.schema(schema).parquet(src), base)
    assert got() == want


def test_expired_and_live_actors_make_up_the_batch_totals(spark, tmp_path):
    import datetime as dt
    from tripwire.streaming import detect_stream as ds
    at = lambda day: dt.datetime(2024, 1, day)
    schema = "actor long, ts timestamp, batch int, hit_zone string"
    rows = [(1, at(1), 1, None), (1, at(2), 2, "z"), (1, at(9), 9, "z"), (2, at(8), 8, None), (2, at(10), 10, None), (3, at(3), 3, None), (None, at(1), 1, "z")]
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(str(tmp_path / "src"))
    out = ds.run_to_files(ds.expiring_first_alarm(spark.readStream.schema(schema).parquet(str(tmp_path / "src"))), "expiring")
    got = {(r.actor, r.expired_at.day): (r.n_rows, r.n_decoys, r.first_alarm_batch) for r in ds.read_output(spark, out, ds.PARTS).collect()}
    assert got == {(1, 4): (2, 1, 2), (3, 5): (1, 0, None), (None, 3): (1, 1, 1)}


def test_entry_contract(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    assert df.count() >= 0 and "first_alarm_batch" in df.columns
    assert set(E.oracle_sql()) <= set(E.queries())


def test_end_to_end_pipeline(spark, tmp_path):
    from tripwire.plans.pipeline import PipelineConfig, run_from_tables
    out = run_from_tables(spark, SF001, str(tmp_path / "run"),
                          PipelineConfig(salt="test", num_trees=5, max_depth=4))
    att = {r.scenario: r for r in out["attacks"].collect()}
    assert set(att) == {"bulk_steal_30", "bulk_steal_10", "slow_theft", "targeted_top20", "targeted_top10",
                        "mimicry_5pct", "mimicry_10pct"}
    assert att["bulk_steal_30"].detection_rate > 0.999
    assert out["false_alarm"].first().false_positive_rate == 0.0
    assert out["baselines"].count() == 3
    lk = spark.read.parquet(str(tmp_path / "run" / "lookup"))
    assert sorted(lk.columns) == ["row_hash", "zone"]
    inj = out["injected"]
    assert inj.filter("is_decoy").count() == sum(r.n_registered for r in
                                                 lookup_counts(inj))
    assert inj.select("pos").distinct().count() == inj.count()


def lookup_counts(inj):
    from tripwire.operators.lookup import registrations
    return registrations(inj.filter("is_decoy")).collect()


def test_stream_state_across_micro_batches(spark, tmp_path):
    """Events split into one file per 6-day span, read one file per trigger:
    running state and watermark windows must still equal the batch answers."""
    from tripwire.sources.fixtures import Views
    from tripwire.streaming import detect_stream as ds
    from tripwire.operators import detect
    v = Views.get(spark, SF001)
    src = str(tmp_path / "events")
    ev = spark.read.parquet(f"{SF001}/events.parquet")
    for i, lo in enumerate(range(1, 31, 6)):
        (ev.filter((F.dayofmonth("ts") >= lo) & (F.dayofmonth("ts") < lo + 6)).coalesce(1)
         .write.parquet(f"{src}/part{i}"))
    import glob
    import shutil
    flat = str(tmp_path / "flat")
    import os
    os.makedirs(flat)
    for i, f in enumerate(sorted(glob.glob(f"{src}/part*/*.parquet"))):
        shutil.copy(f, f"{flat}/events-{i}.parquet")
    acc = ds.access_stream(spark, flat, v.injected.count(), file_glob="events-*.parquet", max_files=1)
    hits = ds.stream_hits(acc, v.injected, v.lookup(), v.salt)
    out = ds.run_to_files(ds.running_first_alarm(hits), "t3_multi", "update")
    df = ds.read_output(spark, out, ds.STATE_OUT)
    assert df.select("mb").distinct().count() >= 5
    got = {r.actor: (r.n_rows, r.n_decoys, r.first_alarm_batch) for r in ds.latest_per_key(df, "actor").collect()}
    batch = detect.first_alarm(detect.access_hits(v.access, v.injected, v.lookup(), v.salt))
    want = {r.actor: (r.n_rows, r.n_decoys, r.first_alarm_batch) for r in batch.collect()}
    assert got == want


def test_mixture_steps_are_those_of_spark_ml(spark):
    from pyspark.ml.clustering import GaussianMixture
    from tripwire.operators.models import fit_input
    rng = np.random.default_rng(7)
    x = np.concatenate([rng.normal(0, 1, (3000, 3)), rng.normal(4, [0.5, 1, 2], (2000, 3)), rng.normal([-6, 3, 0], 0.3, (500, 3))])
    latent = spark.createDataFrame(pd.DataFrame(x, columns=["z0", "z1", "z2"])).coalesce(1)
    latent = materialize(latent)    # one file: Spark ML's start depends on the order of the parts
    for steps in (1, 12):
        want = GaussianMixture(k=3, seed=5, featuresCol="_features", maxIter=steps).fit(fit_input(latent, latent.columns))
        got = synth.fit_mixture(latent, 3, 3, 5, steps)
        np.testing.assert_allclose(got.weights, want.weights, rtol=1e-9)
        for m, chol, g in zip(got.means, got.chol, want.gaussiansDF.collect()):
            np.testing.assert_allclose(m, g["mean"].toArray(), rtol=1e-8, atol=1e-9)
            np.testing.assert_allclose(chol @ chol.T, g["cov"].toArray(), rtol=1e-7, atol=1e-8)


def test_fits_read_parts_of_one_size(spark, monkeypatch):
    """Before, a fit took the parts of its source's files, where one may hold nearly all rows."""
    rows = materialize(spark.range(40000).select(F.col("id").cast("double").alias("z0"), F.lit(1.0).alias("z1")).repartition(8, F.col("z0") > 100))
    parts = [sum(len(r.x) for r in p) for p in synth.em_blocks(rows, ["z0", "z1"]).rdd.glom().collect()]
    assert sum(parts) == 40000 * 16 and max(parts) <= 3 * sum(parts) / len(parts)
    monkeypatch.setattr(models, "EVEN_ROWS", 1000)
    even = models.even_rows(rows)
    parts = [len(p) for p in even.rdd.glom().collect()]
    assert sum(parts) == 40000 and max(parts) <= 3 * sum(parts) / len(parts) and even.distinct().count() == 40000


def _two_classes(spark, n=6000):
    rng = np.random.default_rng(3)
    pdf = pd.DataFrame({"a": rng.normal(size=n), "b": rng.normal(size=n).round(1), "c": rng.integers(0, 2, n).astype(float),
                        "d": rng.exponential(size=n) * (rng.random(n) < 0.5)})
    pdf["y"] = (pdf.a * pdf.b + 0.5 * pdf.d - 0.3 * pdf.c + 0.5 * rng.normal(size=n) > 0.4).astype(int)
    pdf["w"] = np.where(pdf.y == 1, 1.7, 0.6)
    return materialize(spark.createDataFrame(pdf).coalesce(1))


def test_block_forest_splits_as_spark_ml(spark):
    """Without a bootstrap and with all features per node nothing is drawn: both give the same tree."""
    from pyspark.ml.classification import RandomForestClassifier
    from tripwire.operators import forest
    df = _two_classes(spark)
    vec = models.fit_input(df.withColumn("y", F.col("y").cast("double")), list("abcd"), ["y", "w"])
    for depth in (3, 10):
        want = RandomForestClassifier(featuresCol="_features", labelCol="y", weightCol="w", numTrees=1, maxDepth=depth,
                                      featureSubsetStrategy="all", bootstrap=False).fit(vec)
        got = forest.fit_blocks(df, list("abcd"), "y", 6000, (0.6, 1.7), 1, depth, subset=4, bootstrap=False)
        a, b = (models.positive_proba(m, df, list("abcd")).select("a", "proba", "pred").orderBy("a").toPandas() for m in (want, got))
        np.testing.assert_allclose(b.proba, a.proba, atol=1e-12)
        assert (a.pred == b.pred).all()


def test_large_forest_keeps_nothing_per_row_and_tree(spark, monkeypatch):
    """Before, rows x trees counts and node ids were held for the whole fit, or all trees walked by Spark ML."""
    from tripwire.operators import forest
    df = _two_classes(spark)
    want = models.positive_proba(models.fit_random_forest(df, list("abcd"), "y", 20, 6, weight_col="w"), df, list("abcd"))
    monkeypatch.setattr(models, "EVEN_ROWS", 1000)
    monkeypatch.setattr(forest, "BLOCK_ROWS", 300)
    model = models.fit_random_forest(df, list("abcd"), "y", 20, 6, weight_col="w")
    assert isinstance(model, forest.BlockForest) and model.feature.shape == (20, 64) and len({r.tobytes() for r in model.cut}) == 20
    got = models.positive_proba(model, df, list("abcd"))
    right = lambda s: s.agg(F.avg((F.col("pred") == F.col("y")).cast("int"))).first()[0]
    assert abs(right(got) - right(want)) < 0.03
    both = got.select("a", "proba").join(want.select("a", F.col("proba").alias("q")), "a")
    assert both.select(F.corr("proba", "q")).first()[0] > 0.95
    again = models.positive_proba(models.fit_random_forest(df, list("abcd"), "y", 20, 6, weight_col="w"), df, list("abcd"))
    assert again.select("a", "proba").exceptAll(got.select("a", "proba")).count() == 0
    # three classes, or two weights of a class: Spark ML
    assert models.class_sizes(df.withColumn("y", F.col("y") + (F.col("a") > 1).cast("int")), "y") is None
    assert models.class_sizes(df.withColumn("w", F.col("a")), "y", "w") is None
    assert models.class_sizes(df, "y", "w") == (6000, (0.6, 1.7))


def test_bootstrap_draws_are_poisson():
    from tripwire.operators import forest
    k = forest.poisson(np.random.default_rng(0), 1 << 20)
    want = np.exp(-1) / np.cumprod([1, 1, 2, 3, 4, 5])
    np.testing.assert_allclose(np.bincount(k)[:6] / len(k), want, atol=0.002)
    assert k.max() < 12


def test_ledger_of_one_file_is_dealt_evenly(spark, tmp_path, monkeypatch):
    """Before, every step over the ledger had as many tasks as the orders file had row groups."""
    import datetime
    from tripwire.sources import fixtures
    n = 4000
    day = [datetime.datetime(1995, 1, 1) + datetime.timedelta(days=i % 700) for i in range(n)]
    orders = pd.DataFrame({"o_orderkey": range(n), "o_custkey": [i % 50 for i in range(n)], "o_orderstatus": ["FOP"[i % 3] for i in range(n)],
                           "o_totalprice": [100.0 + i for i in range(n)], "o_orderdate": day, "o_orderpriority": [fixtures.PRIORITY_TYPE[i % 4][0] for i in range(n)]})
    tables = {"orders": orders, "customer": pd.DataFrame({"c_custkey": range(50), "c_acctbal": [10.0 * i for i in range(50)]}),
              "events": pd.DataFrame({"event_id": range(10), "user_id": [1] * 10, "ts": day[:10]})}
    for name, pdf in tables.items():
        spark.createDataFrame(pdf).coalesce(1).write.parquet(f"{tmp_path}/{name}.parquet")
    monkeypatch.setattr(models, "EVEN_ROWS", 1000)
    v = fixtures.Views(spark, str(tmp_path))
    parts = [len(p) for p in v.ledger.rdd.glom().collect()]
    assert sum(parts) == n and max(parts) <= 1.5 * n / spark.sparkContext.defaultParallelism
    assert v.ledger.exceptAll(fixtures.ledger(spark, str(tmp_path))).count() == 0
    assert models.even_rows(v.ledger) is v.ledger       # even rows are not written again

"""Registered queries driven by model fits (PCA, mixture, random forest,
k-means, isolation forest). Their results depend on fitted models, so they
carry no SQL oracle; tests check their invariants instead.

Models run with the library's defaults over whole tables.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import functions as F

from tripwire.functions.buckets import sig_round, sig_round_sql as S
from tripwire.operators import inject, lookup, metrics, models, nearest, prep, scenarios, synth
from tripwire.operators.ranking import first_n
from tripwire.plans.q_inject import _w, scaled_inputs, scaled_test
from tripwire.plans.registry import query
from tripwire.schema import CONTENT_CENTS, FEATURES, FLAG_COLUMNS, TYPE_COLUMNS
from tripwire.session import ensure_checkpoint_dir, materialize
from tripwire.sources.fixtures import Views, raw_ledger

RF = {"num_trees": 100, "max_depth": 10}
N_TREES_IF = 100


def _legit_train(v: Views):
    train, pool, params = scaled_inputs(v)
    return prep.legit_only(train), train, pool, params


def _test(v: Views, params):
    return scaled_test(v)


@query("pca_latent")
def q_pca_latent(spark, sf):
    """G1: 10-component PCA latent of the legitimate train rows."""
    legit, *_ = _legit_train(Views.get(spark, sf))
    return synth.project(legit, synth.fit_pca(legit), keep=["tx_id"])


@query("gmm_fit")
def q_gmm_fit(spark, sf):
    """5-component full-covariance mixture in the PCA latent space."""
    legit, *_ = _legit_train(Views.get(spark, sf))
    p = synth.fit_pca(legit)
    mix = synth.fit_mixture(synth.project(legit, p), p.k)
    rows = [(i, float(mix.weights[i]), [float(x) for x in mix.means[i]]) for i in range(len(mix.weights))]
    return spark.createDataFrame(rows, "component int, weight double, mean array<double>")


@query("gmm_decoys")
def q_gmm_decoys(spark, sf):
    """n = max(500, 10 % of train) mixture decoys with the uniqueness cut and top-up."""
    legit, train, *_ = _legit_train(Views.get(spark, sf))
    n = max(500, int(train.count() * 0.10))
    return Views.get(spark, sf).memo("gmm_decoys", lambda: materialize(synth.mixture_decoys(legit, n), "gmm_decoys"))


@query("latent_stats")
def q_latent_stats(spark, sf):
    """Per-dimension mean / population std of the 8-dim latent."""
    legit, *_ = _legit_train(Views.get(spark, sf))
    p = synth.fit_pca(legit, k=8)
    return synth.latent_stats(synth.project(legit, p), p.k)


@query("latent_decoys")
def q_latent_decoys(spark, sf):
    """Latent-Gaussian decoys (noise 0.5), decoded and clipped to +-3 SD."""
    legit, train, *_ = _legit_train(Views.get(spark, sf))
    return synth.latent_decoys(legit, max(500, int(train.count() * 0.10)))


@query("uniqueness_cut", _w(f"""
, anc AS (SELECT * FROM (SELECT *, row_number() OVER (ORDER BY md5(concat(CAST(tx_id AS VARCHAR), ':anchors')), tx_id) AS rn FROM ztr) q WHERE rn <= 500),
dd AS (SELECT d.tx_id, {S('min(sqrt(' + ' + '.join(f'(d.{c} - a.{c}) * (d.{c} - a.{c})' for c in FEATURES) + '))')} AS min_dist
  FROM zdec d, anc a GROUP BY d.tx_id)
SELECT tx_id, min_dist FROM dd WHERE min_dist > (SELECT quantile_cont(min_dist, 0.1) FROM dd)""".replace("\n, anc AS", ",\nanc AS")))
def q_uniqueness_cut(spark, sf):
    """Pool decoys strictly farther from 500 sampled real rows than the 10th percentile."""
    _, train, pool, _ = _legit_train(Views.get(spark, sf))
    anchors = first_n(train, "tx_id", "anchors", 500)
    d = nearest.min_dist_broadcast(pool, anchors, "tx_id", FEATURES).withColumn("min_dist", sig_round(F.col("min_dist")))
    return synth.uniqueness_cut(d)


@query("discriminator")
def q_discriminator(spark, sf):
    """Q2/Q3: real-vs-decoy random forest accuracy and weighted metrics (pool decoys)."""
    legit, _, pool, _ = _legit_train(Views.get(spark, sf))
    m = synth.discriminator(legit, pool, decoy_key="tx_id", **RF)
    return spark.createDataFrame([m])


@query("auc_models")
def q_auc_models(spark, sf):
    """Forests fitted without and with the decoys (labelled 0) in the training
    rows, compared on the same clean test rows."""
    v = Views.get(spark, sf)
    train, pool, params = scaled_inputs(v)
    cols = ["tx_id", *FEATURES, "isFraud"]
    injected = train.select(*cols).unionByName(pool.withColumn("isFraud", F.lit(0)).select(*cols))
    scores = models.paired_forest_scores(train.select(*cols), injected, scaled_test(v), FEATURES, "isFraud", "tx_id", **RF)
    return metrics.paired_auc(scores, "score_clean", "score_injected", "isFraud")


def _noise(c: str, k: int) -> str:
    """A feature off its valid values, the same in both engines."""
    return f"CAST({c} AS DOUBLE) + ((tx_id * {2 * k + 3}) % 17 - 8) / 10.0E0"


_SNAP = {c: _noise(c, k) for k, c in enumerate(TYPE_COLUMNS + FLAG_COLUMNS)}


@query("snapped_decoys", "WITH x AS (SELECT tx_id, " + ", ".join(f"{e} AS {c}" for c, e in _SNAP.items()) + """ FROM pool_features),
b AS (SELECT *, list_sort([""" + ", ".join(f"{{'d': 1 - 2 * {c}, 'i': {i}}}" for i, c in enumerate(TYPE_COLUMNS)) + """])[1].i AS best FROM x)
SELECT tx_id, """ + ", ".join([f"CASE WHEN best = {i} THEN 1.0E0 ELSE 0.0E0 END AS {c}" for i, c in enumerate(TYPE_COLUMNS)]
                             + [f"CASE WHEN abs({c} - 1) < abs({c}) THEN 1.0E0 ELSE 0.0E0 END AS {c}" for c in FLAG_COLUMNS]) + " FROM b")
def q_snapped_decoys(spark, sf):
    """Continuous type dummies and flags of the pool rows moved to the nearest valid values."""
    v = Views.get(spark, sf)
    x = prep.feature_frame(v.pool_raw).select("tx_id", *[F.expr(e).alias(c) for c, e in _SNAP.items()])
    return synth.snap_discrete(x)


@query("workflow")
def q_workflow(spark, sf):
    """All layers in order with their reports written; returns every report row
    as (report, row) and the sizes of the injected table and of the lookup."""
    from tripwire.plans.pipeline import PipelineConfig, run_from_tables
    out = os.path.join(ensure_checkpoint_dir(spark), "io", f"workflow-{uuid.uuid4().hex[:8]}")
    made = run_from_tables(spark, sf, out, PipelineConfig(salt=Views.get(spark, sf).salt))
    sizes = {k: made[k].agg(F.count(F.lit(1)).alias("n")) for k in ("injected", "lookup")}
    found = None
    for name, df in ({k: d for k, d in made.items() if k not in sizes} | sizes).items():
        part = df.select(F.lit(name).alias("report"), F.to_json(F.struct("*")).alias("row"))
        found = part if found is None else found.unionByName(part)
    return found


@query("quality_summary")
def q_quality_summary(spark, sf):
    """Q9: discriminator + per-feature summary of the pool decoys, with the pass flag."""
    legit, _, pool, _ = _legit_train(Views.get(spark, sf))
    q, _ = synth.evaluate_quality(legit, pool, decoy_key="tx_id", **RF)
    return spark.createDataFrame([q])


@query("generate_decoys")
def q_generate_decoys(spark, sf):
    """Latent generator, switching to the mixture when the discriminator
    accuracy exceeds 0.65."""
    legit, train, *_ = _legit_train(Views.get(spark, sf))
    dec, q = synth.generate_decoys(legit, max(500, int(train.count() * 0.10)), **RF)
    return dec.withColumn("method", F.lit(q["method"]))


def _ctx():
    return inject.InjectContext(amount="amount_raw", rf_trees=RF["num_trees"], rf_depth=RF["max_depth"])


@query("zone_edge")
def q_zone_edge(spark, sf):
    """I4: decision-boundary placement (RF on the train rows)."""
    _, train, pool, _ = _legit_train(Views.get(spark, sf))
    k = inject.zone_quotas(inject.decoy_budget(train.count(), pool.count()))["edge_case"]
    return inject.strategy_edge_case(train, pool, k, _ctx()).select("tx_id", "min_dist")


@query("zone_cluster")
def q_zone_cluster(spark, sf):
    """K-means centroid placement."""
    _, train, pool, _ = _legit_train(Views.get(spark, sf))
    k = inject.zone_quotas(inject.decoy_budget(train.count(), pool.count()))["cluster"]
    return inject.strategy_cluster(train, pool, k, _ctx()).select("tx_id", "min_dist")


def _pool_hash(v: Views, pool):
    return pool.join(v.pool_zoned.select("tx_id", "row_hash"), "tx_id")


@query("inject")
def q_inject(spark, sf):
    """All four zones placed, assembled, permuted; lookup registered."""
    return _injected(Views.get(spark, sf)).select("pos", "tx_id", "isFraud", "is_decoy", "zone", "row_hash")


def _injected(v: Views):
    """The injected train rows (I12), placed once for all queries that use them."""
    def build():
        _, train, pool, _ = _legit_train(v)
        real = train.join(lookup.hash_rows(v.ledger, CONTENT_CENTS, v.salt).select("tx_id", "row_hash"), "tx_id")
        return materialize(inject.inject_decoys(real, _pool_hash(v, pool), _ctx())[0], "injected")
    return v.memo("injected_train", build)


@query("rf_baseline")
def q_rf_baseline(spark, sf):
    """M1+M2: class-balanced RF trained on clean train rows, scored on the test split."""
    v = Views.get(spark, sf)
    _, train, _, params = _legit_train(v)
    return models.baseline_random_forest(train, _test(v, params), FEATURES, "isFraud",
                                         "RF on clean data (no decoys)", **RF)


def _train_forest(v: Views):
    """The isolation forest of the train rows: fitted once, its node table written."""
    return v.memo("if_train", lambda: materialize(
        models.fit_isolation_forest(_legit_train(v)[1], FEATURES, "tx_id", N_TREES_IF), "if_nodes"))


@query("iforest_fit")
def q_iforest_fit(spark, sf):
    """M6: isolation-forest node table (100 trees, 256-row sub-samples)."""
    return _train_forest(Views.get(spark, sf))


@query("iforest_score")
def q_iforest_score(spark, sf):
    """M7: anomaly scores of the test rows."""
    v = Views.get(spark, sf)
    return models.score_isolation_forest(scaled_test(v), _train_forest(v), FEATURES, "tx_id")


@query("contamination_cut")
def q_contamination_cut(spark, sf):
    """M8: outlier flags at the 3.5 % contamination threshold of the train scores."""
    v = Views.get(spark, sf)
    train = _legit_train(v)[1]
    s = materialize(models.score_isolation_forest(train, _train_forest(v), FEATURES, "tx_id"), "if_scores")
    return models.flag_outliers(s, models.contamination_threshold(s, 0.035))


def _injected_scores(v: Views):
    """Isolation-forest scores of the injected rows with their lookup hit: one fit and one scoring for all uses."""
    def build():
        h = lookup.is_decoy(lookup.hash_rows(v.injected, CONTENT_CENTS, v.salt), v.lookup())
        feats = materialize(prep.feature_frame(raw_ledger(h.select(F.col("pos").alias("tx_id"), *CONTENT_CENTS, "isFraud"))), "if_rows")
        forest = materialize(models.fit_isolation_forest(feats, FEATURES, "tx_id", N_TREES_IF), "if_nodes")
        s = models.score_isolation_forest(feats, forest, FEATURES, "tx_id").withColumnRenamed("tx_id", "pos")
        return materialize(h.select("pos", "hit_zone").join(s, "pos"), "if_scores")
    return v.memo("injected_scores", build)


def _inliers(v: Views, contamination: float):
    """Rows that the forest does not flag at this contamination."""
    s = _injected_scores(v)
    return s.filter(F.col("anomaly_score") <= F.lit(models.contamination_threshold(s, contamination))).select("pos", "hit_zone")


@query("inlier_select")
def q_inlier_select(spark, sf):
    """30 % of the isolation-forest inliers (contamination 5 %)."""
    return prep.sample_exact(_inliers(Views.get(spark, sf), 0.05), 0.30, key="pos", seed="mimicry", rounding="floor")


@query("mimicry_detection")
def q_mimicry_detection(spark, sf):
    """D8 for the outlier-filtering access pattern (contamination 5 % and 10 %): 30 % of the inliers."""
    v = Views.get(spark, sf)
    take = lambda n: F.floor(n * F.lit(0.30))
    five = scenarios.uniform_access(_inliers(v, 0.05), [("mimicry_5pct", take)])
    return five.unionByName(scenarios.uniform_access(_inliers(v, 0.10), [("mimicry_10pct", take)]))


@query("baseline_table")
def q_baseline_table(spark, sf):
    """M9: RF on clean rows, RF on rows with decoys, isolation forest - one row each."""
    v = Views.get(spark, sf)
    _, train, pool, params = _legit_train(v)
    test = _test(v, params)
    clean = models.baseline_random_forest(train, test, FEATURES, "isFraud", "RF on clean data (no decoys)", **RF)
    dirty = models.baseline_random_forest(_injected(v), test, FEATURES, "isFraud",
                                          "RF on injected data (with decoys)", **RF)
    iso = models.baseline_isolation_forest(train, test, FEATURES, "isFraud", "tx_id", n_trees=N_TREES_IF)
    return clean.unionByName(dirty).unionByName(iso)

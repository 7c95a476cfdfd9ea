"""Exact properties of fitted results, computed from the rows that the model
queries return, with SQL for what they must be; and reports read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from tripwire.operators import quality
from tripwire.plans.q_core import _SPLIT_SQL
from tripwire.plans.q_inject import _w
from tripwire.plans.q_io import _scratch
from tripwire.plans.q_model import N_TREES_IF
from tripwire.plans.q_quality import _LONG, _long
from tripwire.plans.registry import QUERIES, query
from tripwire.schema import FEATURES
from tripwire.sources import sinks
from tripwire.sources.fixtures import Views

REPORT = ("feature string, real_mean double, decoy_mean double, real_std double, decoy_std double, mean_ok boolean, "
          "ks_pval double, kl_div double")
_N_TRAIN = "SELECT count(*) AS n FROM split WHERE split = 'train'"
_QSTATS = """
SELECT s.feature, round(real_mean, 4) AS real_mean, round(decoy_mean, 4) AS decoy_mean,
 round(real_std, 4) AS real_std, round(decoy_std, 4) AS decoy_std,
 abs(decoy_mean - real_mean) <= 2 * real_std AS mean_ok, round(ks_pval, 4) AS ks_pval, round(kl_div, 4) AS kl_div
FROM qstats s JOIN ks ON s.feature = ks.feature JOIN kl ON s.feature = kl.feature"""


@query("report_readback", "WITH " + _LONG.strip() + _QSTATS)
def q_report_readback(spark, sf):
    """S3: the quality report written as CSV and read back with its schema."""
    path = _scratch(spark, "report_back")
    sinks.write_report_csv(quality.quality_report(_long(Views.get(spark, sf))), path)
    return spark.read.schema(REPORT).option("header", True).csv(path)


@query("summary_readback", "WITH " + _LONG.strip() + f", q AS ({_QSTATS})" + """
SELECT sum(CAST(mean_ok AS INTEGER)) AS features_within_2sd, round(avg(kl_div), 3) AS mean_kl_divergence FROM q""")
def q_summary_readback(spark, sf):
    """The one-row summary written as JSON and read back with its schema."""
    path = _scratch(spark, "summary_back")
    rep = quality.quality_report(_long(Views.get(spark, sf)))
    sinks.write_summary_json(rep.agg(F.sum(F.col("mean_ok").cast("int")).alias("features_within_2sd"),
                                     F.round(F.avg("kl_div"), 3).alias("mean_kl_divergence")), path)
    return spark.read.schema("features_within_2sd bigint, mean_kl_divergence double").json(path)


@query("iforest_shape", "WITH " + _SPLIT_SQL.strip() + f", n AS ({_N_TRAIN})" + f"""
SELECT CAST({N_TREES_IF} AS BIGINT) AS n_trees, least(256, n) AS root_min, least(256, n) AS root_max,
 CAST({N_TREES_IF} * least(256, n) AS BIGINT) AS leaf_rows FROM n""")
def q_iforest_shape(spark, sf):
    """M6: every tree has a root of min(256, n) rows, and its leaves hold them all."""
    t = QUERIES["iforest_fit"](spark, sf)
    root, leaf = F.when(F.col("node") == 0, F.col("size")), F.when(F.col("feature") < 0, F.col("size"))
    return t.agg(F.count(root).alias("n_trees"), F.min(root).alias("root_min"), F.max(root).alias("root_max"), F.sum(leaf).alias("leaf_rows"))


@query("iforest_range", "WITH " + _SPLIT_SQL.strip() + """
SELECT count(*) AS n_rows, true AS distinct_keys, true AS in_range FROM split WHERE split = 'test'""")
def q_iforest_range(spark, sf):
    """M7: one score per test row, strictly between 0 and 1."""
    s = QUERIES["iforest_score"](spark, sf)
    return s.agg(F.count("*").alias("n_rows"), (F.count_distinct("tx_id") == F.count("*")).alias("distinct_keys"),
                 ((F.min("anomaly_score") > 0) & (F.max("anomaly_score") < 1)).alias("in_range"))


@query("contamination_share", "WITH " + _SPLIT_SQL.strip() + """
SELECT count(*) AS n_rows, true AS share_ok FROM split WHERE split = 'train'""")
def q_contamination_share(spark, sf):
    """M8: some, but at most 3.5 % of the train rows (and one, by interpolation) are over the cut; tied scores may leave fewer."""
    f = QUERIES["contamination_cut"](spark, sf)
    over = F.sum(F.col("is_outlier").cast("int"))
    return f.agg(F.count("*").alias("n_rows"), ((over <= 0.035 * F.count("*") + 1) & (over > 0)).alias("share_ok"))


@query("gmm_shape", "SELECT CAST(5 AS BIGINT) AS n_components, 1.0 AS weights, true AS mean_is_zero")
def q_gmm_shape(spark, sf):
    """Five weights that sum to 1; the weighted mean is that of the centred latent rows, zero."""
    g = QUERIES["gmm_fit"](spark, sf)
    dims = g.select("weight", F.posexplode("mean").alias("d", "m")).groupBy("d").agg(F.sum(F.col("weight") * F.col("m")).alias("m"))
    off = dims.agg(F.max(F.abs("m")).alias("off"))
    return g.agg(F.count("*").alias("n_components"), F.round(F.sum("weight"), 6).alias("weights")).crossJoin(off) \
        .select("n_components", "weights", (F.col("off") < 1e-3).alias("mean_is_zero"))


@query("pca_shape", "WITH " + _SPLIT_SQL.strip() + """
SELECT count(*) AS n_rows, true AS centred, true AS uncorrelated FROM split WHERE split = 'train' AND isFraud = 0""")
def q_pca_shape(spark, sf):
    """G1: a latent row per legitimate train row; components have mean zero and no correlation."""
    z = QUERIES["pca_latent"](spark, sf)
    dims = [c for c in z.columns if c != "tx_id"]
    pairs = [F.abs(F.covar_pop(a, b)) for i, a in enumerate(dims) for b in dims[:i]]
    return z.agg(F.count("*").alias("n_rows"), (F.greatest(*[F.abs(F.avg(c)) for c in dims]) < 1e-6).alias("centred"),
                 (F.greatest(*pairs) < 1e-6).alias("uncorrelated"))


_POOL = "WITH " + _SPLIT_SQL.strip() + """
SELECT CAST(greatest(500, floor(count(*) * CAST(0.10 AS DOUBLE))) AS BIGINT) AS n_decoys, true AS distinct_keys, true AS complete
FROM split WHERE split = 'train'"""


def _decoy_shape(d):
    missing = sum((F.sum(F.when(F.col(c).isNull() | F.isnan(c), 1).otherwise(0)) for c in FEATURES), F.lit(0))
    key = d.columns[0]
    return d.agg(F.count("*").alias("n_decoys"), (F.count_distinct(key) == F.count("*")).alias("distinct_keys"), (missing == 0).alias("complete"))


@query("gmm_decoys_shape", _POOL)
def q_gmm_decoys_shape(spark, sf):
    """Exactly the wanted number of complete decoys after the cut and the top-up."""
    return _decoy_shape(QUERIES["gmm_decoys"](spark, sf))


@query("latent_decoys_shape", _POOL)
def q_latent_decoys_shape(spark, sf):
    """Exactly the wanted number of complete decoys."""
    return _decoy_shape(QUERIES["latent_decoys"](spark, sf))


@query("inject_shape", _w("""SELECT zone, quota AS n_rows, quota AS n_positions FROM quota
 UNION ALL SELECT '(all)', (SELECT count(*) FROM ztr) + sum(quota), (SELECT count(*) FROM ztr) + sum(quota) FROM quota"""))
def q_inject_shape(spark, sf):
    """Each zone has its quota of decoys, and every row a position of its own."""
    rows = QUERIES["inject"](spark, sf)
    per = rows.select(F.explode(F.array_compact(F.array(F.lit("(all)"), F.when(F.col("is_decoy"), F.col("zone"))))).alias("zone"), "pos")
    return per.groupBy("zone").agg(F.count("*").alias("n_rows"), F.count_distinct("pos").alias("n_positions"))


@query("zone_edge_shape", _w("SELECT quota AS n_rows, quota AS n_keys FROM quota WHERE zone = 'edge_case'"))
def q_zone_edge_shape(spark, sf):
    """I4: the quota of different pool decoys."""
    return QUERIES["zone_edge"](spark, sf).agg(F.count("*").alias("n_rows"), F.count_distinct("tx_id").alias("n_keys"))


@query("zone_cluster_shape", _w("SELECT quota AS n_rows, quota AS n_keys FROM quota WHERE zone = 'cluster'"))
def q_zone_cluster_shape(spark, sf):
    """The quota of different pool decoys."""
    return QUERIES["zone_cluster"](spark, sf).agg(F.count("*").alias("n_rows"), F.count_distinct("tx_id").alias("n_keys"))

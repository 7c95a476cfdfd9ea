"""Registered queries: ranking metrics on the score table, decoy quality
statistics (real legitimate ledger rows vs the decoy pool)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tripwire.functions.buckets import sig_round, sig_round_sql as S
from tripwire.operators import metrics, prep, quality
from tripwire.plans.registry import query
from tripwire.sources.fixtures import Views

THRESHOLD = 800     # decision threshold on the fixture score


def _preds(v: Views):
    return v.scores.withColumn("pred", (F.col("score") >= THRESHOLD).cast("int"))


def _long(v: Views):
    real = prep.feature_frame(v.raw.filter(F.col("isFraud") == 0))
    decoy = prep.feature_frame(v.pool_raw)
    return quality.stack(real, decoy)


def _sig(df, cols):
    return df.withColumns({c: sig_round(F.col(c)) for c in cols})


_SC = """
sc AS (SELECT CAST(score AS DOUBLE) AS score, sum(CASE WHEN label = 1 THEN 1 ELSE 0 END) AS n_pos,
  sum(CASE WHEN label = 1 THEN 0 ELSE 1 END) AS n_neg FROM scores GROUP BY score),
cf AS (SELECT score, n_pos, n_neg,
  coalesce(sum(n_neg) OVER (ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS neg_before,
  coalesce(sum(n_pos) OVER (ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS pos_before
 FROM sc)"""


@query("auc_roc", "WITH " + _SC.strip() + """
SELECT CAST(sum(n_pos) AS BIGINT) AS n_pos, CAST(sum(n_neg) AS BIGINT) AS n_neg,
 """ + S("CAST(sum(n_pos * (neg_before + 0.5 * n_neg)) AS DOUBLE) / (sum(n_pos) * sum(n_neg))") + """ AS auc_roc FROM cf""")
def q_auc_roc(spark, sf):
    """M3: exact ROC-AUC with tied scores."""
    return _sig(metrics.auc_roc(Views.get(spark, sf).scores), ["auc_roc"])


@query("average_precision", "WITH " + _SC.strip() + """,
t AS (SELECT sum(n_pos) AS p, sum(n_pos + n_neg) AS n FROM sc)
SELECT """ + S("sum(n_pos * (t.p - pos_before) / (t.n - pos_before - neg_before)) / max(t.p)") + """ AS average_precision
FROM cf, t""")
def q_average_precision(spark, sf):
    """M4: step-wise average precision over distinct thresholds."""
    return _sig(metrics.average_precision(Views.get(spark, sf).scores), ["average_precision"])


_CONF = f"""
cm AS (SELECT CAST(sum(CASE WHEN score >= {THRESHOLD} AND label = 1 THEN 1 ELSE 0 END) AS BIGINT) AS tp,
  CAST(sum(CASE WHEN score >= {THRESHOLD} AND label <> 1 THEN 1 ELSE 0 END) AS BIGINT) AS fp,
  CAST(sum(CASE WHEN score < {THRESHOLD} AND label = 1 THEN 1 ELSE 0 END) AS BIGINT) AS fn,
  CAST(sum(CASE WHEN score < {THRESHOLD} AND label <> 1 THEN 1 ELSE 0 END) AS BIGINT) AS tn FROM scores),
pr AS (SELECT *, CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0.0 END AS p1,
  CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0.0 END AS r1,
  CASE WHEN tn + fn > 0 THEN tn / (tn + fn) ELSE 0.0 END AS p0,
  CASE WHEN tn + fp > 0 THEN tn / (tn + fp) ELSE 0.0 END AS r0 FROM cm),
f AS (SELECT *, CASE WHEN p1 + r1 > 0 THEN 2 * p1 * r1 / (p1 + r1) ELSE 0.0 END AS f1_1,
  CASE WHEN p0 + r0 > 0 THEN 2 * p0 * r0 / (p0 + r0) ELSE 0.0 END AS f1_0, tp + fp + fn + tn AS n FROM pr)"""


@query("binary_metrics", "WITH " + _CONF.strip() + f"""
SELECT tp, fp, fn, tn, {S('p1')} AS precision, {S('r1')} AS recall, {S('f1_1')} AS f1 FROM f""")
def q_binary_metrics(spark, sf):
    """M5: precision / recall / F1 of the positive class (zero division -> 0)."""
    return _sig(metrics.binary_metrics(_preds(Views.get(spark, sf))), ["precision", "recall", "f1"])


@query("weighted_metrics", "WITH " + _CONF.strip() + f"""
SELECT {S('(tp + tn) / n')} AS accuracy, {S('(p1 * (tp + fn) + p0 * (tn + fp)) / n')} AS precision,
 {S('(r1 * (tp + fn) + r0 * (tn + fp)) / n')} AS recall, {S('(f1_1 * (tp + fn) + f1_0 * (tn + fp)) / n')} AS f1 FROM f""")
def q_weighted_metrics(spark, sf):
    """Q3: accuracy and support-weighted precision / recall / F1."""
    return _sig(metrics.weighted_metrics(_preds(Views.get(spark, sf))), ["accuracy", "precision", "recall", "f1"])


@query("class_weights", f"""
SELECT label, CAST(count(*) AS BIGINT) AS n_c,
 {S('(SELECT count(*) FROM scores) / (2.0 * count(*))')} AS weight FROM scores GROUP BY label""")
def q_class_weights(spark, sf):
    """M1: balanced class weights n / (k * n_c)."""
    return _sig(metrics.class_weights(Views.get(spark, sf).scores), ["weight"])


_FEATS = ("step, amount, oldbalanceOrg, newbalanceOrig, oldbalanceDest, newbalanceDest, orig_balance_diff, "
          "dest_balance_diff, amount_to_orig_ratio, amount_to_dest_ratio, orig_zeroed, is_risky_type, "
          "type_CASH_IN, type_CASH_OUT, type_DEBIT, type_PAYMENT, type_TRANSFER")

_LONG = f"""
qreal AS (SELECT {_FEATS} FROM features WHERE isFraud = 0),
qdec AS (SELECT {_FEATS} FROM pool_features),
qlong AS (
 SELECT 'real' AS src, feature, value FROM (UNPIVOT qreal ON {_FEATS} INTO NAME feature VALUE value)
 UNION ALL
 SELECT 'decoy' AS src, feature, value FROM (UNPIVOT qdec ON {_FEATS} INTO NAME feature VALUE value)),
qstats AS (SELECT feature,
  CAST(count(CASE WHEN src = 'real' THEN value END) AS BIGINT) AS n_real,
  avg(CASE WHEN src = 'real' THEN value END) AS real_mean, stddev_pop(CASE WHEN src = 'real' THEN value END) AS real_std,
  CAST(count(CASE WHEN src = 'decoy' THEN value END) AS BIGINT) AS n_decoy,
  avg(CASE WHEN src = 'decoy' THEN value END) AS decoy_mean, stddev_pop(CASE WHEN src = 'decoy' THEN value END) AS decoy_std
 FROM qlong GROUP BY feature),
ks_counts AS (SELECT feature, value, sum(CASE WHEN src = 'real' THEN 1 ELSE 0 END) AS n_r,
  sum(CASE WHEN src = 'decoy' THEN 1 ELSE 0 END) AS n_d FROM qlong GROUP BY feature, value),
ks_cdf AS (SELECT feature, value, sum(n_r) OVER (PARTITION BY feature) AS nr_t, sum(n_d) OVER (PARTITION BY feature) AS nd_t,
  sum(n_r) OVER (PARTITION BY feature ORDER BY value) / sum(n_r) OVER (PARTITION BY feature) AS fr,
  sum(n_d) OVER (PARTITION BY feature ORDER BY value) / sum(n_d) OVER (PARTITION BY feature) AS fd FROM ks_counts),
ks_d AS (SELECT feature, max(abs(fr - fd)) AS d, sqrt(max(nr_t) * max(nd_t) / (max(nr_t) + max(nd_t))) AS en
 FROM ks_cdf GROUP BY feature),
ks_l AS (SELECT feature, d, (en + 0.12 + 0.11 / en) * d AS lam FROM ks_d),
ks AS (SELECT feature, d AS ks_stat, least(greatest(CASE WHEN lam <= 0 THEN 1.0
  WHEN lam < 1.18 THEN 1.0 - 2.5066282746310002 / lam * list_sum(list_transform(range(1, 6),
   lambda j: exp(-(2.0 * j - 1) * (2.0 * j - 1) * 9.869604401089358 / (8.0 * lam * lam))))
  ELSE list_sum(list_transform(range(1, 101),
   lambda j: (CASE WHEN j % 2 = 1 THEN 2.0 ELSE -2.0 END) * exp(-2.0 * j * j * lam * lam))) END,
   0.0), 1.0) AS ks_pval FROM ks_l),
kl_mm AS (SELECT feature, min(value) AS lo, max(value) AS hi,
  count(CASE WHEN src = 'real' THEN 1 END) AS nr, count(CASE WHEN src = 'decoy' THEN 1 END) AS nd FROM qlong GROUP BY feature),
kl_bins AS (SELECT l.feature, least(floor((l.value - m.lo) / ((m.hi - m.lo) / 49.0)), 48) AS bin, m.nr, m.nd,
  (m.hi - m.lo) / 49.0 AS w, sum(CASE WHEN src = 'real' THEN 1 ELSE 0 END) AS cr,
  sum(CASE WHEN src = 'decoy' THEN 1 ELSE 0 END) AS cd
 FROM qlong l JOIN kl_mm m ON l.feature = m.feature WHERE m.hi > m.lo GROUP BY ALL),
kl AS (SELECT m.feature, sum((cr / (b.nr * w) + 1e-10) * ln((cr / (b.nr * w) + 1e-10) / (cd / (b.nd * w) + 1e-10))) AS kl_div
 FROM kl_mm m LEFT JOIN kl_bins b ON m.feature = b.feature GROUP BY m.feature)"""


@query("feature_stats", "WITH " + _LONG.strip() + f"""
SELECT feature, n_real, {S('real_mean')} AS real_mean, {S('real_std')} AS real_std, n_decoy,
 {S('decoy_mean')} AS decoy_mean, {S('decoy_std')} AS decoy_std FROM qstats""")
def q_feature_stats(spark, sf):
    """Q4: per-feature mean / population std, real vs decoy."""
    st = quality.feature_stats(_long(Views.get(spark, sf)))
    return _sig(st, ["real_mean", "real_std", "decoy_mean", "decoy_std"])


@query("mean_within_2sd", "WITH " + _LONG.strip() + """
SELECT feature, abs(decoy_mean - real_mean) <= 2 * real_std AS mean_ok FROM qstats""")
def q_mean_within_2sd(spark, sf):
    """Q5: decoy mean within two real standard deviations."""
    return quality.mean_within_2sd(quality.feature_stats(_long(Views.get(spark, sf)))).select("feature", "mean_ok")


@query("ks_stat", "WITH " + _LONG.strip() + f"""
SELECT feature, {S('ks_stat')} AS ks_stat, {S('ks_pval')} AS ks_pval FROM ks""")
def q_ks_stat(spark, sf):
    """Q6: two-sample KS statistic and asymptotic p-value per feature."""
    return _sig(quality.ks_test(_long(Views.get(spark, sf))), ["ks_stat", "ks_pval"])


@query("kl_div", "WITH " + _LONG.strip() + f"""
SELECT feature, {S('kl_div')} AS kl_div FROM kl""")
def q_kl_div(spark, sf):
    """Q7: histogram KL divergence (49 density bins) per feature."""
    return _sig(quality.kl_divergence(_long(Views.get(spark, sf))), ["kl_div"])


@query("quality_report", "WITH " + _LONG.strip() + """
SELECT s.feature, round(real_mean, 4) AS real_mean, round(decoy_mean, 4) AS decoy_mean,
 round(real_std, 4) AS real_std, round(decoy_std, 4) AS decoy_std,
 abs(decoy_mean - real_mean) <= 2 * real_std AS mean_ok, round(ks_pval, 4) AS ks_pval, round(kl_div, 4) AS kl_div
FROM qstats s JOIN ks ON s.feature = ks.feature JOIN kl ON s.feature = kl.feature""")
def q_quality_report(spark, sf):
    """Q8: the per-feature quality table, rounded to 4 places."""
    return quality.quality_report(_long(Views.get(spark, sf)))


@query("balanced_union", """
SELECT tx_id, source FROM (
 SELECT tx_id, 0 AS source, row_number() OVER (ORDER BY md5(concat(CAST(tx_id AS VARCHAR), ':42')), tx_id) AS rn
 FROM ledger WHERE isFraud = 0
 UNION ALL
 SELECT tx_id, 1 AS source, row_number() OVER (ORDER BY md5(concat(CAST(tx_id AS VARCHAR), ':42')), tx_id) AS rn
 FROM pool) u
WHERE rn <= (SELECT least((SELECT count(*) FROM ledger WHERE isFraud = 0), (SELECT count(*) FROM pool)))""")
def q_balanced_union(spark, sf):
    """Q1: equal-size real/decoy union for the discriminator."""
    v = Views.get(spark, sf)
    real = v.ledger.filter(F.col("isFraud") == 0).select("tx_id")
    return quality.balanced_union(real, v.pool_zoned.select("tx_id"), "tx_id").select("tx_id", "source")

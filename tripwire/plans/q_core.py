"""Registered queries: sources, preparation, lookup and access detection."""

from __future__ import annotations

from pyspark.sql import functions as F

from tripwire.operators import detect, lookup, prep
from tripwire.plans.registry import query
from tripwire.schema import CONTENT_CENTS
from tripwire.sources.fixtures import Views
from tripwire.functions.hashing import encode_row

_SPLIT_SQL = """
split AS (
 SELECT tx_id, isFraud, CASE WHEN rn <= n_test THEN 'test' WHEN rn <= n_test + n_val THEN 'val' ELSE 'train' END AS split
 FROM (SELECT tx_id, isFraud, rn, n_test, floor((tot - n_test) * CAST(0.125 AS DOUBLE) + 0.5) AS n_val
  FROM (SELECT tx_id, isFraud,
     row_number() OVER (PARTITION BY isFraud ORDER BY md5(concat(CAST(tx_id AS VARCHAR), ':42')), tx_id) AS rn,
     count(*) OVER (PARTITION BY isFraud) AS tot,
     floor(count(*) OVER (PARTITION BY isFraud) * CAST(0.2 AS DOUBLE) + 0.5) AS n_test
   FROM ledger) a) b)"""


def _split(v: Views):
    return prep.stratified_split(v.ledger.select("tx_id", "isFraud"))


def _hits(v: Views):
    return detect.access_hits(v.access, v.injected, v.lookup(), v.salt)


# ---- sources -----------------------------------------------------------------

@query("fraud_rate", """
SELECT CAST(count(*) AS BIGINT) AS n_rows, CAST(sum(isFraud) AS BIGINT) AS n_fraud,
       round(avg(CAST(isFraud AS DOUBLE)), 9) AS fraud_rate FROM raw_ledger""")
def q_fraud_rate(spark, sf):
    """Shape and overall fraud rate of the scanned ledger."""
    raw = Views.get(spark, sf).raw
    return raw.agg(F.count(F.lit(1)).cast("bigint").alias("n_rows"),
                   F.sum("isFraud").cast("bigint").alias("n_fraud"),
                   F.round(F.avg(F.col("isFraud").cast("double")), 9).alias("fraud_rate"))


# ---- preparation -------------------------------------------------------------

@query("drop_ids", "SELECT * EXCLUDE (nameOrig, nameDest, isFlaggedFraud) FROM raw_ledger")
def q_drop_ids(spark, sf):
    """P1."""
    return prep.drop_ids(Views.get(spark, sf).raw)


@query("features_balance", "SELECT tx_id, orig_balance_diff, dest_balance_diff FROM features")
def q_features_balance(spark, sf):
    """P2, P3."""
    return prep.engineer_features(Views.get(spark, sf).raw).select("tx_id", "orig_balance_diff", "dest_balance_diff")


@query("features_ratio", "SELECT tx_id, amount_to_orig_ratio, amount_to_dest_ratio FROM features")
def q_features_ratio(spark, sf):
    """P4 (a zero balance gives amount * 1e9, not NULL)."""
    return prep.engineer_features(Views.get(spark, sf).raw).select("tx_id", "amount_to_orig_ratio", "amount_to_dest_ratio")


@query("features_flags", """
SELECT tx_id, CAST(orig_zeroed AS INTEGER) AS orig_zeroed, CAST(is_risky_type AS INTEGER) AS is_risky_type
FROM features""")
def q_features_flags(spark, sf):
    """P5, P6 (risky flag on the raw type text)."""
    return prep.engineer_features(Views.get(spark, sf).raw).select("tx_id", "orig_zeroed", "is_risky_type")


@query("type_normalize", "SELECT tx_id, replace(type, '-', '_') AS type FROM raw_ledger")
def q_type_normalize(spark, sf):
    """P7."""
    return prep.normalize_type(Views.get(spark, sf).raw).select("tx_id", "type")


@query("one_hot_type", """
SELECT tx_id, CAST(type_CASH_IN AS INTEGER) AS type_CASH_IN, CAST(type_CASH_OUT AS INTEGER) AS type_CASH_OUT,
 CAST(type_DEBIT AS INTEGER) AS type_DEBIT, CAST(type_PAYMENT AS INTEGER) AS type_PAYMENT,
 CAST(type_TRANSFER AS INTEGER) AS type_TRANSFER FROM features""")
def q_one_hot_type(spark, sf):
    """P8, P9."""
    df = prep.one_hot_type(prep.normalize_type(Views.get(spark, sf).raw))
    return df.select("tx_id", *[c for c in df.columns if c.startswith("type_")])


@query("feature_matrix", "SELECT * FROM features")
def q_feature_matrix(spark, sf):
    """The 17-feature matrix with key and label."""
    return prep.feature_frame(Views.get(spark, sf).raw)


@query("legit_only", "SELECT * FROM raw_ledger WHERE isFraud = 0")
def q_legit_only(spark, sf):
    """P12."""
    return prep.legit_only(Views.get(spark, sf).raw)


@query("sample_exact", """
SELECT tx_id, isFraud FROM (
 SELECT tx_id, isFraud, row_number() OVER (ORDER BY md5(concat(CAST(tx_id AS VARCHAR), ':42')), tx_id) AS rn,
  count(*) OVER () AS n FROM ledger) q
WHERE rn <= floor(n * CAST(0.3 AS DOUBLE) + 0.5)""")
def q_sample_exact(spark, sf):
    """Exact-size seeded sample (round(0.3 n) rows)."""
    return prep.sample_exact(Views.get(spark, sf).ledger.select("tx_id", "isFraud"), 0.3)


@query("high_value_rows", """
SELECT tx_id, amount FROM features WHERE amount >= (SELECT quantile_cont(amount, 0.8) FROM features)""")
def q_high_value_rows(spark, sf):
    """Amount >= 80th percentile (linear interpolation), ties kept."""
    fx = prep.feature_frame(Views.get(spark, sf).raw).select("tx_id", "amount")
    return prep.high_value_rows(fx, "amount", 20.0)


@query("stratified_split", "WITH " + _SPLIT_SQL.strip() + "\nSELECT tx_id, isFraud, split FROM split")
def q_stratified_split(spark, sf):
    """70/10/20 per-label exact allocation."""
    return _split(Views.get(spark, sf))


@query("train_unscaled", "WITH " + _SPLIT_SQL.strip() + """
SELECT f.* FROM features f WHERE f.tx_id IN (SELECT tx_id FROM split WHERE split = 'train')""")
def q_train_unscaled(spark, sf):
    """Unscaled training rows (17 features, key, label) before N2."""
    v = Views.get(spark, sf)
    return prep.unscaled_train(prep.stratified_split(prep.feature_frame(v.raw)))


@query("split_stats", "WITH " + _SPLIT_SQL.strip() + """
SELECT split, CAST(count(*) AS BIGINT) AS n_rows, CAST(sum(isFraud) AS BIGINT) AS n_pos,
 round(avg(CAST(isFraud AS DOUBLE)), 9) AS pos_rate FROM split GROUP BY split""")
def q_split_stats(spark, sf):
    """N3."""
    return prep.split_stats(_split(Views.get(spark, sf))).withColumn("pos_rate", F.round("pos_rate", 9))


@query("class_distribution", "WITH " + _SPLIT_SQL.strip() + """
SELECT split, CAST(count(*) AS BIGINT) AS n, CAST(sum(CASE WHEN isFraud = 0 THEN 1 ELSE 0 END) AS BIGINT) AS n_legit,
 CAST(sum(CASE WHEN isFraud = 1 THEN 1 ELSE 0 END) AS BIGINT) AS n_fraud,
 round(sum(CASE WHEN isFraud = 1 THEN 1.0 ELSE 0.0 END) * 100.0 / count(*), 6) AS fraud_pct
FROM split GROUP BY split""")
def q_class_distribution(spark, sf):
    """N4 per split."""
    return (prep.class_distribution(_split(Views.get(spark, sf)), by=["split"])
            .withColumn("fraud_pct", F.round("fraud_pct", 6)))


@query("pool_size", "WITH " + _SPLIT_SQL.strip() + """
SELECT CAST(count(*) AS BIGINT) AS n_train,
 CAST(greatest(500, floor(count(*) * CAST(0.10 AS DOUBLE))) AS BIGINT) AS n_decoys
FROM split WHERE split = 'train'""")
def q_pool_size(spark, sf):
    """Decoy count = max(500, int(0.10 * n_train))."""
    train = _split(Views.get(spark, sf)).filter(F.col("split") == "train")
    n = F.count(F.lit(1))
    return train.agg(n.cast("bigint").alias("n_train"), prep.pool_size(n).alias("n_decoys"))


# ---- lookup ------------------------------------------------------------------

@query("row_encode", """
SELECT tx_id, concat_ws(',', CAST(step AS VARCHAR), type, CAST(amount_c AS VARCHAR),
 CAST(oldbalanceOrg_c AS VARCHAR), CAST(newbalanceOrig_c AS VARCHAR), CAST(oldbalanceDest_c AS VARCHAR),
 CAST(newbalanceDest_c AS VARCHAR)) AS encoded FROM pool""")
def q_row_encode(spark, sf):
    """Canonical row encoding."""
    return Views.get(spark, sf).pool.select("tx_id", encode_row(CONTENT_CENTS).alias("encoded"))


_FIX6 = ["step", "amount", "oldbalanceOrg", "newbalanceOrig", "oldbalanceDest", "newbalanceDest"]


@query("row_hash_fixed6", "SELECT tx_id, sha256(concat(concat_ws(',', "
       + ", ".join(f"printf('%.6f', CAST({c} AS DOUBLE))" for c in _FIX6) + "), 'pepper')) AS row_hash FROM pool_raw")
def q_row_hash_fixed6(spark, sf):
    """J1/J2 with the reference's float encoding: every value as %.6f."""
    from tripwire.operators.prep import drop_ids
    v = Views.get(spark, sf)
    return lookup.hash_rows(drop_ids(v.pool_raw), _FIX6, v.salt, fixed6=True).select("tx_id", "row_hash")


@query("row_hash", "SELECT tx_id, row_hash FROM pool_zoned")
def q_row_hash(spark, sf):
    """Salted SHA-256 of each decoy row."""
    return Views.get(spark, sf).pool_zoned.select("tx_id", "row_hash")


@query("lookup_register", "SELECT row_hash, zone FROM lookup")
def q_lookup_register(spark, sf):
    """Hash -> zone, last registration wins."""
    return Views.get(spark, sf).lookup()


@query("lookup_summary", """
SELECT r.zone, r.n_registered, CAST(coalesce(h.n_hashes, 0) AS BIGINT) AS n_hashes
FROM (SELECT zone, CAST(count(*) AS BIGINT) AS n_registered FROM pool_zoned GROUP BY zone) r
LEFT JOIN (SELECT zone, CAST(count(*) AS BIGINT) AS n_hashes FROM lookup GROUP BY zone) h ON r.zone = h.zone""")
def q_lookup_summary(spark, sf):
    """J7."""
    return lookup.lookup_summary(Views.get(spark, sf).pool_zoned)


@query("is_decoy", """
SELECT i.pos, k.zone IS NOT NULL AS found, k.zone AS hit_zone
FROM injected i LEFT JOIN lookup k ON k.row_hash = sha256(concat(concat_ws(',', CAST(i.step AS VARCHAR), i.type,
   CAST(i.amount_c AS VARCHAR), CAST(i.oldbalanceOrg_c AS VARCHAR), CAST(i.newbalanceOrig_c AS VARCHAR),
   CAST(i.oldbalanceDest_c AS VARCHAR), CAST(i.newbalanceDest_c AS VARCHAR)), 'pepper'))""")
def q_is_decoy(spark, sf):
    """Membership of every injected row."""
    v = Views.get(spark, sf)
    rows = lookup.hash_rows(v.injected.select("pos", *CONTENT_CENTS), CONTENT_CENTS, v.salt)
    return (lookup.is_decoy(rows, v.lookup())
            .select("pos", F.col("hit_zone").isNotNull().alias("found"), "hit_zone"))


@query("false_hits", """
SELECT CAST(sum(CASE WHEN k.row_hash IS NOT NULL THEN 1 ELSE 0 END) AS BIGINT) AS n_false_hits,
       CAST(sum(CASE WHEN k.row_hash IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS n_clean
FROM ledger l LEFT JOIN lookup k ON k.row_hash = sha256(concat(concat_ws(',', CAST(l.step AS VARCHAR), l.type,
   CAST(l.amount_c AS VARCHAR), CAST(l.oldbalanceOrg_c AS VARCHAR), CAST(l.newbalanceOrig_c AS VARCHAR),
   CAST(l.oldbalanceDest_c AS VARCHAR), CAST(l.newbalanceDest_c AS VARCHAR)), 'pepper'))""")
def q_false_hits(spark, sf):
    """Real ledger rows matching a decoy hash, and the clean rest, in one
    probe of the lookup (``lookup.false_hits`` / ``clean_rows`` are the
    semi/anti-join forms)."""
    v = Views.get(spark, sf)
    rows = lookup.hash_rows(v.ledger.select(*CONTENT_CENTS), CONTENT_CENTS, v.salt)
    hit = F.col("hit_zone").isNotNull()
    return lookup.is_decoy(rows, v.lookup()).agg(
        F.sum(F.when(hit, 1).otherwise(0)).cast("bigint").alias("n_false_hits"),
        F.sum(F.when(hit, 0).otherwise(1)).cast("bigint").alias("n_clean"))


# ---- detection over the access log --------------------------------------------

@query("first_alarm", """
SELECT actor, CAST(count(*) AS BIGINT) AS n_rows, CAST(count(hit_zone) AS BIGINT) AS n_decoys,
 min(CASE WHEN hit_zone IS NOT NULL THEN batch END) AS first_alarm_batch,
 CAST(count(DISTINCT batch) AS BIGINT) AS n_batches,
 round(CAST(count(hit_zone) AS DOUBLE) / count(*), 9) AS decoy_ratio
FROM hits GROUP BY actor""")
def q_first_alarm(spark, sf):
    """D3+D4 (flagship): per actor, rows read, decoys hit, first alarming day."""
    return detect.first_alarm(_hits(Views.get(spark, sf)))


_ZJSON = """coalesce('{' || string_agg(CASE WHEN hit_zone IS NOT NULL THEN '"' || hit_zone || '":' || CAST(n AS VARCHAR) END,
  ',' ORDER BY hit_zone) || '}', '{}')"""


@query("batch_check", """
SELECT actor, batch, CAST(sum(n) AS BIGINT) AS n_rows,
 CAST(sum(CASE WHEN hit_zone IS NOT NULL THEN n ELSE 0 END) AS BIGINT) AS n_decoys,
 sum(CASE WHEN hit_zone IS NOT NULL THEN n ELSE 0 END) > 0 AS alarm,
 round(CAST(sum(CASE WHEN hit_zone IS NOT NULL THEN n ELSE 0 END) AS DOUBLE) / sum(n), 9) AS decoy_ratio,
 """ + _ZJSON + """ AS zones_hit
FROM (SELECT actor, batch, hit_zone, count(*) AS n FROM hits GROUP BY actor, batch, hit_zone) z
GROUP BY actor, batch""")
def q_batch_check(spark, sf):
    """Alarm, hits, zone map and ratio for every (actor, day) batch."""
    return detect.batch_report(_hits(Views.get(spark, sf)), ["actor", "batch"])


@query("zone_totals", """
SELECT hit_zone AS zone, CAST(count(*) AS BIGINT) AS n_hits FROM hits WHERE hit_zone IS NOT NULL GROUP BY hit_zone""")
def q_zone_totals(spark, sf):
    """Hits per zone over all accesses."""
    return detect.zone_totals(_hits(Views.get(spark, sf)))


@query("actor_profile", """
SELECT actor,
 arg_max(zone, n_hits * 10 - CASE zone WHEN 'random' THEN 0 WHEN 'edge_case' THEN 1 WHEN 'cluster' THEN 2 WHEN 'high_value' THEN 3 ELSE 4 END) AS dominant_zone,
 CAST(max(n_hits) AS BIGINT) AS dominant_hits, CAST(sum(n_hits) AS BIGINT) AS n_hits,
 CAST(count(*) AS BIGINT) AS n_zones, round(CAST(max(n_hits) AS DOUBLE) / sum(n_hits), 9) AS dominant_share
FROM (SELECT actor, hit_zone AS zone, count(*) AS n_hits FROM hits WHERE hit_zone IS NOT NULL GROUP BY actor, hit_zone) z
GROUP BY actor""")
def q_actor_profile(spark, sf):
    """Dominant zone per actor (tie -> earliest zone)."""
    return detect.actor_profile(_hits(Views.get(spark, sf)))


@query("lookup_recall", """
SELECT actor, CAST(sum(CASE WHEN is_decoy THEN 1 ELSE 0 END) AS BIGINT) AS n_true_decoys,
 CAST(count(hit_zone) AS BIGINT) AS n_hits,
 CASE WHEN sum(CASE WHEN is_decoy THEN 1 ELSE 0 END) > 0
   THEN round(CAST(count(hit_zone) AS DOUBLE) / sum(CASE WHEN is_decoy THEN 1 ELSE 0 END), 9) END AS recall
FROM hits GROUP BY actor""")
def q_lookup_recall(spark, sf):
    """Lookup hits vs ground-truth decoys per actor."""
    return detect.lookup_recall(_hits(Views.get(spark, sf)))


_INCR_SQL = """
incr AS (
 SELECT pos, CAST(floor((rn - 1) / 100) + 1 AS INTEGER) AS batch FROM (
  SELECT pos, row_number() OVER (ORDER BY md5(concat(CAST(pos AS VARCHAR), ':7')), pos) AS rn,
   count(*) OVER () AS n FROM injected) q
 WHERE rn <= least(20, floor(n / 100)) * 100)"""


@query("incremental_batches", "WITH " + _INCR_SQL.strip() + "\nSELECT pos, batch FROM incr")
def q_incremental_batches(spark, sf):
    """20 non-overlapping batches of 100 rows from one seeded permutation."""
    inj = Views.get(spark, sf).injected.select("pos")
    return detect.incremental_batches(inj, "pos", 7, 20, 100)


@query("incremental_check", "WITH " + _INCR_SQL.strip() + """,
hz AS (SELECT c.batch, k.zone AS hit_zone FROM incr c JOIN injected i ON c.pos = i.pos
  LEFT JOIN lookup k ON k.row_hash = sha256(concat(concat_ws(',', CAST(i.step AS VARCHAR), i.type,
   CAST(i.amount_c AS VARCHAR), CAST(i.oldbalanceOrg_c AS VARCHAR), CAST(i.newbalanceOrig_c AS VARCHAR),
   CAST(i.oldbalanceDest_c AS VARCHAR), CAST(i.newbalanceDest_c AS VARCHAR)), 'pepper')))
SELECT batch, CAST(sum(n) AS BIGINT) AS n_rows,
 CAST(sum(CASE WHEN hit_zone IS NOT NULL THEN n ELSE 0 END) AS BIGINT) AS n_decoys,
 sum(CASE WHEN hit_zone IS NOT NULL THEN n ELSE 0 END) > 0 AS alarm,
 round(CAST(sum(CASE WHEN hit_zone IS NOT NULL THEN n ELSE 0 END) AS DOUBLE) / sum(n), 9) AS decoy_ratio,
 """ + _ZJSON + """ AS zones_hit
FROM (SELECT batch, hit_zone, count(*) AS n FROM hz GROUP BY batch, hit_zone) z GROUP BY batch""")
def q_incremental_check(spark, sf):
    """Per-batch check of the incremental batches."""
    v = Views.get(spark, sf)
    batches = detect.incremental_batches(v.injected.select("pos"), "pos", 7, 20, 100)
    rows = batches.join(v.injected.select("pos", *CONTENT_CENTS), "pos")
    hz = lookup.is_decoy(lookup.hash_rows(rows, CONTENT_CENTS, v.salt), v.lookup())
    return detect.batch_report(hz, ["batch"])


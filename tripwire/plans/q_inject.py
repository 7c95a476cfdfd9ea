"""Registered queries: scaling, injection budgets and placements, nearest-anchor
distances, access scenarios over trials, flood response."""

from __future__ import annotations

from pyspark.sql import functions as F

from tripwire.functions.buckets import sig_round, sig_round_sql as S
from tripwire.operators import inject, lookup, metrics, nearest, prep, scenarios
from tripwire.plans.q_core import _SPLIT_SQL
from tripwire.plans.registry import query
from tripwire.schema import CONTENT_CENTS, FEATURES
from tripwire.session import materialize
from tripwire.sources.fixtures import Views

RATIO = 0.05
HV_SEED = "42:random"


# ---- shared inputs: scaled train rows and scaled decoy pool ------------------------

def scaled_inputs(v: Views):
    """(train rows, decoy pool, scaler params) as z-scored features; the scaler
    is fit on the train split. Materialised once per view set: model fits
    iterate over these rows many times."""
    def build():
        fx = materialize(prep.stratified_split(prep.feature_frame(v.raw)), "split")
        train = fx.filter(F.col("split") == "train").drop("split")
        params = prep.scaler_params(prep.fit_scaler(train))
        train = materialize(prep.apply_scaler(train.withColumn("amount_raw", F.col("amount")), params))
        test = materialize(prep.apply_scaler(fx.filter(F.col("split") == "test").drop("split"), params))
        pool = materialize(prep.apply_scaler(prep.feature_frame(v.pool_raw), params))
        return train, pool, params, test
    return v.memo("scaled", build)[:3]


def scaled_test(v: Views):
    scaled_inputs(v)
    return v.memo("scaled", None)[3]


def _ctx():
    return inject.InjectContext(amount="amount_raw")


_Z = ",\n".join(f"(f.{c} - sc.m_{c}) / CASE WHEN sc.s_{c} = 0 THEN 1 ELSE sc.s_{c} END AS {c}" for c in FEATURES)
_SCALED = _SPLIT_SQL.strip() + """,
tr AS (SELECT f.* FROM features f JOIN split s ON f.tx_id = s.tx_id WHERE s.split = 'train'),
sc AS (SELECT """ + ", ".join(f"avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}" for c in FEATURES) + """ FROM tr),
ztr AS (SELECT f.tx_id, f.isFraud, f.amount AS amount_raw, """ + _Z + """ FROM tr f, sc),
zdec AS (SELECT f.tx_id, """ + _Z + """ FROM pool_features f, sc),
budget AS (SELECT (SELECT count(*) FROM ztr) AS n_real, (SELECT count(*) FROM zdec) AS n_pool,
  CAST(least(floor((SELECT count(*) FROM ztr) * CAST(0.05 AS DOUBLE) / (1 - CAST(0.05 AS DOUBLE))),
   (SELECT count(*) FROM zdec)) AS BIGINT) AS n_decoys),
quota AS (SELECT zone, CAST(greatest(1, floor(n_decoys * CAST(w AS DOUBLE))) AS BIGINT) AS quota
  FROM budget, (VALUES ('random', 0.25), ('edge_case', 0.25), ('cluster', 0.25), ('high_value', 0.25)) z(zone, w)),
hv_anchor AS (SELECT * FROM ztr WHERE amount_raw >= (SELECT quantile_cont(amount_raw, 0.8) FROM ztr)),
hv_dist AS (SELECT d.tx_id, min(sqrt(""" + " + ".join(f"(d.{c} - a.{c}) * (d.{c} - a.{c})" for c in FEATURES) + """)) AS min_dist
  FROM zdec d, hv_anchor a GROUP BY d.tx_id),
zr AS (SELECT tx_id FROM (SELECT tx_id, row_number() OVER (ORDER BY md5(concat(CAST(tx_id AS VARCHAR), ':42:random')), tx_id) AS rn FROM zdec) q
  WHERE rn <= (SELECT quota FROM quota WHERE zone = 'random')),
zhv AS (SELECT tx_id, min_dist FROM (SELECT tx_id, min_dist, row_number() OVER (ORDER BY min_dist, tx_id) AS rn FROM hv_dist) q
  WHERE rn <= (SELECT quota FROM quota WHERE zone = 'high_value'))"""


def _w(sql: str) -> str:
    return "WITH " + _SCALED + ("," if sql.strip().upper().startswith("X") else "\n") + sql


@query("zscore", _w(f"""
SELECT tx_id, {", ".join(f"round({c}, 9) AS {c}" for c in FEATURES)} FROM ztr"""))
def q_zscore(spark, sf):
    """Population z-score fit on the train split, applied to train rows."""
    train, _, _ = scaled_inputs(Views.get(spark, sf))
    return train.select("tx_id", *[F.round(F.col(c), 9).alias(c) for c in FEATURES])


@query("clip_3sd", _w("""
, m AS (SELECT """ + ", ".join(f"avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}" for c in FEATURES) + """ FROM ztr)
SELECT tx_id, """ + ", ".join(f"round(least(greatest({c}, m_{c} - 3 * s_{c}), m_{c} + 3 * s_{c}), 9) AS {c}" for c in FEATURES)
   + " FROM zdec, m").replace("\n, m AS", ",\nm AS"))
def q_clip_3sd(spark, sf):
    """Decoy features clipped into the real mean +- 3 population std."""
    train, pool, _ = scaled_inputs(Views.get(spark, sf))
    clipped = prep.clip_to_real(pool, train)
    return clipped.select("tx_id", *[F.round(F.col(c), 9).alias(c) for c in FEATURES])


@query("holdout_split", """
SELECT tx_id, CASE WHEN rn <= floor(n * CAST(0.2 AS DOUBLE) + 0.5) THEN 'test' ELSE 'train' END AS split FROM (
 SELECT tx_id, row_number() OVER (ORDER BY md5(concat(CAST(tx_id AS VARCHAR), ':42')), tx_id) AS rn,
  count(*) OVER () AS n FROM pool) q""")
def q_holdout_split(spark, sf):
    """Unstratified 80/20 split (the discriminator's split)."""
    return prep.holdout_split(Views.get(spark, sf).pool_zoned.select("tx_id")).select("tx_id", "split")


@query("inject_budget", _w("SELECT CAST(n_real AS BIGINT) AS n_real, CAST(n_pool AS BIGINT) AS n_pool, n_decoys FROM budget"))
def q_inject_budget(spark, sf):
    """Decoy budget min(int(n r / (1 - r)), pool)."""
    train, pool, _ = scaled_inputs(Views.get(spark, sf))
    n_real, n_pool = train.count(), pool.count()
    return spark.createDataFrame([(n_real, n_pool, inject.decoy_budget(n_real, n_pool, RATIO))],
                                 "n_real bigint, n_pool bigint, n_decoys bigint")


@query("zone_quota", _w("SELECT zone, quota FROM quota"))
def q_zone_quota(spark, sf):
    """Per-zone quota max(1, int(budget * weight))."""
    train, pool, _ = scaled_inputs(Views.get(spark, sf))
    q = inject.zone_quotas(inject.decoy_budget(train.count(), pool.count(), RATIO))
    return spark.createDataFrame(list(q.items()), "zone string, quota bigint")


def _quotas(train, pool):
    return inject.zone_quotas(inject.decoy_budget(train.count(), pool.count(), RATIO))


@query("zone_random", _w("SELECT tx_id FROM zr"))
def q_zone_random(spark, sf):
    """Random placement, k decoys without replacement."""
    train, pool, _ = scaled_inputs(Views.get(spark, sf))
    return inject.strategy_random(train, pool, _quotas(train, pool)["random"], _ctx()).select("tx_id")


@query("boundary_rows", """
SELECT tx_id FROM (SELECT tx_id, row_number() OVER (ORDER BY abs(score / 1300.0 - 0.5), tx_id) AS rn,
  count(*) OVER () AS n FROM scores) q WHERE rn <= floor(n * CAST(0.15 AS DOUBLE))""")
def q_boundary_rows(spark, sf):
    """The 15 % of rows whose score is nearest 0.5 (score = fixture score / 1300)."""
    sc = Views.get(spark, sf).scores.withColumn("p", F.col("score") / F.lit(1300.0))
    return inject.boundary_rows(sc, "p", "tx_id", 0.15).select("tx_id")


@query("min_dist", _w(f"SELECT tx_id, {S('min_dist')} AS min_dist FROM hv_dist"))
def q_min_dist(spark, sf):
    """J3 (cell-pruned exact path): each decoy's distance to the nearest
    high-value real row (20 % of the train split)."""
    train, pool, _ = scaled_inputs(Views.get(spark, sf))
    anchors = inject.high_value_anchors(train, "amount_raw")
    d = nearest.min_dist_cells(pool, anchors, "tx_id", FEATURES)
    return d.withColumn("min_dist", sig_round(F.col("min_dist")))


@query("decoy_min_dist", _w(f"""
, anc AS (SELECT * FROM (SELECT *, row_number() OVER (ORDER BY md5(concat(CAST(tx_id AS VARCHAR), ':anchors')), tx_id) AS rn FROM ztr) q WHERE rn <= 500)
SELECT d.tx_id, {S('min(sqrt(' + ' + '.join(f'(d.{c} - a.{c}) * (d.{c} - a.{c})' for c in FEATURES) + '))')} AS min_dist
FROM zdec d, anc a GROUP BY d.tx_id""".replace("\n, anc AS", ",\nanc AS")))
def q_decoy_min_dist(spark, sf):
    """G5 (broadcast path): distance from each decoy to the nearest of 500
    sampled real rows."""
    from tripwire.operators.ranking import first_n
    train, pool, _ = scaled_inputs(Views.get(spark, sf))
    anchors = first_n(train, "tx_id", "anchors", 500)
    d = nearest.min_dist_broadcast(pool, anchors, "tx_id", FEATURES)
    return d.withColumn("min_dist", sig_round(F.col("min_dist")))


@query("zone_high_value", _w(f"SELECT tx_id, {S('min_dist')} AS min_dist FROM zhv"))
def q_zone_high_value(spark, sf):
    """The k decoys nearest to the high-value real rows."""
    train, pool, _ = scaled_inputs(Views.get(spark, sf))
    k = _quotas(train, pool)["high_value"]
    anchors = inject.high_value_anchors(train, "amount_raw")
    d = nearest.min_dist_cells(pool, anchors, "tx_id", FEATURES, k=k)
    top = inject.smallest_k(d, F.col("min_dist"), "tx_id", k)
    return top.withColumn("min_dist", sig_round(F.col("min_dist")))


def _two_zone_union(v: Views):
    train, pool, _ = scaled_inputs(v)
    q = _quotas(train, pool)
    ctx = _ctx()
    zr = inject.strategy_random(train, pool, q["random"], ctx).withColumn("zone", F.lit("random"))
    anchors = inject.high_value_anchors(train, "amount_raw")
    d = nearest.min_dist_cells(pool, anchors, "tx_id", FEATURES, k=q["high_value"])
    zh = pool.join(inject.smallest_k(d, F.col("min_dist"), "tx_id", q["high_value"]).select("tx_id"), "tx_id") \
        .withColumn("zone", F.lit("high_value"))
    return inject.assemble(train, zr.unionByName(zh), ctx, ["tx_id"])


_UNION = """
, u AS (SELECT tx_id, isFraud, false AS is_decoy, CAST(NULL AS VARCHAR) AS zone FROM ztr
  UNION ALL SELECT tx_id, 0 AS isFraud, true AS is_decoy, 'random' AS zone FROM zr
  UNION ALL SELECT tx_id, 0 AS isFraud, true AS is_decoy, 'high_value' AS zone FROM zhv)"""


@query("inject_union", _w(_UNION.replace("\n, u AS", ",\nu AS") + "\nSELECT tx_id, isFraud, is_decoy, zone FROM u"))
def q_inject_union(spark, sf):
    """I8: real rows plus the random and high-value placements (a decoy placed
    by both zones appears twice)."""
    return _two_zone_union(Views.get(spark, sf))


@query("shuffle_rank", _w(_UNION.replace("\n, u AS", ",\nu AS") + """
SELECT tx_id, zone, row_number() OVER (ORDER BY md5(concat(concat_ws('|', CAST(tx_id AS VARCHAR), coalesce(zone, '')), ':42')),
  concat_ws('|', CAST(tx_id AS VARCHAR), coalesce(zone, ''))) - 1 AS pos FROM u"""))
def q_shuffle_rank(spark, sf):
    """Seeded permutation of the injected rows as a dense position."""
    return inject.shuffle_rank(_two_zone_union(Views.get(spark, sf)), "tx_id", 42).select("tx_id", "zone", "pos")


@query("inject_report", _w(_UNION.replace("\n, u AS", ",\nu AS") + f"""
SELECT CAST(sum(CASE WHEN NOT is_decoy THEN 1 ELSE 0 END) AS BIGINT) AS n_real,
 CAST(sum(CASE WHEN is_decoy THEN 1 ELSE 0 END) AS BIGINT) AS n_decoys, CAST(count(*) AS BIGINT) AS total,
 {S('sum(CASE WHEN is_decoy THEN 1 ELSE 0 END) / count(*) * 100.0')} AS actual_pct FROM u"""))
def q_inject_report(spark, sf):
    """Density report of the injected set."""
    rep = inject.inject_report(_two_zone_union(Views.get(spark, sf)))
    return rep.withColumn("actual_pct", sig_round(F.col("actual_pct")))


@query("density_sweep", _w(f"""
SELECT r AS injection_ratio, CAST(n_real AS BIGINT) AS n_real,
 CAST(least(floor(n_real * r / (1 - r)), n_pool) AS BIGINT) AS n_decoys,
 CAST(n_real + least(floor(n_real * r / (1 - r)), n_pool) AS BIGINT) AS total,
 {S('least(floor(n_real * r / (1 - r)), n_pool) / (n_real + least(floor(n_real * r / (1 - r)), n_pool)) * 100.0')} AS actual_pct
FROM budget, (SELECT CAST(x AS DOUBLE) AS r FROM (VALUES (0.01), (0.02), (0.05), (0.10), (0.15), (0.20)) t(x)) rs"""))
def q_density_sweep(spark, sf):
    """Decoys / total / percentage over the standard injection ratios."""
    train, pool, _ = scaled_inputs(Views.get(spark, sf))
    return inject.density_sweep(train, pool).withColumn("actual_pct", sig_round(F.col("actual_pct")))


# ---- access scenarios over the fixture injected set ------------------------------------

def _inj_hits(v: Views):
    """Injected rows probed once against the lookup (materialised: the scenario queries share it)."""
    def build():
        rows = lookup.hash_rows(v.injected.select("pos", *CONTENT_CENTS), CONTENT_CENTS, v.salt)
        return materialize(lookup.is_decoy(rows, v.lookup()).select("pos", "amount_c", "hit_zone"))
    return v.memo("inj_hits", build)


_IH = """
ih AS (SELECT i.pos, i.amount_c, k.zone AS hit_zone FROM injected i
 LEFT JOIN lookup k ON k.row_hash = sha256(concat(concat_ws(',', CAST(i.step AS VARCHAR), i.type,
   CAST(i.amount_c AS VARCHAR), CAST(i.oldbalanceOrg_c AS VARCHAR), CAST(i.newbalanceOrig_c AS VARCHAR),
   CAST(i.oldbalanceDest_c AS VARCHAR), CAST(i.newbalanceDest_c AS VARCHAR)), 'pepper'))),
tot AS (SELECT count(*) AS n, count(hit_zone) AS d FROM ih),
zc AS (SELECT hit_zone, count(*) AS dz FROM ih WHERE hit_zone IS NOT NULL GROUP BY hit_zone),
uk AS (SELECT 'bulk_steal_30' AS scenario, CAST(floor(n * CAST(0.3 AS DOUBLE)) AS BIGINT) AS k, n, d FROM tot
 UNION ALL SELECT 'bulk_steal_10', CAST(floor(n * CAST(0.1 AS DOUBLE)) AS BIGINT), n, d FROM tot
 UNION ALL SELECT 'slow_theft', CAST(least(20, floor(n / 100)) * 100 AS BIGINT), n, d FROM tot),
ur AS (SELECT scenario, k AS n_rows, CASE WHEN d <= 0 OR k <= 0 THEN 0.0 WHEN n - d < k THEN 1.0 ELSE
   1.0 - exp(lgamma(n - d + 1) - lgamma(n - d - k + 1) - lgamma(n + 1) + lgamma(n - k + 1)) END AS detection_rate,
  CASE WHEN k > 0 THEN d / CAST(n AS DOUBLE) ELSE 0.0 END AS decoy_ratio,
  (SELECT '{' || coalesce(string_agg('"' || hit_zone || '":' || CAST(CAST(floor(k * dz / CAST(n AS DOUBLE) + 0.5) AS BIGINT) AS VARCHAR), ',' ORDER BY hit_zone), '') || '}' FROM zc) AS zones_hit
 FROM uk),
sel AS (SELECT 'targeted_top20' AS scenario, hit_zone FROM ih WHERE amount_c >= (SELECT quantile_cont(amount_c, 0.8) FROM ih)
 UNION ALL SELECT 'targeted_top10', hit_zone FROM ih WHERE amount_c >= (SELECT quantile_cont(amount_c, 0.9) FROM ih)),
tr AS (SELECT s.scenario, count(*) AS n_rows, CASE WHEN count(hit_zone) > 0 THEN 1.0 ELSE 0.0 END AS detection_rate,
  count(hit_zone) / CAST(count(*) AS DOUBLE) AS decoy_ratio, max(coalesce(z.zones_hit, '{}')) AS zones_hit
 FROM sel s LEFT JOIN (SELECT scenario, '{' || string_agg('"' || hit_zone || '":' || CAST(c AS VARCHAR), ',' ORDER BY hit_zone) || '}' AS zones_hit
   FROM (SELECT scenario, hit_zone, count(*) AS c FROM sel WHERE hit_zone IS NOT NULL GROUP BY scenario, hit_zone) q GROUP BY scenario) z
  ON s.scenario = z.scenario GROUP BY s.scenario),
sc AS (SELECT * FROM ur UNION ALL SELECT * FROM tr)"""


@query("detection_rate", "WITH " + _IH.strip() + f"""
SELECT scenario, n_rows, round(detection_rate, 6) AS detection_rate, {S('decoy_ratio')} AS decoy_ratio, zones_hit FROM sc""")
def q_detection_rate(spark, sf):
    """Alarm probability, expected decoy share and zones hit per access scenario
    (bulk 30 % / 10 %, incremental 20 x 100: uniform draws, exact; targeted top 20 % / 10 %)."""
    h = _inj_hits(Views.get(spark, sf))
    out = scenarios.uniform_access(h, scenarios.BULK_AND_SLOW) \
        .unionByName(scenarios.targeted_accesses(h, "amount_c", scenarios.TARGETED))
    return out.withColumn("detection_rate", F.round("detection_rate", 6)) \
              .withColumn("decoy_ratio", sig_round(F.col("decoy_ratio")))


@query("scenario_summary", "WITH " + _IH.strip() + """
SELECT scenario AS attack, printf('%.1f%%', detection_rate * 100) AS detection_rate,
 printf('%.2f%%', decoy_ratio * 100) AS decoy_in_stolen, zones_hit FROM sc""")
def q_scenario_summary(spark, sf):
    """The scenario table with rates formatted as percentages."""
    d = q_detection_rate(spark, sf)
    return d.select(F.col("scenario").alias("attack"),
                    F.format_string("%.1f%%", F.col("detection_rate") * 100).alias("detection_rate"),
                    F.format_string("%.2f%%", F.col("decoy_ratio") * 100).alias("decoy_in_stolen"),
                    "zones_hit")


@query("false_alarm_rate", "WITH " + _SPLIT_SQL.strip() + """,
cl AS (SELECT l.tx_id, k.zone AS hit_zone FROM ledger l JOIN split s ON l.tx_id = s.tx_id AND s.split = 'train'
 LEFT JOIN lookup k ON k.row_hash = sha256(concat(concat_ws(',', CAST(l.step AS VARCHAR), l.type,
   CAST(l.amount_c AS VARCHAR), CAST(l.oldbalanceOrg_c AS VARCHAR), CAST(l.newbalanceOrig_c AS VARCHAR),
   CAST(l.oldbalanceDest_c AS VARCHAR), CAST(l.newbalanceDest_c AS VARCHAR)), 'pepper'))),
t AS (SELECT count(*) AS n, count(hit_zone) AS d, least(50, count(*)) AS k FROM cl)
SELECT round(CASE WHEN d <= 0 OR k <= 0 THEN 0.0 WHEN n - d < k THEN 1.0 ELSE
  1.0 - exp(lgamma(n - d + 1) - lgamma(n - d - k + 1) - lgamma(n + 1) + lgamma(n - k + 1)) END, 6) AS false_positive_rate,
 CAST(k AS INTEGER) AS draw_size, n AS n_clean, d AS n_false_hits FROM t""")
def q_false_alarm_rate(spark, sf):
    """Probability that a draw of 50 clean train rows raises an alarm."""
    v = Views.get(spark, sf)
    split = prep.stratified_split(v.ledger.select("tx_id", "isFraud")).filter(F.col("split") == "train")
    rows = lookup.hash_rows(v.ledger.join(split.select("tx_id"), "tx_id"), CONTENT_CENTS, v.salt)
    clean = lookup.is_decoy(rows, v.lookup()).select("tx_id", "hit_zone")
    return scenarios.false_alarm_rate(clean, 50).withColumn("false_positive_rate", F.round("false_positive_rate", 6))


@query("flood_response", """
WITH pidx AS (SELECT tx_id, row_number() OVER (ORDER BY tx_id) AS i FROM pool),
n AS (SELECT count(*) AS np FROM pool),
dr AS (SELECT d.range AS draw, ('0x' || substr(md5(concat(CAST(d.range AS VARCHAR), ':flood')), 1, 15))::BIGINT % (SELECT np FROM n) + 1 AS i
 FROM range(0, 900) d WHERE d.range < (SELECT np FROM n)),
dec AS (SELECT dr.draw, 'decoy' AS src, p.tx_id AS ref FROM dr JOIN pidx p ON dr.i = p.i),
rl AS (SELECT CAST(NULL AS BIGINT) AS draw, 'injected' AS src, pos AS ref FROM (
  SELECT pos, row_number() OVER (ORDER BY md5(concat(CAST(pos AS VARCHAR), ':flood')), pos) AS rn FROM injected) q WHERE rn <= 100),
u AS (SELECT * FROM dec UNION ALL SELECT * FROM rl)
SELECT row_number() OVER (ORDER BY md5(concat(concat_ws('|', src, coalesce(CAST(draw AS VARCHAR), ''), CAST(ref AS VARCHAR)), ':flood')),
  concat_ws('|', src, coalesce(CAST(draw AS VARCHAR), ''), CAST(ref AS VARCHAR))) - 1 AS slot, src, ref FROM u""")
def q_flood_response(spark, sf):
    """A 1,000-row poisoned answer: 90 % pool draws with replacement,
    10 % injected rows, shuffled."""
    v = Views.get(spark, sf)
    return scenarios.flood_response(v.pool_zoned.select("tx_id"), v.injected.select("pos"), "tx_id", "pos", 1000)


@query("auc_delta", f"""
WITH s1 AS (SELECT CAST(score AS DOUBLE) AS score, label FROM scores),
s2 AS (SELECT * FROM s1 UNION ALL SELECT CAST(amount_c % 1000 AS DOUBLE), 0 FROM pool),
c1 AS (SELECT score, sum(label) AS p, sum(1 - label) AS n FROM s1 GROUP BY score),
c2 AS (SELECT score, sum(label) AS p, sum(1 - label) AS n FROM s2 GROUP BY score),
a1 AS (SELECT sum(p * (coalesce(nb, 0) + 0.5 * n)) / (sum(p) * sum(n)) AS auc FROM
  (SELECT *, sum(n) OVER (ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS nb FROM c1) q),
a2 AS (SELECT sum(p * (coalesce(nb, 0) + 0.5 * n)) / (sum(p) * sum(n)) AS auc FROM
  (SELECT *, sum(n) OVER (ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS nb FROM c2) q)
SELECT {S('CAST(a1.auc AS DOUBLE)')} AS auc_clean, {S('CAST(a2.auc AS DOUBLE)')} AS auc_injected,
 {S('abs(CAST(a1.auc AS DOUBLE) - CAST(a2.auc AS DOUBLE))')} AS auc_delta FROM a1, a2""")
def q_auc_delta(spark, sf):
    """|AUC(clean) - AUC(with decoys labelled 0)| on the fixture scores."""
    v = Views.get(spark, sf)
    s1 = v.scores.select(F.col("score").cast("double").alias("score"), "label")
    s2 = s1.unionByName(v.pool_zoned.select((F.col("amount_c") % 1000).cast("double").alias("score"),
                                           F.lit(0).alias("label")))
    a1 = metrics.auc_roc(s1).first()["auc_roc"]
    a2 = metrics.auc_roc(s2).first()["auc_roc"]
    row = spark.createDataFrame([(a1, a2, abs(a1 - a2))], "auc_clean double, auc_injected double, auc_delta double")
    return row.select(*[sig_round(F.col(c)).alias(c) for c in row.columns])


@query("paired_auc", f"""
WITH s AS (SELECT CAST(amount_c % 1000 + 300 * isFraud AS DOUBLE) AS a, CAST(amount_c % 777 + 150 * isFraud AS DOUBLE) AS b, isFraud AS y FROM ledger),
n AS (SELECT sum(y) AS m, sum(1 - y) AS n FROM s),
p AS (SELECT y, m, n, {", ".join(f"CASE WHEN y = 1 THEN (rank() OVER (ORDER BY {x}) - 1 - pb_{x} + 0.5 * ne_{x}) / n ELSE (m - pb_{x} - 0.5 * pe_{x}) / m END AS v_{x}" for x in "ab")}
  FROM (SELECT s.*, {", ".join(f"sum(y) OVER (ORDER BY {x} RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - sum(y) OVER (PARTITION BY {x}) AS pb_{x}, sum(y) OVER (PARTITION BY {x}) AS pe_{x}, sum(1 - y) OVER (PARTITION BY {x}) AS ne_{x}" for x in "ab")} FROM s) q, n),
r AS (SELECT max(m) AS m, max(n) AS n, avg(v_a) FILTER (y = 1) AS ua, avg(v_b) FILTER (y = 1) AS ub,
  var_samp(v_b - v_a) FILTER (y = 1) / max(m) + var_samp(v_b - v_a) FILTER (y = 0) / max(n) AS var FROM p)
SELECT CAST(m AS BIGINT) AS n_pos, CAST(n AS BIGINT) AS n_neg, {S('ua')} AS auc_a, {S('ub')} AS auc_b, {S('ub - ua')} AS auc_delta,
  {S('var')} AS var_delta, {S('(ub - ua) / sqrt(var)')} AS z FROM r""")
def q_paired_auc(spark, sf):
    """Two scores of the same rows, the difference of their AUCs and its DeLong variance."""
    rows = Views.get(spark, sf).ledger.select(
        (F.col("amount_c") % 1000 + 300 * F.col("isFraud")).alias("a"), (F.col("amount_c") % 777 + 150 * F.col("isFraud")).alias("b"), "isFraud")
    out = metrics.paired_auc(rows, "a", "b", "isFraud")
    return out.select("n_pos", "n_neg", *[sig_round(F.col(c)).alias(c) for c in ("auc_a", "auc_b", "auc_delta", "var_delta", "z")])


@query("top_pct_select", """
SELECT pos FROM injected WHERE amount_c >= (SELECT quantile_cont(amount_c, 0.8) FROM injected)""")
def q_top_pct_select(spark, sf):
    """Targeted access, rows in the top 20 % by amount."""
    return prep.high_value_rows(Views.get(spark, sf).injected.select("pos", "amount_c"), "amount_c", 20.0).select("pos")


@query("bulk_select", """
SELECT pos FROM (SELECT pos, row_number() OVER (ORDER BY md5(concat(CAST(pos AS VARCHAR), ':bulk')), pos) AS rn,
 count(*) OVER () AS n FROM injected) q WHERE rn <= floor(n * CAST(0.3 AS DOUBLE))""")
def q_bulk_select(spark, sf):
    """Bulk access, int(0.3 n) rows without replacement."""
    inj = Views.get(spark, sf).injected.select("pos")
    return prep.sample_exact(inj, 0.3, key="pos", seed="bulk", rounding="floor")


"""Registered queries: streaming detection (T1-T4) and sources/sinks round-trips
(S1, S5, S6, S8)."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import functions as F

from tripwire.functions.buckets import sig_round, sig_round_sql as S
from tripwire.operators import prep
from tripwire.plans.q_inject import _w
from tripwire.plans.registry import query
from tripwire.schema import FEATURES
from tripwire.session import ensure_checkpoint_dir
from tripwire.sources import sinks
from tripwire.sources.fixtures import Views
from tripwire.sources.lookup_store import LookupStore
from tripwire.sources.tables import read_ledger_csv
from tripwire.streaming import detect_stream as ds


def _hits_stream(v: Views):
    n = v.injected.count()
    acc = ds.access_stream(v.spark, v.sf_dir, n)
    return ds.stream_hits(acc, v.injected, v.lookup(), v.salt)


def _scratch(spark, name: str) -> str:
    return os.path.join(ensure_checkpoint_dir(spark), "io", f"{name}-{uuid.uuid4().hex[:8]}")


@query("stream_check", "SELECT event_id, actor, batch, pos, is_decoy, hit_zone FROM hits")
def q_stream_check(spark, sf):
    """Stream-static lookup check of the access stream (availableNow)."""
    v = Views.get(spark, sf)
    out = ds.run_to_files(_hits_stream(v), "stream_check")
    schema = "event_id bigint, actor bigint, ts timestamp, batch int, pos bigint, is_decoy boolean, hit_zone string"
    return ds.read_output(spark, out, schema).select("event_id", "actor", "batch", "pos", "is_decoy", "hit_zone")


@query("stream_window_alarm", """
SELECT actor, date_trunc('day', ts) AS window_start, date_trunc('day', ts) + INTERVAL 1 DAY AS window_end,
 CAST(count(*) AS BIGINT) AS n_rows, CAST(count(hit_zone) AS BIGINT) AS n_decoys, count(hit_zone) > 0 AS alarm
FROM hits GROUP BY actor, date_trunc('day', ts)
HAVING date_trunc('day', ts) + INTERVAL 1 DAY <= (SELECT max(ts) FROM hits) - INTERVAL 1 HOUR""")
def q_stream_window_alarm(spark, sf):
    """Daily tumbling windows per actor, 1 h watermark, closed windows only."""
    v = Views.get(spark, sf)
    out = ds.run_to_files(ds.windowed_alarms(_hits_stream(v)), "stream_window_alarm", "append")
    schema = ("actor bigint, window_start timestamp, window_end timestamp, n_rows bigint, "
              "n_decoys bigint, alarm boolean")
    df = ds.read_output(spark, out, schema)
    return df.select("actor", F.col("window_start").cast("timestamp_ntz").alias("window_start"),
                     F.col("window_end").cast("timestamp_ntz").alias("window_end"), "n_rows", "n_decoys", "alarm")


@query("stream_sliding_alarm", """
WITH w AS (SELECT actor, hit_zone, unnest(range(4)) AS k, time_bucket(INTERVAL 15 MINUTE, ts) AS b FROM hits)
SELECT actor, b - k * INTERVAL 15 MINUTE AS window_start, b - k * INTERVAL 15 MINUTE + INTERVAL 1 HOUR AS window_end,
 CAST(count(*) AS BIGINT) AS n_rows, CAST(count(hit_zone) AS BIGINT) AS n_decoys, count(hit_zone) > 0 AS alarm
FROM w GROUP BY actor, b - k * INTERVAL 15 MINUTE
HAVING b - k * INTERVAL 15 MINUTE + INTERVAL 1 HOUR <= (SELECT max(ts) FROM hits) - INTERVAL 1 HOUR""")
def q_stream_sliding_alarm(spark, sf):
    """T4: hourly windows sliding by 15 minutes per actor, 1 h watermark, closed windows only."""
    v = Views.get(spark, sf)
    out = ds.run_to_files(ds.sliding_alarms(_hits_stream(v)), "stream_sliding_alarm", "append")
    schema = ("actor bigint, window_start timestamp, window_end timestamp, n_rows bigint, "
              "n_decoys bigint, alarm boolean")
    df = ds.read_output(spark, out, schema)
    return df.select("actor", F.col("window_start").cast("timestamp_ntz").alias("window_start"),
                     F.col("window_end").cast("timestamp_ntz").alias("window_end"), "n_rows", "n_decoys", "alarm")


@query("stream_first_alarm", """
SELECT actor, CAST(count(*) AS BIGINT) AS n_rows, CAST(count(hit_zone) AS BIGINT) AS n_decoys,
 min(CASE WHEN hit_zone IS NOT NULL THEN batch END) AS first_alarm_batch FROM hits GROUP BY actor""")
def q_stream_first_alarm(spark, sf):
    """Per-actor running state (stateful streaming aggregation, update mode); final state = D3."""
    v = Views.get(spark, sf)
    out = ds.run_to_files(ds.running_first_alarm(_hits_stream(v)), "stream_first_alarm", "update")
    df = ds.read_output(spark, out, ds.STATE_OUT)
    return ds.latest_per_key(df, "actor").select("actor", "n_rows", "n_decoys", "first_alarm_batch")


@query("stream_late_rows", """
WITH t AS (SELECT *, date_trunc('day', ts) + INTERVAL 1 DAY AS window_end, hour(ts) % 2 = 0 AS second FROM hits),
m AS (SELECT max(ts) - INTERVAL 1 HOUR AS mark FROM t WHERE NOT second),
l AS (SELECT t.*, second AND coalesce(window_end <= mark, false) AS late FROM t, m)
SELECT actor, window_end - INTERVAL 1 DAY AS window_start, CAST(count(*) FILTER (NOT late) AS BIGINT) AS n_rows,
 CAST(count(hit_zone) FILTER (NOT late) AS BIGINT) AS n_decoys, CAST(count(*) FILTER (late) AS BIGINT) AS n_late,
 CAST(count(hit_zone) FILTER (late) AS BIGINT) AS n_late_decoys FROM l GROUP BY actor, window_end""")
def q_stream_late_rows(spark, sf):
    """T2 side output: accesses of even hours arrive after all of odd hours, in a
    second run from the same checkpoint; what is behind the watermark by then is
    counted as late, so n_rows + n_late are all accesses."""
    v = Views.get(spark, sf)
    base = ds.stream_dir(spark, "stream_late_rows")
    src = os.path.join(base, "src")
    events = spark.read.parquet(os.path.join(sf, "events.parquet"))
    second = F.hour(F.col("ts").cast("timestamp")) % 2 == 0
    n = v.injected.count()
    probed = None
    for arriving in (events.filter(~second), events.filter(second)):
        arriving.write.mode("append").parquet(src)
        acc = ds.access_stream(spark, src, n, file_glob="*.parquet")
        probed = probed if probed is not None else ds.probed_rows(v.injected, v.lookup(), v.salt)
        out = ds.run_windows_with_late(ds.join_probed(acc, probed), base)
    return ds.windows_and_late(spark, out).select(
        "actor", F.col("window_start").cast("timestamp_ntz").alias("window_start"), "n_rows", "n_decoys", "n_late", "n_late_decoys")


@query("stream_expired_actors", """
WITH s AS (SELECT actor, ts, batch, hit_zone,
  CASE WHEN ts - lag(ts) OVER (PARTITION BY actor ORDER BY ts) < INTERVAL 2 DAY THEN 0 ELSE 1 END AS new_s FROM hits),
g AS (SELECT *, sum(new_s) OVER (PARTITION BY actor ORDER BY ts ROWS UNBOUNDED PRECEDING) AS sid FROM s)
SELECT actor, min(ts) AS first_ts, max(ts) + INTERVAL 2 DAY AS expired_at,
 CAST(count(*) AS BIGINT) AS n_rows, CAST(count(hit_zone) AS BIGINT) AS n_decoys,
 min(CASE WHEN hit_zone IS NOT NULL THEN batch END) AS first_alarm_batch
FROM g GROUP BY actor, sid HAVING max(ts) + INTERVAL 2 DAY <= (SELECT max(ts) FROM hits) - INTERVAL 1 HOUR""")
def q_stream_expired_actors(spark, sf):
    """T3 with expiry: totals of actors silent for two days, emitted once as they leave the state."""
    v = Views.get(spark, sf)
    out = ds.run_to_files(ds.expiring_first_alarm(_hits_stream(v)), "stream_expired_actors", "append")
    schema = "actor bigint, first_ts timestamp, expired_at timestamp, n_rows bigint, n_decoys bigint, first_alarm_batch int"
    df = ds.read_output(spark, out, schema)
    return df.select("actor", F.col("first_ts").cast("timestamp_ntz").alias("first_ts"),
                     F.col("expired_at").cast("timestamp_ntz").alias("expired_at"), "n_rows", "n_decoys", "first_alarm_batch")


@query("stream_session_hits", """
WITH s AS (SELECT actor, ts, hit_zone,
  CASE WHEN lag(ts) OVER (PARTITION BY actor ORDER BY ts) IS NULL
    OR ts - lag(ts) OVER (PARTITION BY actor ORDER BY ts) >= INTERVAL 30 MINUTE THEN 1 ELSE 0 END AS new_s FROM hits),
g AS (SELECT *, sum(new_s) OVER (PARTITION BY actor ORDER BY ts ROWS UNBOUNDED PRECEDING) AS sid FROM s)
SELECT actor, min(ts) AS session_start, max(ts) + INTERVAL 30 MINUTE AS session_end,
 CAST(count(*) AS BIGINT) AS n_rows, CAST(count(hit_zone) AS BIGINT) AS n_decoys
FROM g GROUP BY actor, sid
HAVING max(ts) + INTERVAL 30 MINUTE <= (SELECT max(ts) FROM hits) - INTERVAL 1 HOUR""")
def q_stream_session_hits(spark, sf):
    """T4: 30-minute session windows of accesses per actor (closed sessions)."""
    v = Views.get(spark, sf)
    out = ds.run_to_files(ds.session_hits(_hits_stream(v)), "stream_session_hits", "append")
    schema = "actor bigint, session_start timestamp, session_end timestamp, n_rows bigint, n_decoys bigint"
    df = ds.read_output(spark, out, schema)
    return df.select("actor", F.col("session_start").cast("timestamp_ntz").alias("session_start"),
                     F.col("session_end").cast("timestamp_ntz").alias("session_end"), "n_rows", "n_decoys")


# ---- sources and sinks ---------------------------------------------------------

@query("scan_ledger", """
SELECT step, type, amount, nameOrig, oldbalanceOrg, newbalanceOrig, nameDest, oldbalanceDest,
 newbalanceDest, isFraud, isFlaggedFraud FROM raw_ledger""")
def q_scan_ledger(spark, sf):
    """The ledger written as headed CSV and scanned back with the explicit schema."""
    path = _scratch(spark, "ledger_csv")
    sinks.write_ledger_csv(Views.get(spark, sf).raw, path)
    return read_ledger_csv(spark, path)


@query("lookup_roundtrip", """
SELECT zone, CAST(count(*) AS BIGINT) AS n_hashes FROM lookup GROUP BY zone""")
def q_lookup_roundtrip(spark, sf):
    """Lookup saved as (row_hash, zone) only, reloaded, counters recomputed."""
    path = _scratch(spark, "lookup")
    sinks.write_lookup(Views.get(spark, sf).lookup(), path)
    back = sinks.read_lookup(spark, path)
    return back.groupBy("zone").agg(F.count(F.lit(1)).cast("bigint").alias("n_hashes"))


@query("lookup_upsert", """
WITH r AS (SELECT row_hash, 1 AS batch, zone FROM pool_zoned
  UNION ALL SELECT row_hash, 2, 'random' FROM pool_zoned WHERE tx_id % 3 = 0
  UNION ALL SELECT row_hash, 2, 'edge_case' FROM pool_zoned WHERE tx_id % 6 = 0
  UNION ALL SELECT row_hash, 3, 'cluster' FROM pool_zoned WHERE tx_id % 5 = 0)
SELECT row_hash, arg_max(zone, batch * 10 + CASE zone WHEN 'random' THEN 1 WHEN 'edge_case' THEN 2 WHEN 'cluster' THEN 3 ELSE 4 END) AS zone
FROM r GROUP BY row_hash""")
def q_lookup_upsert(spark, sf):
    """Three registrations into a saved lookup, the third before the second,
    the second replayed, with a compaction between them; the last batch of a hash
    wins, within a batch the last zone."""
    pool = Views.get(spark, sf).pool_zoned
    part = lambda n, zone: pool.filter(f"tx_id % {n} = 0").select("row_hash", F.lit(zone).alias("zone"))
    store = LookupStore(spark, _scratch(spark, "lookup-store"))
    store.register(1, pool)
    store.register(3, part(5, "cluster"))
    store.compact()
    for _ in range(2):
        store.register(2, part(3, "random").unionByName(part(6, "edge_case")))
    return store.lookup()


@query("scaler_roundtrip", _w("""
SELECT f AS feature, """ + S("m") + " AS mean, " + S("s") + """ AS std FROM sc,
 (VALUES """ + ", ".join(f"('{c}')" for c in FEATURES) + """) t(f)
CROSS JOIN LATERAL (SELECT CASE f """ + " ".join(f"WHEN '{c}' THEN sc.m_{c}" for c in FEATURES) + """ END AS m,
  CASE f """ + " ".join(f"WHEN '{c}' THEN sc.s_{c}" for c in FEATURES) + """ END AS s)"""))
def q_scaler_roundtrip(spark, sf):
    """Scaler parameters (train mean / population std) persisted and reloaded."""
    v = Views.get(spark, sf)
    train = prep.stratified_split(prep.feature_frame(v.raw)).filter(F.col("split") == "train")
    path = _scratch(spark, "scaler")
    sinks.write_scaler(prep.fit_scaler(train), path)
    back = sinks.read_scaler(spark, path)
    return back.select("feature", sig_round(F.col("mean")).alias("mean"), sig_round(F.col("std")).alias("std"))


@query("report_sinks")
def q_report_sinks(spark, sf):
    """Quality report to CSV and a summary to JSON, read back."""
    from tripwire.operators import quality
    v = Views.get(spark, sf)
    real = prep.feature_frame(v.raw.filter(F.col("isFraud") == 0))
    rep = quality.quality_report(quality.stack(real, prep.feature_frame(v.pool_raw)))
    p1, p2 = _scratch(spark, "report_csv"), _scratch(spark, "summary_json")
    sinks.write_report_csv(rep, p1)
    sinks.write_summary_json(rep.agg(F.sum(F.col("mean_ok").cast("int")).alias("features_within_2sd"),
                                     F.avg("kl_div").alias("mean_kl_divergence")), p2)
    return spark.read.option("header", True).csv(p1)


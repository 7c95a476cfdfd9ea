"""Lookup registration, batch checks and access detection on hand-made frames."""

import json

from pyspark.sql import functions as F

from tripwire.schema import CONTENT_CENTS
from tripwire.operators import detect, lookup


def test_last_zone_wins_and_counters(spark):
    d = spark.createDataFrame([("h1", "random"), ("h1", "high_value"), ("h2", "cluster")], "row_hash string, zone string")
    reg = {r.row_hash: r.zone for r in lookup.register(d).collect()}
    assert reg == {"h1": "high_value", "h2": "cluster"}
    summ = {r.zone: (r.n_registered, r.n_hashes) for r in lookup.lookup_summary(d).collect()}
    assert summ == {"random": (1, 0), "high_value": (1, 1), "cluster": (1, 1)}


def test_unknown_zone_registers_after_known(spark):
    d = spark.createDataFrame([("h", "custom"), ("h", "high_value")], "row_hash string, zone string")
    assert lookup.register(d).first().zone == "custom"


def _hits(spark, rows):
    return spark.createDataFrame(rows, "actor long, batch int, hit_zone string, is_decoy boolean")


def test_batch_check_counts_duplicates_and_ratio(spark):
    h = _hits(spark, [(1, 1, "random", True), (1, 1, "random", True), (1, 1, None, False), (1, 2, None, False)])
    out = {r.batch: r for r in detect.batch_report(h, ["actor", "batch"]).collect()}
    assert out[1].n_decoys == 2 and out[1].n_rows == 3 and out[1].alarm
    assert json.loads(out[1].zones_hit) == {"random": 2}
    assert out[2].n_decoys == 0 and not out[2].alarm and out[2].decoy_ratio == 0.0
    assert out[2].zones_hit == "{}"


def test_batch_check_empty_input(spark):
    h = _hits(spark, [])
    assert detect.batch_report(h, ["actor", "batch"]).count() == 0


def test_first_alarm_and_profile(spark):
    h = _hits(spark, [(7, 3, None, False), (7, 5, "cluster", True), (7, 9, "random", True),
                      (7, 9, "cluster", True), (8, 1, None, False)])
    fa = {r.actor: r for r in detect.first_alarm(h).collect()}
    assert fa[7].first_alarm_batch == 5 and fa[7].n_decoys == 3 and fa[7].n_rows == 4 and fa[7].n_batches == 3
    assert fa[8].first_alarm_batch is None and fa[8].n_decoys == 0
    prof = {r.actor: r for r in detect.actor_profile(h).collect()}
    assert prof[7].dominant_zone == "cluster" and prof[7].n_zones == 2
    assert 8 not in prof


def test_profile_tie_goes_to_earliest_zone(spark):
    h = _hits(spark, [(1, 1, "high_value", True), (1, 1, "random", True)])
    assert detect.actor_profile(h).first().dominant_zone == "random"


def test_hash_is_sha256_of_encoding_and_salt(spark):
    import hashlib
    df = spark.createDataFrame([(1, "PAYMENT", 10, 0, 0, 5, 15)],
                               "step int, type string, amount_c long, oldbalanceOrg_c long, newbalanceOrig_c long, "
                               "oldbalanceDest_c long, newbalanceDest_c long")
    got = lookup.hash_rows(df, CONTENT_CENTS, "s3cret").first().row_hash
    assert got == hashlib.sha256(b"1,PAYMENT,10,0,0,5,15s3cret").hexdigest()


def test_encoding_tells_rows_apart(spark):
    from tripwire.functions.hashing import encode_row, encode_row_fixed6
    rows = [("a", None, "b"), ("a", "b", None), (None, "a", "b"), ("a,b", "", None), ("a", "b", ""), ("a\\,b", "", None), ("\\N", "a", "b"), ("a\\", "b", "c"), ("a", "\\b", "c")]
    df = spark.createDataFrame(rows, "x string, y string, z string")
    assert df.select(encode_row(["x", "y", "z"]).alias("e")).distinct().count() == len(rows)
    num = spark.createDataFrame([(1.0, None), (None, 1.0), (0.0, 1.0)], "x double, y double")
    assert sorted(r.e for r in num.select(encode_row_fixed6(["x", "y"]).alias("e")).collect()) == ["0.000000,1.000000", "1.000000,\\N", "\\N,1.000000"]


def test_salt_is_in_no_plan(spark, capsys):
    df = spark.createDataFrame([(1, "x")], "a int, b string")
    h = lookup.hash_rows(df, ["a", "b"], "sEcReTsAlT")
    h.collect()
    h.explain("extended")
    assert "row_hash" in (out := capsys.readouterr().out) and "sEcReTsAlT" not in out
    assert "sEcReTsAlT" not in h._jdf.queryExecution().toString()


def test_zone_order_is_the_callers(spark):
    d = spark.createDataFrame([("h", "random"), ("h", "cluster"), ("g", None), ("k", "zz"), ("k", "aa"), ("k", "random")], "row_hash string, zone string")
    got = lambda **kw: {r.row_hash: r.zone for r in lookup.register(d, **kw).collect()}
    assert got() == {"h": "cluster", "g": None, "k": "zz"}
    assert got(order=["cluster", "random"]) == {"h": "random", "g": None, "k": "zz"}
    assert got(order=["zz", "random"])["k"] == "aa"


def test_unknown_positions_are_counted(spark):
    rows = spark.createDataFrame([(0, "x", True), (1, "y", False)], "pos long, c string, is_decoy boolean")
    lk = lookup.register(lookup.hash_rows(rows.filter("is_decoy").withColumn("zone", F.lit("random")), ["c"], "s"))
    acc = spark.createDataFrame([(7, 1, 0), (7, 1, 1), (7, 2, 99), (8, 1, None)], "actor long, batch int, pos long")
    hits = detect.access_hits(acc, rows, lk, "s", content=["c"])
    got = {r.actor: (r.n_rows, r.n_decoys, r.first_alarm_batch) for r in detect.first_alarm(hits).collect()}
    assert got == {7: (3, 1, 1), 8: (1, 0, None)}


def test_every_planted_decoy_is_found(views):
    rows = lookup.hash_rows(views.injected, CONTENT_CENTS, views.salt)
    hits = lookup.is_decoy(rows, views.lookup())
    agg = hits.agg(F.sum(F.col("is_decoy").cast("int")).alias("t"),
                   F.sum(F.col("hit_zone").isNotNull().cast("int")).alias("h"),
                   F.sum((F.col("hit_zone").isNotNull() & ~F.col("is_decoy")).cast("int")).alias("fp")).first()
    assert agg.t == agg.h and agg.fp == 0


def test_incremental_batches_shape(views):
    b = detect.incremental_batches(views.injected.select("pos"), "pos", 1, 5, 50)
    counts = sorted(r["count"] for r in b.groupBy("batch").count().collect())
    assert counts == [50] * 5
    assert b.select("pos").distinct().count() == 250


def test_incremental_batches_no_partial_batch(spark):
    df = spark.range(230).withColumnRenamed("id", "pos")
    b = detect.incremental_batches(df, "pos", 1, 10, 100)
    assert b.count() == 200

"""Structured Streaming forms of access detection.

The access log arrives as files; each micro-batch is resolved against the
static injected table and lookup (stream-static joins), then:

* T1 ``stream_hits``          – hits per access, appended
* T2 ``windowed_alarms``      – tumbling event-time windows per actor with a
                                 watermark (append: closed windows only)
* T3 ``running_first_alarm``  – per-actor running totals and first alarming
                                 batch as a stateful streaming aggregation in
                                 update mode (state is three numbers per actor)
* T2 ``run_windows_with_late`` – the same windows with a side output: accesses
                                 behind the watermark are counted, not dropped
* T3 ``expiring_first_alarm`` – running totals whose state leaves the store once
                                 the actor has been silent for a given time
* T4 ``session_hits``         – session windows of accesses per actor

Sinks write each micro-batch to ``<out>/mb=<id>`` with overwrite, so a
replayed batch after a failure replaces its own output (idempotent);
checkpoints and outputs live under ``spark.checkpoint.dir``. Event time is
UTC wall clock: the helpers pin the session time zone to UTC.
"""

from __future__ import annotations

import os
import uuid
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripwire.operators.detect import join_hits, probe
from tripwire.session import ensure_checkpoint_dir, materialize, utc


def stream_dir(spark: SparkSession, name: str) -> str:
    base = ensure_checkpoint_dir(spark)
    return os.path.join(base, "streams", f"{name}-{uuid.uuid4().hex[:8]}")


def access_stream(spark: SparkSession, src_dir: str, n_rows: int, file_glob: str = "events.parquet",
                  max_files: int | None = None) -> DataFrame:
    """Access events as a stream: actor, event time, day batch, row position."""
    utc(spark)
    schema = spark.read.parquet(os.path.join(src_dir, file_glob)).schema
    r = spark.readStream.schema(schema).option("pathGlobFilter", file_glob)
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    ev = r.parquet(src_dir)
    return ev.select("event_id", F.col("user_id").alias("actor"),
                     F.col("ts").cast("timestamp").alias("ts"),
                     F.dayofmonth("ts").cast("int").alias("batch"),
                     ((F.col("event_id") * 7919) % F.lit(n_rows)).alias("pos"))


def stream_hits(access: DataFrame, rows: DataFrame, lookup: DataFrame, salt: str) -> DataFrame:
    """Stream-static join to the probed positions."""
    return join_probed(access, probed_rows(rows, lookup, salt))


def probed_rows(rows: DataFrame, lookup: DataFrame, salt: str) -> DataFrame:
    """The positions an alarm can come from, written once and not planned anew in every micro-batch."""
    return materialize(probe(rows, lookup, salt), "probed")


def join_probed(access: DataFrame, probed: DataFrame) -> DataFrame:
    return join_hits(access, probed).select("event_id", "actor", "ts", "batch", "pos", "is_decoy", "hit_zone")


def windowed_alarms(hits: DataFrame, window: str = "1 day", delay: str = "1 hour") -> DataFrame:
    """Per actor and tumbling window: rows, decoy hits, alarm."""
    hit = F.col("hit_zone").isNotNull()
    return (hits.withWatermark("ts", delay)
            .groupBy(F.window("ts", window).alias("w"), "actor")
            .agg(F.count(F.lit(1)).cast("bigint").alias("n_rows"),
                 F.sum(F.when(hit, 1).otherwise(0)).cast("bigint").alias("n_decoys"))
            .select("actor", F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                    "n_rows", "n_decoys", (F.col("n_decoys") > 0).alias("alarm")))


def sliding_alarms(hits: DataFrame, window: str = "1 hour", slide: str = "15 minutes", delay: str = "1 hour") -> DataFrame:
    """T4: per actor and sliding window: rows, decoy hits, alarm (closed windows)."""
    hit = F.col("hit_zone").isNotNull()
    return (hits.withWatermark("ts", delay)
            .groupBy(F.window("ts", window, slide).alias("w"), "actor")
            .agg(F.count(F.lit(1)).cast("bigint").alias("n_rows"),
                 F.sum(F.when(hit, 1).otherwise(0)).cast("bigint").alias("n_decoys"))
            .select("actor", F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                    "n_rows", "n_decoys", (F.col("n_decoys") > 0).alias("alarm")))


def session_hits(hits: DataFrame, gap: str = "30 minutes", delay: str = "1 hour") -> DataFrame:
    """T4: per actor session windows of accesses (gap-separated). Sessions are
    merged before the shuffle, so a hot actor sends few rows to its task."""
    hits.sparkSession.conf.set("spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition", "true")
    hit = F.col("hit_zone").isNotNull()
    return (hits.withWatermark("ts", delay)
            .groupBy(F.session_window("ts", gap).alias("s"), "actor")
            .agg(F.count(F.lit(1)).cast("bigint").alias("n_rows"),
                 F.sum(F.when(hit, 1).otherwise(0)).cast("bigint").alias("n_decoys"))
            .select("actor", F.col("s.start").alias("session_start"), F.col("s.end").alias("session_end"),
                    "n_rows", "n_decoys"))


STATE_OUT = T.StructType([
    T.StructField("actor", T.LongType()), T.StructField("n_rows", T.LongType()),
    T.StructField("n_decoys", T.LongType()), T.StructField("first_alarm_batch", T.IntegerType()),
])
def running_first_alarm(hits: DataFrame) -> DataFrame:
    """Running totals and first alarming batch per actor (update mode).

    The running state per actor is (count, sum, min), which is Spark's own
    stateful streaming aggregation: each micro-batch is combined map-side
    before the state store, so an actor holding a third of the accesses is
    pre-aggregated, never streamed row by row through one task."""
    hit = F.col("hit_zone").isNotNull()
    return hits.groupBy(F.col("actor").cast("bigint").alias("actor")).agg(
        F.count(F.lit(1)).cast("bigint").alias("n_rows"),
        F.sum(F.when(hit, 1).otherwise(0)).cast("bigint").alias("n_decoys"),
        F.min(F.when(hit, F.col("batch"))).cast("int").alias("first_alarm_batch"))


def expiring_first_alarm(hits: DataFrame, silence: str = "2 days", delay: str = "1 hour") -> DataFrame:
    """T3 with event-time timers: running totals and first alarming batch per
    actor, emitted once when the watermark passes the actor's last access plus
    ``silence``; the state is removed then, so the store holds live actors only.
    An actor that comes back starts anew. An actor's stay is a session window of
    that gap, merged before the shuffle."""
    hits.sparkSession.conf.set("spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition", "true")
    hit = F.col("hit_zone").isNotNull()
    return (hits.withWatermark("ts", delay)
            .groupBy(F.session_window("ts", silence).alias("s"), F.col("actor").cast("bigint").alias("actor"))
            .agg(F.count(F.lit(1)).cast("bigint").alias("n_rows"),
                 F.sum(F.when(hit, 1).otherwise(0)).cast("bigint").alias("n_decoys"),
                 F.min(F.when(hit, F.col("batch"))).cast("int").alias("first_alarm_batch"))
            .select("actor", F.col("s.start").alias("first_ts"), F.col("s.end").alias("expired_at"),
                    "n_rows", "n_decoys", "first_alarm_batch"))


def run_windows_with_late(hits: DataFrame, base: str, window: str = "1 day", delay: str = "1 hour") -> str:
    """T2 with a side output: run all available input and return the folder of
    partial counts (actor, window_start, window_end, late, n_rows, n_decoys, max_ts).

    An access is late when its window had closed before its micro-batch: the
    window's end is not after the greatest event time of all earlier batches
    less ``delay``, the watermark of ``windowed_alarms``, which drops such rows
    uncounted. Null event times have no window and are late. Each batch is one
    aggregation with map-side partial sums that overwrites its own folder, so a
    replay replaces it; ``base`` also holds the checkpoint, and a later call
    with the same folder goes on where this one ended."""
    out = os.path.join(base, "out")
    hit = F.col("hit_zone").isNotNull()

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        mark = None
        if batch_id:
            # one row: the greatest event time before this batch, never from its own earlier attempt
            mark = read_output(spark, out, PARTS).filter(F.col("mb") < batch_id).agg(F.max("max_ts")).first()[0]
        limit = F.lit(mark).cast("timestamp") - F.expr(f"INTERVAL {delay}")
        timed = batch.filter("ts IS NOT NULL").withColumn("w", F.window("ts", window))
        untimed = batch.filter("ts IS NULL").withColumn("w", F.lit(None).cast(timed.schema["w"].dataType))
        (timed.unionByName(untimed)
         .groupBy("actor", F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"))
         .agg(F.count(F.lit(1)).cast("bigint").alias("n_rows"),
              F.sum(F.when(hit, 1).otherwise(0)).cast("bigint").alias("n_decoys"), F.max("ts").alias("max_ts"))
         .withColumn("late", F.coalesce(F.col("window_end") <= limit, F.col("window_end").isNull()))
         .write.mode("overwrite").parquet(os.path.join(out, f"mb={batch_id}")))

    _run(hits, write, os.path.join(base, "checkpoint"), "append")
    return out


def windows_and_late(spark: SparkSession, out: str) -> DataFrame:
    """Per actor and window: rows and hits in time, and those that came late."""
    d = read_output(spark, out, PARTS)
    part = lambda c, late: F.sum(F.when(F.col("late") == late, F.col(c)).otherwise(0)).cast("bigint")
    return d.groupBy("actor", "window_start", "window_end").agg(
        part("n_rows", False).alias("n_rows"), part("n_decoys", False).alias("n_decoys"),
        part("n_rows", True).alias("n_late"), part("n_decoys", True).alias("n_late_decoys"))


PARTS = "actor bigint, window_start timestamp, window_end timestamp, n_rows bigint, n_decoys bigint, max_ts timestamp, late boolean"


def _run(df: DataFrame, write, checkpoint: str, mode: str) -> None:
    (df.writeStream.outputMode(mode).foreachBatch(write).option("checkpointLocation", checkpoint)
     .trigger(availableNow=True).start().awaitTermination())


def run_to_files(df: DataFrame, name: str, mode: str = "append") -> str:
    """Run a streaming DataFrame over all available input (``availableNow``)
    and return the folder with its output (one ``mb=<id>`` sub-folder per micro-batch)."""
    base = stream_dir(df.sparkSession, name)
    out = os.path.join(base, "out")

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(os.path.join(out, f"mb={batch_id}"))

    _run(df, write, os.path.join(base, "checkpoint"), mode)
    return out


def read_output(spark: SparkSession, out: str, schema: T.StructType) -> DataFrame:
    """The stream's output; empty (with ``schema``) when no batch wrote rows."""
    from pyspark.errors import AnalysisException
    try:
        return spark.read.parquet(out)
    except AnalysisException:
        return spark.createDataFrame([], schema).withColumn("mb", F.lit(0))


def latest_per_key(df: DataFrame, key: str) -> DataFrame:
    """Final state of an update-mode output: the row of each key's last batch."""
    cols = [c for c in df.columns if c not in (key, "mb")]
    return df.groupBy(key).agg(*[F.max_by(c, F.col("mb")).alias(c) for c in cols])

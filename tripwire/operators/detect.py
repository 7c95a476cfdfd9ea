"""Detection over accesses: hits, alarms, first alarm, zone profiles.

An access row is (who, when/batch, which row). The table rows are hashed and
probed once, accesses join the few positions that hit; everything after is
aggregation with map-side partial aggregation, so an actor holding a third of
all accesses costs one partial-aggregate row per task, not a hot task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripwire.functions.draws import draw_key
from tripwire.functions.hashing import hash_rows
from tripwire.operators.lookup import HIT, batch_check, is_decoy
from tripwire.operators.ranking import first_n, global_rank
from tripwire.schema import CONTENT_CENTS, zone_order


def probe(rows: DataFrame, lookup: DataFrame, salt: str, pos_col: str = "pos",
          content: Sequence[str] = CONTENT_CENTS) -> DataFrame:
    """The rows an alarm can come from: ``(pos, is_decoy, hit_zone)`` of every
    table row that hits the lookup or is a decoy. Each table row is hashed and
    probed once, not once per access; the result is as small as the decoys."""
    keep = [pos_col, *content] + [c for c in ("is_decoy",) if c in rows.columns]
    found = is_decoy(hash_rows(rows.select(*keep), content, salt), lookup)
    truth = F.col("is_decoy") if "is_decoy" in rows.columns else F.lit(False)
    return found.filter(F.col(HIT).isNotNull() | truth).select(pos_col, truth.alias("is_decoy"), HIT)


def access_hits(access: DataFrame, rows: DataFrame, lookup: DataFrame, salt: str, pos_col: str = "pos",
                content: Sequence[str] = CONTENT_CENTS) -> DataFrame:
    """Every access with ``is_decoy`` and ``hit_zone``. An access to an ordinary
    or unknown position has no hit, and is counted like any other."""
    return join_hits(access, probe(rows, lookup, salt, pos_col, content), pos_col)


def join_hits(access: DataFrame, probed: DataFrame, pos_col: str = "pos") -> DataFrame:
    """Accesses left-joined with the probed positions: one shuffle of the log,
    or none where AQE finds the probed side small; a hot position is split by AQE."""
    return access.join(probed, pos_col, "left").withColumn("is_decoy", F.coalesce("is_decoy", F.lit(False)))


def first_alarm(hits: DataFrame, actor: str = "actor", batch: str = "batch",
                hit_col: str = HIT) -> DataFrame:
    """D3+D4 (flagship): per actor – rows read, decoy hits, first alarming batch
    (later batches still counted), batches seen, overall decoy ratio."""
    hit = F.col(hit_col).isNotNull()
    per_batch = hits.groupBy(actor, batch).agg(
        F.count(F.lit(1)).alias("_n"), F.sum(F.when(hit, 1).otherwise(0)).alias("_h"))
    return per_batch.groupBy(actor).agg(
        F.sum("_n").cast("bigint").alias("n_rows"),
        F.sum("_h").cast("bigint").alias("n_decoys"),
        F.min(F.when(F.col("_h") > 0, F.col(batch))).alias("first_alarm_batch"),
        F.count(F.lit(1)).cast("bigint").alias("n_batches"),
    ).withColumn("decoy_ratio", F.round(F.col("n_decoys") / F.col("n_rows"), 9))


def batch_report(hits: DataFrame, batch_cols: Sequence[str], hit_col: str = HIT) -> DataFrame:
    """J6 keyed by batch, with the zone map as sorted JSON text."""
    return (batch_check(hits, batch_cols, hit_col)
            .withColumn("zones_hit", F.to_json("zones_hit"))
            .withColumn("decoy_ratio", F.round("decoy_ratio", 9)))


def zone_totals(hits: DataFrame, by: Sequence[str] = (), hit_col: str = HIT) -> DataFrame:
    """Hits per zone (long form ``by..., zone, n_hits``)."""
    return (hits.filter(F.col(hit_col).isNotNull())
            .groupBy(*by, F.col(hit_col).alias("zone"))
            .agg(F.count(F.lit(1)).cast("bigint").alias("n_hits")))


def actor_profile(hits: DataFrame, actor: str = "actor", hit_col: str = HIT) -> DataFrame:
    """The zone an actor hit most (tie -> earliest zone order), its share,
    and how many zones were hit."""
    z = zone_totals(hits, [actor], hit_col)
    return z.groupBy(actor).agg(
        F.max_by(F.col("zone"), F.struct(F.col("n_hits"), -zone_order(F.col("zone")))).alias("dominant_zone"),
        F.max("n_hits").cast("bigint").alias("dominant_hits"),
        F.sum("n_hits").cast("bigint").alias("n_hits"),
        F.count(F.lit(1)).cast("bigint").alias("n_zones"),
    ).withColumn("dominant_share", F.round(F.col("dominant_hits") / F.col("n_hits"), 9))


def lookup_recall(hits: DataFrame, by: Sequence[str] = ("actor",), hit_col: str = HIT) -> DataFrame:
    """Ground-truth decoys read vs lookup hits (recall of the lookup)."""
    truth = F.sum(F.col("is_decoy").cast("int")).cast("bigint")
    found = F.sum(F.when(F.col(hit_col).isNotNull(), 1).otherwise(0)).cast("bigint")
    return (hits.groupBy(*by).agg(truth.alias("n_true_decoys"), found.alias("n_hits"))
            .withColumn("recall", F.when(F.col("n_true_decoys") > 0,
                                         F.round(F.col("n_hits") / F.col("n_true_decoys"), 9))))


def incremental_batches(df: DataFrame, key: str, seed, n_batches: int, batch_size: int) -> DataFrame:
    """Non-overlapping uniform batches of ``batch_size`` (at most
    ``n_batches``; a final partial batch is never formed) = consecutive slices
    of one seeded permutation. Adds ``batch`` (1-based)."""
    size = F.lit(int(batch_size))
    chosen = first_n(df, key, seed,
                     lambda tot: F.least(F.lit(int(n_batches)), F.floor(tot / size)) * size)
    ranked = global_rank(chosen, draw_key(key, seed), [key], out="_r")
    return ranked.withColumn("batch", (F.floor((F.col("_r") - 1) / size) + 1).cast("int")).drop("_r")

"""Decoy lookup table: register, membership, batch checks.

The lookup is a two-column DataFrame ``(row_hash, zone)``; it is joined, never
collected. Its size grows with the number of decoys, so it is not broadcast
blindly: AQE converts the join to a broadcast hash join when the materialised
lookup is under ``spark.sql.adaptive.autoBroadcastJoinThreshold`` and keeps a
shuffled join (with skew splitting) beyond it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripwire.functions.hashing import hash_rows  # noqa: F401 - part of the lookup interface
from tripwire.schema import ZONES

HIT = "hit_zone"


def register(decoys: DataFrame, hash_col: str = "row_hash", zone_col: str = "zone",
             order: Sequence[str] = tuple(ZONES)) -> DataFrame:
    """Hash -> zone; when a hash is registered by several zones the one
    registered last wins: ``order`` is the caller's order of zones, other names
    come after it in alphabetical order, NULL before all.

    One aggregate with a map-side combine; no zone name is collected.
    """
    z = F.col(zone_col)
    place = F.array_position(F.array(*[F.lit(o) for o in order]), z) if order else F.lit(0)
    last = F.when(z.isNotNull(), F.struct(F.when(place > 0, place).otherwise(F.lit(len(order) + 1)).alias("place"), z.alias("zone")))
    return decoys.groupBy(hash_col).agg(F.max(last).alias("_z")).select(hash_col, F.col("_z.zone").alias(zone_col))


def registrations(decoys: DataFrame, zone_col: str = "zone") -> DataFrame:
    """Registration counter per zone (counts registrations, not distinct hashes)."""
    return decoys.groupBy(zone_col).agg(F.count(F.lit(1)).cast("bigint").alias("n_registered"))


def lookup_summary(decoys: DataFrame, hash_col: str = "row_hash", zone_col: str = "zone") -> DataFrame:
    """Per zone, registrations and distinct hashes finally held by that zone."""
    final = register(decoys, hash_col, zone_col).groupBy(zone_col).agg(
        F.count(F.lit(1)).cast("bigint").alias("n_hashes"))
    return registrations(decoys, zone_col).join(final, zone_col, "full").select(
        zone_col, F.coalesce("n_registered", F.lit(0)).cast("bigint").alias("n_registered"),
        F.coalesce("n_hashes", F.lit(0)).cast("bigint").alias("n_hashes"))


def is_decoy(rows: DataFrame, lookup: DataFrame, hash_col: str = "row_hash",
             zone_col: str = "zone", out: str = HIT) -> DataFrame:
    """Left join on the hash; ``hit_zone`` is NULL for rows not in the lookup."""
    lk = lookup.select(F.col(hash_col), F.col(zone_col).alias(out))
    return rows.join(lk, hash_col, "left")


def false_hits(rows: DataFrame, lookup: DataFrame, hash_col: str = "row_hash") -> DataFrame:
    """Rows (assumed real) that nevertheless match a registered hash."""
    return rows.join(lookup.select(hash_col), hash_col, "left_semi")


def clean_rows(rows: DataFrame, lookup: DataFrame, hash_col: str = "row_hash") -> DataFrame:
    """J8 complement: rows with no registered hash."""
    return rows.join(lookup.select(hash_col), hash_col, "left_anti")


def batch_check(hits: DataFrame, batch_cols: Sequence[str], hit_col: str = HIT) -> DataFrame:
    """Per batch – rows, decoy hits (duplicates count), alarm, zone->count map,
    decoy ratio. Two-level aggregation: (batch, zone) counts with map-side
    partial aggregation, then one small row per batch (<= #zones entries)."""
    batch_cols = list(batch_cols)
    per_zone = hits.groupBy(*batch_cols, hit_col).agg(F.count(F.lit(1)).alias("_n"))
    z = F.col(hit_col)
    agg = per_zone.groupBy(*batch_cols).agg(
        F.sum("_n").cast("bigint").alias("n_rows"),
        F.sum(F.when(z.isNotNull(), F.col("_n")).otherwise(0)).cast("bigint").alias("n_decoys"),
        F.sort_array(F.collect_list(F.when(z.isNotNull(), F.struct(z.alias("zone"), F.col("_n").cast("bigint").alias("n"))))).alias("_zones"),
    )
    return agg.select(
        *batch_cols, "n_rows", "n_decoys",
        (F.col("n_decoys") > 0).alias("alarm"),
        F.when(F.col("n_rows") > 0, F.col("n_decoys") / F.col("n_rows")).otherwise(F.lit(0.0)).alias("decoy_ratio"),
        F.map_from_entries("_zones").alias("zones_hit"),
    )

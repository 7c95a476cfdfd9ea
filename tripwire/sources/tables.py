"""Readers for the driver tables and the file-based sources/sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tripwire.schema import LEDGER_SCHEMA


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One driver table (parquet). Column pruning/pushdown happen at the scan."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def read_ledger_csv(spark: SparkSession, path: str) -> DataFrame:
    """Ledger CSV with header and the explicit ledger schema (never inferred)."""
    return spark.read.schema(LEDGER_SCHEMA).option("header", True).csv(path)

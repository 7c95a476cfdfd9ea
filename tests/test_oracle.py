"""Spark queries vs their DuckDB oracles on the smallest scale factor."""

import math
from decimal import Decimal

import duckdb
import pytest

from .conftest import SF001

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]

FAST = ["fraud_rate", "feature_matrix", "stratified_split", "sample_exact", "high_value_rows",
        "row_hash", "lookup_register", "lookup_summary", "is_decoy", "first_alarm", "batch_check",
        "actor_profile", "incremental_check", "auc_roc", "average_precision", "ks_stat", "kl_div",
        "quality_report", "zone_random", "boundary_rows", "detection_rate", "flood_response",
        "density_sweep", "shuffle_rank", "stream_window_alarm"]


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    return c


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else float(f"{v:.9g}")
    if isinstance(v, Decimal):
        return float(v)
    return v


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=lambda r: tuple(map(str, r)))


@pytest.mark.parametrize("name", FAST)
def test_query_matches_oracle(spark, con, name):
    import __spark_entry__ as E
    df = E.queries()[name](spark, SF001)
    res = con.execute(E.oracle_sql()[name])
    ocols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(ocols)
    assert _rows(df.columns, [tuple(r) for r in df.collect()]) == _rows(ocols, res.fetchall())

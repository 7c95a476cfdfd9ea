"""Ledger schema and feature constants.

The lists marked FIXED VALUES must equal the reference behaviour for right
results (names, domains and order of the model features).
"""

from __future__ import annotations

from pyspark.sql import types as T

# ---- FIXED VALUES (must match the reference semantics) ---------------------
TYPE_DOMAIN = ["CASH_IN", "CASH_OUT", "DEBIT", "PAYMENT", "TRANSFER"]
RISKY_TYPES = ["TRANSFER", "CASH_OUT"]
DROP_COLS = ["nameOrig", "nameDest", "isFlaggedFraud"]
SOURCE_NUMERIC = ["step", "amount", "oldbalanceOrg", "newbalanceOrig",
                  "oldbalanceDest", "newbalanceDest"]
DERIVED = ["orig_balance_diff", "dest_balance_diff", "amount_to_orig_ratio",
           "amount_to_dest_ratio", "orig_zeroed", "is_risky_type"]
ZONES = ["random", "edge_case", "cluster", "high_value"]
RATIO_EPS = 1e-9
SEED = 42
TEST_SIZE = 0.2
VAL_SIZE = 0.1
DEFAULT_INJECTION_RATIO = 0.05
DENSITY_RATIOS = [0.01, 0.02, 0.05, 0.10, 0.15, 0.20]
DISCRIMINATOR_PASS = 0.65
KL_EDGES = 50
# ---------------------------------------------------------------------------

TYPE_COLUMNS = ["type_" + t for t in TYPE_DOMAIN]
FLAG_COLUMNS = ["orig_zeroed", "is_risky_type"]      # the 0/1 features of DERIVED
FEATURES = SOURCE_NUMERIC + DERIVED + TYPE_COLUMNS   # 17, canonical order
AMOUNT = "amount"
LABEL = "isFraud"
KEY = "tx_id"

MONEY = T.DecimalType(18, 2)

# Raw ledger file schema (never inferred).
LEDGER_SCHEMA = T.StructType([
    T.StructField("step", T.IntegerType()),
    T.StructField("type", T.StringType()),
    T.StructField("amount", MONEY),
    T.StructField("nameOrig", T.StringType()),
    T.StructField("oldbalanceOrg", MONEY),
    T.StructField("newbalanceOrig", MONEY),
    T.StructField("nameDest", T.StringType()),
    T.StructField("oldbalanceDest", MONEY),
    T.StructField("newbalanceDest", MONEY),
    T.StructField("isFraud", T.IntegerType()),
    T.StructField("isFlaggedFraud", T.IntegerType()),
])

# Columns of the integer-cent ledger that make up a row's content (hash input).
CONTENT_CENTS = ["step", "type", "amount_c", "oldbalanceOrg_c", "newbalanceOrig_c",
                 "oldbalanceDest_c", "newbalanceDest_c"]
MONEY_CENTS = {"amount": "amount_c", "oldbalanceOrg": "oldbalanceOrg_c",
               "newbalanceOrig": "newbalanceOrig_c", "oldbalanceDest": "oldbalanceDest_c",
               "newbalanceDest": "newbalanceDest_c"}


def zone_order(zone_col):
    """Registration order of the zones (later registrations win)."""
    from pyspark.sql import functions as F
    expr = F.lit(len(ZONES))            # unknown zones register after the known ones
    for i, z in enumerate(ZONES):
        expr = F.when(zone_col == z, F.lit(i)).otherwise(expr)
    return expr

"""DuckDB text of the fixture views, used as a CTE prelude by every oracle query.

The oracle is an independent statement of each operator's result in plain
SQL (global windows and all); the Spark side computes the same with the
scalable operators. Aggregates are cast to BIGINT/DOUBLE in both.
"""

from __future__ import annotations

SALT = "pepper"

ENCODE = ("concat(concat_ws(',', CAST(step AS VARCHAR), type, CAST(amount_c AS VARCHAR), "
          "CAST(oldbalanceOrg_c AS VARCHAR), CAST(newbalanceOrig_c AS VARCHAR), "
          "CAST(oldbalanceDest_c AS VARCHAR), CAST(newbalanceDest_c AS VARCHAR)), '" + SALT + "')")

def _features_sql(src: str) -> str:
    return """
 SELECT tx_id,
  CAST(step AS DOUBLE) AS step, CAST(amount AS DOUBLE) AS amount,
  CAST(oldbalanceOrg AS DOUBLE) AS oldbalanceOrg, CAST(newbalanceOrig AS DOUBLE) AS newbalanceOrig,
  CAST(oldbalanceDest AS DOUBLE) AS oldbalanceDest, CAST(newbalanceDest AS DOUBLE) AS newbalanceDest,
  CAST(newbalanceOrig - oldbalanceOrg + amount AS DOUBLE) AS orig_balance_diff,
  CAST(newbalanceDest - oldbalanceDest - amount AS DOUBLE) AS dest_balance_diff,
  CAST(amount AS DOUBLE) / (CAST(oldbalanceOrg AS DOUBLE) + 1e-9) AS amount_to_orig_ratio,
  CAST(amount AS DOUBLE) / (CAST(oldbalanceDest AS DOUBLE) + 1e-9) AS amount_to_dest_ratio,
  CAST(CASE WHEN newbalanceOrig = 0 THEN 1 ELSE 0 END AS DOUBLE) AS orig_zeroed,
  CAST(CASE WHEN type IN ('TRANSFER', 'CASH_OUT') THEN 1 ELSE 0 END AS DOUBLE) AS is_risky_type,
  CAST(CASE WHEN replace(type, '-', '_') = 'CASH_IN' THEN 1 ELSE 0 END AS DOUBLE) AS type_CASH_IN,
  CAST(CASE WHEN replace(type, '-', '_') = 'CASH_OUT' THEN 1 ELSE 0 END AS DOUBLE) AS type_CASH_OUT,
  CAST(CASE WHEN replace(type, '-', '_') = 'DEBIT' THEN 1 ELSE 0 END AS DOUBLE) AS type_DEBIT,
  CAST(CASE WHEN replace(type, '-', '_') = 'PAYMENT' THEN 1 ELSE 0 END AS DOUBLE) AS type_PAYMENT,
  CAST(CASE WHEN replace(type, '-', '_') = 'TRANSFER' THEN 1 ELSE 0 END AS DOUBLE) AS type_TRANSFER,
  isFraud
 FROM """ + src


VIEWS = [
    ("_lb", """
 SELECT o.o_orderkey AS tx_id,
  CAST(1 + (year(o.o_orderdate)*372 + month(o.o_orderdate)*31 + day(o.o_orderdate)) % 744 AS INTEGER) AS step,
  CASE o.o_orderpriority WHEN '1-URGENT' THEN 'TRANSFER' WHEN '2-HIGH' THEN 'CASH_OUT'
    WHEN '3-MEDIUM' THEN 'PAYMENT' WHEN '4-NOT SPECIFIED' THEN 'CASH-IN' ELSE 'DEBIT' END AS type,
  CAST((CAST(round(o.o_totalprice*100) AS BIGINT) - CAST(round(o.o_totalprice*100) AS BIGINT) % 50) / 50 AS BIGINT) AS amt_c,
  o.o_custkey AS orig, (o.o_custkey*7 + 3) % (SELECT count(*) FROM customer) AS dest,
  CASE WHEN c.c_acctbal > 0 THEN CAST(round(c.c_acctbal*100) AS BIGINT) ELSE 0 END AS ob_c,
  CASE WHEN d.c_acctbal > 0 THEN CAST(round(d.c_acctbal*100) AS BIGINT) ELSE 0 END AS od_c,
  o.o_orderstatus AS st
 FROM orders o JOIN customer c ON c.c_custkey = o.o_custkey
 JOIN customer d ON d.c_custkey = (o.o_custkey*7 + 3) % (SELECT count(*) FROM customer)"""),
    ("ledger", """
 SELECT tx_id, step, type, amt_c AS amount_c, concat('C', CAST(orig AS VARCHAR)) AS nameOrig,
  ob_c AS oldbalanceOrg_c, CASE WHEN ob_c > amt_c THEN ob_c - amt_c ELSE 0 END AS newbalanceOrig_c,
  concat('C', CAST(dest AS VARCHAR)) AS nameDest, od_c AS oldbalanceDest_c,
  od_c + CASE WHEN tx_id % 3 = 0 THEN 0 ELSE amt_c END AS newbalanceDest_c,
  CASE WHEN type IN ('TRANSFER','CASH_OUT') AND amt_c >= ob_c AND st = 'F' AND tx_id % 10 < 6 THEN 1 ELSE 0 END AS isFraud,
  CASE WHEN amt_c > 900000 THEN 1 ELSE 0 END AS isFlaggedFraud
 FROM _lb"""),
    ("raw_ledger", """
 SELECT tx_id, step, type, CAST(CAST(amount_c AS DECIMAL(18,0)) * 0.01 AS DECIMAL(18,2)) AS amount, nameOrig,
  CAST(CAST(oldbalanceOrg_c AS DECIMAL(18,0)) * 0.01 AS DECIMAL(18,2)) AS oldbalanceOrg,
  CAST(CAST(newbalanceOrig_c AS DECIMAL(18,0)) * 0.01 AS DECIMAL(18,2)) AS newbalanceOrig, nameDest,
  CAST(CAST(oldbalanceDest_c AS DECIMAL(18,0)) * 0.01 AS DECIMAL(18,2)) AS oldbalanceDest,
  CAST(CAST(newbalanceDest_c AS DECIMAL(18,0)) * 0.01 AS DECIMAL(18,2)) AS newbalanceDest,
  isFraud, isFlaggedFraud
 FROM ledger"""),
    ("pool", """
 SELECT tx_id + (SELECT count(*) FROM ledger) AS tx_id, step, type, amount_c + 1 + tx_id % 997 AS amount_c,
  oldbalanceOrg_c, newbalanceOrig_c, oldbalanceDest_c, newbalanceDest_c
 FROM (SELECT l.*, count(*) OVER () AS n_legit,
   row_number() OVER (ORDER BY md5(concat(CAST(tx_id AS VARCHAR), ':42')), tx_id) AS rn
   FROM ledger l WHERE isFraud = 0) q
 WHERE rn <= n_legit / 10"""),
    ("pool_zoned", """
 SELECT *, CASE tx_id % 4 WHEN 0 THEN 'random' WHEN 1 THEN 'edge_case' WHEN 2 THEN 'cluster' ELSE 'high_value' END AS zone,
  sha256(""" + ENCODE + """) AS row_hash
 FROM pool"""),
    ("lookup", """
 SELECT row_hash, arg_max(zone, CASE zone WHEN 'random' THEN 0 WHEN 'edge_case' THEN 1 WHEN 'cluster' THEN 2
   WHEN 'high_value' THEN 3 ELSE 4 END) AS zone
 FROM pool_zoned GROUP BY row_hash"""),
    ("injected", """
 SELECT u.*, row_number() OVER (ORDER BY tx_id) - 1 AS pos FROM (
  SELECT tx_id, step, type, amount_c, oldbalanceOrg_c, newbalanceOrig_c, oldbalanceDest_c, newbalanceDest_c,
   isFraud, false AS is_decoy, CAST(NULL AS VARCHAR) AS zone FROM ledger
  UNION ALL
  SELECT tx_id, step, type, amount_c, oldbalanceOrg_c, newbalanceOrig_c, oldbalanceDest_c, newbalanceDest_c,
   0 AS isFraud, true AS is_decoy, zone FROM pool_zoned) u"""),
    ("access_log", """
 SELECT e.event_id, e.user_id AS actor, e.ts, CAST(day(e.ts) AS INTEGER) AS batch,
  (e.event_id*7919) % (SELECT count(*) FROM injected) AS pos FROM events e"""),
    ("hits", """
 SELECT a.event_id, a.actor, a.ts, a.batch, a.pos, i.is_decoy, k.zone AS hit_zone
 FROM access_log a JOIN injected i ON a.pos = i.pos
 LEFT JOIN lookup k ON k.row_hash = sha256(concat(concat_ws(',', CAST(i.step AS VARCHAR), i.type,
   CAST(i.amount_c AS VARCHAR), CAST(i.oldbalanceOrg_c AS VARCHAR), CAST(i.newbalanceOrig_c AS VARCHAR),
   CAST(i.oldbalanceDest_c AS VARCHAR), CAST(i.newbalanceDest_c AS VARCHAR)), '""" + SALT + """'))"""),
    ("scores", """
 SELECT tx_id, isFraud AS label, amount_c % 1000 + 300 * isFraud AS score FROM ledger"""),
    ("features", _features_sql("raw_ledger")),
    ("pool_raw", """
 SELECT tx_id, step, type, CAST(CAST(amount_c AS DECIMAL(18,0)) * 0.01 AS DECIMAL(18,2)) AS amount,
  CAST(CAST(oldbalanceOrg_c AS DECIMAL(18,0)) * 0.01 AS DECIMAL(18,2)) AS oldbalanceOrg,
  CAST(CAST(newbalanceOrig_c AS DECIMAL(18,0)) * 0.01 AS DECIMAL(18,2)) AS newbalanceOrig,
  CAST(CAST(oldbalanceDest_c AS DECIMAL(18,0)) * 0.01 AS DECIMAL(18,2)) AS oldbalanceDest,
  CAST(CAST(newbalanceDest_c AS DECIMAL(18,0)) * 0.01 AS DECIMAL(18,2)) AS newbalanceDest,
  0 AS isFraud
 FROM pool"""),
    ("pool_features", _features_sql("pool_raw")),
]


def with_views(final_sql: str) -> str:
    """Prefix a final SELECT with every fixture view as a CTE (DuckDB only
    evaluates the ones referenced)."""
    ctes = ",\n".join(f"{name} AS ({body}\n)" for name, body in VIEWS)
    body = final_sql.strip()
    if body[:4].upper() == "WITH":
        return f"WITH {ctes},\n{body[4:].strip()}"
    return f"WITH {ctes}\n{body}"

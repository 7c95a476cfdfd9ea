"""Benchmark: headline queries on $BENCH_SF_DIR with local[$BENCH_CPUS].

Prints ONE JSON line: {"metric", "value", "unit", "queries", "sf"}. Each query
is executed in full through the ``noop`` sink (no collect). ``views`` is the
one-time build of the ledger / pool / injected tables every query reads.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "first_alarm", "batch_check", "actor_profile", "incremental_check", "detection_rate",
    "false_alarm_rate", "feature_matrix", "stratified_split", "zscore", "lookup_register",
    "is_decoy", "auc_roc", "average_precision", "ks_stat", "kl_div", "quality_report",
    "min_dist", "zone_high_value", "shuffle_rank", "flood_response", "iforest_score",
    "stream_first_alarm",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]
    from tripwire.session import local_session
    from tripwire.sources.fixtures import Views
    from tripwire.plans import QUERIES

    spark = local_session(master=f"local[{cpus}]", app="tripwire-bench")
    times: dict[str, float] = {}
    t0 = time.time()
    Views.get(spark, sf_dir)
    times["views"] = round(time.time() - t0, 3)
    for name in only or HEADLINE:
        t = time.time()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - t, 3)
        print(f"{name}: {times[name]}s", file=sys.stderr)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({"metric": "total_query_time", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": float(m.group(1)) if m else sf_dir}))
    spark.stop()


if __name__ == "__main__":
    main()

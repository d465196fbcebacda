"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query is executed in full with the ``noop`` sink (no collect).  One
cold pass, then two warm passes; the reported value per query is the
better warm pass (this machine's run-to-run noise is ~20 %).  Prints ONE
JSON line.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "join_building", "site_hour_profile", "describe", "missing_readings_report", "presence_map",
    "resample_mean", "correlation_matrix", "reindex_time", "interpolate_linear", "weather_pipeline",
    "weather_pipeline_cubic", "holiday_flag", "feature_pipeline", "eda_clean", "building_clean",
    "rare_label_encode", "transform_features", "validate_inputs", "selection_votes",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "4")
    from wattlake.session import get_session
    from wattlake.plans.registry import queries
    spark = get_session(f"local[{cpus}]", shuffle_partitions=max(2, int(cpus) * 2))
    qs = queries()
    names = [n for n in (sys.argv[1:] or HEADLINE) if n in qs]
    cold, warm = {}, {}
    for name in names:
        t0 = time.time()
        qs[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        cold[name] = round(time.time() - t0, 3)
    for _ in range(2):
        for name in names:
            t0 = time.time()
            qs[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            dt = round(time.time() - t0, 3)
            warm[name] = min(dt, warm.get(name, dt))
    m = re.search(r"sf([0-9.]+)", sf_dir)
    out = {"metric": "warm_total_seconds", "value": round(sum(warm.values()), 3), "unit": "sec",
           "queries": warm, "cold": cold, "cold_total": round(sum(cold.values()), 3),
           "sf": float(m.group(1)) if m else sf_dir, "cpus": int(cpus)}
    print(json.dumps(out))


if __name__ == "__main__":
    main()

"""Benchmark: run the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Prints ONE JSON line: {"metric", "value", "unit", "queries": {name: sec}, "sf"}.
Each query is executed in full through the ``noop`` sink (nothing is
collected to the driver); the value is the sum of the per-query times.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from riskframe.plans import catalog  # noqa: E402
from riskframe.session import local_session  # noqa: E402

HEADLINE = [
    "scorecard_by_segment",
    "profile_applications",
    "categorical_distribution_applications",
    "crosstabs_applications",
    "sample_exact_applications",
    "stratified_split_shares",
    "binary_metrics_models",
    "roc_curve_models",
    "ks_drift_lines",
    "group_bias_cards",
    "numeric_summary_lines",
    "correlations_lines",
    "chi2_applications",
    "check_outliers_events",
    "expectations_cards",
    "prediction_metrics_hourly",
    "acf_events",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cores=cpus, shuffle_partitions=int(cpus) * 2 if cpus.isdigit() else 16,
                          app_name="riskframe-bench")
    qs = catalog.queries()
    names = [n for n in HEADLINE if n in qs]
    # warm-up: JVM, codegen caches and file listing on a small run
    qs[names[0]](spark, sf_dir).write.format("noop").mode("overwrite").save()
    times = {}
    for name in names:
        t0 = time.perf_counter()
        qs[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": float(m.group(1)) if m else sf_dir}))


if __name__ == "__main__":
    main()

"""Benchmark the headline queries; prints ONE JSON line.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_RUNS (default 2). The first run of each query is cold (JIT, codegen); the reported
time is the median of the warm runs, the cold times are listed under ``cold``.
Each query is executed in full with the ``noop`` sink (no collect to the driver).
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "delist_within_years",    # J10: IPO x delist within 5 years
    "latest_per_firm",        # W2: interval join + latest per firm
    "ipo_from_company",       # W1b: link + validity joins + first per firm
    "panel_build",            # J4-J9, S4, W5-W8, X9: the whole panel fetch
    "merge_clean",            # U1, W9, F13-F16: union, fill, clean
    "yearly_features",        # flagship: A1-A7, W4, J12, J13
    "firm_level_split",       # W3, W11, J14
    "boxplot_stats",          # A13: exact quartiles by class
    "correlation_matrix",     # A11
    "model_fit_run",          # M1-M9: split, fit, metrics
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = max(1, int(os.environ.get("BENCH_RUNS", "2")))
    scratch = tempfile.mkdtemp(prefix="panelkit-bench-")
    from panelkit.session import get_session
    spark = get_session(f"local[{cpus}]", app="panelkit-bench", shuffle_partitions=max(cpus, 4),
                        conf={"spark.driver.memory": "16g",
                              "spark.local.dir": scratch,
                              "spark.sql.files.maxPartitionBytes": str(64 * 1024 * 1024)})
    spark.sparkContext.setLogLevel("ERROR")
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(os.path.join(scratch, "checkpoints"))

    from panelkit.plans.registry import queries
    from panelkit.sources import fixtures as fx
    qs = queries()
    # Setup (timed separately): derive the vendor-table proxies from the driver tables
    # once and store them as parquet, as the real inputs would be; warms the JVM too.
    t0 = time.perf_counter()
    for build in (fx.ipo, fx.delist, fx.names, fx.link, fx.company, fx.panel, fx.funda,
                  fx.annual_linked, fx.fundq, fx.msf):
        build(spark, sf_dir)
    setup = round(time.perf_counter() - t0, 3)

    times: dict[str, float] = {}
    cold: dict[str, float] = {}
    jobs: dict[str, int] = {}
    tracker = spark.sparkContext.statusTracker()
    for name in HEADLINE:
        samples = []
        for run in range(runs):
            fx.reset_derived()      # every run recomputes its query from the tables
            group = f"bench-{name}-{run}"
            spark.sparkContext.setJobGroup(group, group)
            t0 = time.perf_counter()
            qs[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            samples.append(time.perf_counter() - t0)
            jobs[name] = len(tracker.getJobIdsForGroup(group))
        cold[name] = round(samples[0], 3)
        times[name] = round(statistics.median(samples[1:] if len(samples) > 1 else samples), 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({"metric": "headline_total_sec", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": float(m.group(1)) if m else None,
                      "cpus": cpus, "runs": runs, "setup_sec": setup, "cold": cold, "jobs": jobs,
                      "cold_total_sec": round(sum(cold.values()), 3)}))
    spark.stop()


if __name__ == "__main__":
    main()

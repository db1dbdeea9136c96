"""Benchmark the headline queries.

Runs each headline query on ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1)
with ``local[$BENCH_CPUS]`` and prints one JSON line. Each query is executed
in full through the ``noop`` sink (no driver collect); the reported time is
the median of ``$BENCH_RUNS`` runs (default 3) after one warm-up.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "page_to_answer",
    "html_tables",
    "combine_text",
    "facts_by_priority",
    "first_meaningful",
    "profile_record",
    "extract_urls",
    "route_contacts",
    "region_pick",
    "overview_blocks_answers",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    from vendorscope.plans.catalog import all_queries
    from vendorscope.session import build_session

    spark = build_session(f"local[{cpus}]", int(cpus) * 2,
                          extra={"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "8g")})
    qs = all_queries()
    times: dict[str, float] = {}
    failed: dict[str, str] = {}
    for name in HEADLINE:
        if name not in qs:
            continue
        samples = []
        try:
            for i in range(runs + 1):
                t0 = time.perf_counter()
                qs[name].build(spark, sf_dir).write.format("noop").mode("overwrite").save()
                if i:  # first run warms the JVM and the file cache
                    samples.append(time.perf_counter() - t0)
        except Exception as e:  # noqa: BLE001 - report and keep benchmarking the rest
            failed[name] = str(e).splitlines()[0][:200]
            continue
        times[name] = round(statistics.median(samples), 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    out = {"metric": "headline_total_sec", "value": round(sum(times.values()), 3), "unit": "sec",
           "queries": times, "sf": float(sf) if sf.replace(".", "").isdigit() else sf,
           "cpus": int(cpus), "runs": runs}
    if failed:
        out["failed"] = failed
    print(json.dumps(out), flush=True)
    spark.stop()


if __name__ == "__main__":
    main()

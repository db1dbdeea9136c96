"""Per-query wall time, output rows and shuffle bytes from Spark's event log.

usage: python tools/shuffle_profile.py [sf_dir] [key ...]
The event log is written to a fresh scratch folder (no UI, no server).
"""

from __future__ import annotations

import glob
import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    names = sys.argv[2:] or ["page_to_answer", "html_tables", "combine_text", "facts_by_priority",
                             "first_meaningful", "profile_record"]
    logdir = tempfile.mkdtemp(prefix="vs-eventlog-")
    cpus = os.environ.get("BENCH_CPUS", "4")
    from vendorscope.plans.catalog import all_queries
    from vendorscope.session import build_session
    spark = build_session(f"local[{cpus}]", int(cpus) * 2, extra={
        "spark.eventLog.enabled": "true", "spark.eventLog.dir": logdir, "spark.eventLog.compress": "false", "spark.driver.memory": "6g"})
    qs = all_queries()
    wall = {}
    for n in names:
        spark.sparkContext.setJobGroup("warm-up", "warm-up")
        qs[n].build(spark, sf).write.format("noop").mode("overwrite").save()
        spark.sparkContext.setJobGroup(n + ":count", n)
        rows = qs[n].build(spark, sf).count()
        spark.sparkContext.setJobGroup(n, n)
        t = time.perf_counter()
        qs[n].build(spark, sf).write.format("noop").mode("overwrite").save()
        wall[n] = (round(time.perf_counter() - t, 2), rows)
    spark.sparkContext.setJobGroup("done", "done")
    spark.stop()
    stage_group, shuffle = {}, {}
    for path in sorted(p for p in glob.glob(f"{logdir}/**", recursive=True) if os.path.isfile(p) and "appstatus" not in p):
        with open(path) as fh:
            for line in fh:
                ev = json.loads(line)
                kind = ev.get("Event")
                if kind == "SparkListenerJobStart":
                    g = (ev.get("Properties") or {}).get("spark.jobGroup.id")
                    for s in ev.get("Stage IDs", []):
                        stage_group[s] = g
                elif kind == "SparkListenerTaskEnd":
                    m = (ev.get("Task Metrics") or {}).get("Shuffle Write Metrics") or {}
                    g = stage_group.get(ev.get("Stage ID"))
                    shuffle[g] = shuffle.get(g, 0) + m.get("Shuffle Bytes Written", 0)
    for n in names:
        sec, rows = wall[n]
        print(json.dumps({"query": n, "wall_s": sec, "rows": rows, "rows_per_s": round(rows / sec),
                          "shuffle_mb": round(shuffle.get(n, 0) / 1e6, 3)}))


if __name__ == "__main__":
    main()

"""Stage and task times of chosen queries from Spark's event log (no web UI).

usage: python tools/stage_profile.py SF_DIR QUERY [QUERY ...]
Runs each query twice (cold, warm) with the event log in a fresh scratch folder,
then prints per-query wall time and the slowest stages with their task metrics.
"""

from __future__ import annotations

import collections
import glob
import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def _events(log_dir):
    import zstandard
    files = sorted(glob.glob(f"{log_dir}/*/events_*"), key=lambda p: int(p.split("events_")[1].split("_")[0]))
    for f in files:
        with open(f, "rb") as fh:
            text = zstandard.ZstdDecompressor().stream_reader(fh).read() if f.endswith(".zstd") else fh.read()
        for line in text.decode().splitlines():
            yield json.loads(line)


def main():
    sf, names = sys.argv[1], sys.argv[2:]
    log_dir = tempfile.mkdtemp(prefix="pl-eventlog-")
    from profitlens.catalog import QUERIES
    from profitlens.session import build_session
    spark = build_session("local[8]", 16, extra={"spark.eventLog.enabled": "true", "spark.eventLog.dir": log_dir})
    for name in names:
        for run in ("cold", "warm"):
            t0 = time.perf_counter()
            QUERIES[name](spark, sf).write.format("noop").mode("overwrite").save()
            print(f"{name} {run} {time.perf_counter() - t0:.2f}s", flush=True)
    spark.stop()
    stages, tasks = {}, collections.defaultdict(collections.Counter)
    for e in _events(log_dir):
        if e["Event"] == "SparkListenerStageCompleted":
            si = e["Stage Info"]
            stages[si["Stage ID"]] = (si.get("Completion Time", 0) - si.get("Submission Time", 0)) / 1000
        elif e["Event"] == "SparkListenerTaskEnd":
            m = e.get("Task Metrics") or {}
            c = tasks[e["Stage ID"]]
            c["tasks"] += 1
            c["run_ms"] += m.get("Executor Run Time", 0)
            c["gc_ms"] += m.get("JVM GC Time", 0)
            c["shuffle_read"] += (m.get("Shuffle Read Metrics") or {}).get("Total Records Read", 0)
            c["shuffle_write"] += (m.get("Shuffle Write Metrics") or {}).get("Shuffle Records Written", 0)
    print(f"stages={len(stages)} stage_seconds={sum(stages.values()):.1f}")
    for sid in sorted(stages, key=lambda s: -stages[s])[:10]:
        print(sid, f"{stages[sid]:.2f}s", dict(tasks[sid]))


if __name__ == "__main__":
    main()

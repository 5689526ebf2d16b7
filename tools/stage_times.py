"""Summarize a Spark event log: per job group of stages, run time, tasks,
input, shuffle read/write and spill - the numbers that show which shuffle
would dominate at scale.

usage: BENCH_EVENT_LOG_DIR=$(mktemp -d /tmp/run-XXXXXX) python bench.py
       python tools/stage_times.py <event log file or eventlog_v2_* folder> [top_n]
"""

from __future__ import annotations

import io
import json
import os
import sys
from collections import defaultdict


def _lines(path):
    """Event-log lines from a file or a Spark 4 rolling log directory
    (``events_<n>_*`` segments, optionally zstd-compressed)."""
    if os.path.isdir(path):
        segs = sorted((f for f in os.listdir(path) if f.startswith("events_")),
                      key=lambda f: int(f.split("_")[1]))
        for seg in segs:
            yield from _lines(os.path.join(path, seg))
        return
    if path.endswith(".zstd"):
        import zstandard
        with open(path, "rb") as raw:
            reader = zstandard.ZstdDecompressor().stream_reader(raw, read_across_frames=True)
            yield from io.TextIOWrapper(reader, encoding="utf-8")
        return
    with open(path) as f:
        yield from f


def main(argv):
    path = argv[0]
    top = int(argv[1]) if len(argv) > 1 else 15
    stages = {}
    metrics = defaultdict(lambda: defaultdict(int))
    if True:
        for line in _lines(path):
            ev = json.loads(line)
            kind = ev.get("Event")
            if kind == "SparkListenerStageCompleted":
                info = ev["Stage Info"]
                sid = (info["Stage ID"], info["Stage Attempt ID"])
                dur = (info.get("Completion Time", 0) or 0) - (info.get("Submission Time", 0) or 0)
                stages[sid] = (info["Stage Name"][:60], info["Number of Tasks"], dur)
            elif kind == "SparkListenerTaskEnd":
                m = ev.get("Task Metrics") or {}
                sid = (ev["Stage ID"], ev["Stage Attempt ID"])
                acc = metrics[sid]
                acc["input"] += (m.get("Input Metrics") or {}).get("Bytes Read", 0)
                sr = m.get("Shuffle Read Metrics") or {}
                acc["shuffle_read"] += sr.get("Remote Bytes Read", 0) + sr.get("Local Bytes Read", 0)
                acc["shuffle_write"] += (m.get("Shuffle Write Metrics") or {}).get("Shuffle Bytes Written", 0)
                acc["spill"] += m.get("Disk Bytes Spilled", 0)
    rows = sorted(stages.items(), key=lambda kv: -kv[1][2])[:top]
    print(f"{'stage':>8} {'ms':>7} {'tasks':>5} {'input':>10} {'shuf_rd':>10} {'shuf_wr':>10} {'spill':>8}  name")
    for sid, (name, tasks, dur) in rows:
        m = metrics[sid]
        print(f"{sid[0]:>8} {dur:>7} {tasks:>5} {m['input']:>10} {m['shuffle_read']:>10} "
              f"{m['shuffle_write']:>10} {m['spill']:>8}  {name}")
    total = defaultdict(int)
    for m in metrics.values():
        for k, v in m.items():
            total[k] += v
    print("totals:", dict(total), "stages:", len(stages))


if __name__ == "__main__":
    main(sys.argv[1:])

"""Summarise stage and task times from a Spark event log directory (no UI needed).

Usage: python scripts/stage_times.py <eventLog.dir>
"""

from __future__ import annotations

import glob
import io
import json
import os
import sys

import zstandard


def _lines(path):
    if path.endswith(".zstd"):
        with open(path, "rb") as fh:
            reader = zstandard.ZstdDecompressor().stream_reader(fh, read_across_frames=True)
            yield from io.TextIOWrapper(reader, encoding="utf-8")
    else:
        with open(path, encoding="utf-8") as fh:
            yield from fh


def main(root: str) -> None:
    files = sorted(f for f in glob.glob(os.path.join(root, "**", "*"), recursive=True)
                   if os.path.isfile(f) and "appstatus" not in f)
    stages, tasks = {}, {}
    for f in files:
        for line in _lines(f):
            e = json.loads(line)
            if e["Event"] == "SparkListenerStageCompleted":
                si = e["Stage Info"]
                stages[si["Stage ID"]] = (si["Stage Name"][:48], si["Number of Tasks"],
                                          si.get("Completion Time", 0) - si.get("Submission Time", 0))
            elif e["Event"] == "SparkListenerTaskEnd":
                tm = e.get("Task Metrics") or {}
                d = tasks.setdefault(e["Stage ID"], [0, 0, 0, 0, 0])
                d[0] += tm.get("Executor Run Time", 0)
                d[1] += tm.get("Executor CPU Time", 0) / 1e6
                d[2] += tm.get("JVM GC Time", 0)
                d[3] += (tm.get("Shuffle Write Metrics") or {}).get("Shuffle Bytes Written", 0)
                d[4] = max(d[4], tm.get("Executor Run Time", 0))
    print(f"{'stage':>5} {'tasks':>5} {'wall_ms':>8} {'run_ms':>8} {'cpu_ms':>8} {'gc_ms':>6} {'max_task':>8} "
          f"{'shuffle_w':>10}  name")
    for sid, (name, n, wall) in sorted(stages.items()):
        run, cpu, gc, sw, mx = tasks.get(sid, [0, 0, 0, 0, 0])
        print(f"{sid:>5} {n:>5} {wall:>8} {run:>8} {cpu:>8.0f} {gc:>6} {mx:>8} {sw:>10}  {name}")


if __name__ == "__main__":
    main(sys.argv[1])

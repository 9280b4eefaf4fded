"""Summarize a Spark event log (as written by ``BENCH_EVENT_LOG=1 python bench.py``):
stage count, total stage time and the slowest stages.

Usage: python tools/event_stages.py <event-log-dir> [top_n]
"""

from __future__ import annotations

import io
import json
import os
import sys


def read_events(path: str):
    for root, _, names in os.walk(path):
        for name in sorted(names):
            if not name.startswith("events_"):
                continue
            full = os.path.join(root, name)
            with open(full, "rb") as fh:
                if name.endswith(".zstd"):
                    import zstandard

                    text = io.TextIOWrapper(zstandard.ZstdDecompressor().stream_reader(fh), encoding="utf-8").read()
                else:
                    text = fh.read().decode("utf-8")
            for line in text.splitlines():
                try:
                    yield json.loads(line)
                except ValueError:
                    continue


def main() -> None:
    path = sys.argv[1]
    top = int(sys.argv[2]) if len(sys.argv) > 2 else 15
    stages = []
    for ev in read_events(path):
        if ev.get("Event") == "SparkListenerStageCompleted":
            si = ev["Stage Info"]
            dur = (si.get("Completion Time", 0) - si.get("Submission Time", 0)) / 1000
            stages.append((dur, si["Stage ID"], si["Number of Tasks"], si["Stage Name"][:80]))
    stages.sort(reverse=True)
    print(f"stages: {len(stages)}  total stage-seconds: {sum(s[0] for s in stages):.1f}  "
          f"under 0.2 s: {sum(1 for s in stages if s[0] < 0.2)}")
    for dur, sid, tasks, name in stages[:top]:
        print(f"{dur:7.2f}s  stage {sid:5d}  tasks {tasks:4d}  {name}")


if __name__ == "__main__":
    main()

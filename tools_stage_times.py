"""Summarise stage times from a Spark event log folder (written by bench.py
with BENCH_EVENT_LOG=<scratch folder>).

usage: python tools_stage_times.py <event log folder> [top_n]
"""

from __future__ import annotations

import glob
import json
import os
import sys


def _lines(path: str):
    if path.endswith(".zstd"):          # Spark's default event-log codec
        import io

        import zstandard
        with open(path, "rb") as fh:
            yield from io.TextIOWrapper(zstandard.ZstdDecompressor().stream_reader(fh), encoding="utf-8")
    else:
        with open(path, encoding="utf-8") as fh:
            yield from fh


def events(folder: str):
    files = [f for f in glob.glob(os.path.join(folder, "**", "events_*"), recursive=True) if os.path.isfile(f)]
    files += [f for f in glob.glob(os.path.join(folder, "*")) if os.path.isfile(f) and "." not in os.path.basename(f)]
    for f in sorted(set(files)):
        for line in _lines(f):
            if line.strip():
                yield json.loads(line)


def main():
    folder = sys.argv[1]
    top = int(sys.argv[2]) if len(sys.argv) > 2 else 15
    stages = []
    for e in events(folder):
        if e.get("Event") == "SparkListenerStageCompleted":
            si = e["Stage Info"]
            if "Submission Time" in si and "Completion Time" in si:
                stages.append((si["Completion Time"] - si["Submission Time"], si["Stage ID"], si["Number of Tasks"],
                               si["Stage Name"][:60]))
    total = sum(s[0] for s in stages)
    print(f"{len(stages)} stages, {total / 1000:.1f} s stage time in total")
    for ms, sid, ntask, name in sorted(stages, reverse=True)[:top]:
        print(f"{ms / 1000:7.2f} s  stage {sid:5d}  tasks {ntask:5d}  {name}")


if __name__ == "__main__":
    main()

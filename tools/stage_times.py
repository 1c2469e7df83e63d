"""Summarise stage times from a Spark event log (plain or zstd).

    python tools/stage_times.py <event-log-file> [--top N]

Enable the log with ``spark.eventLog.enabled=true`` and
``spark.eventLog.dir=<scratch folder>``; no UI or server is involved.
"""

from __future__ import annotations

import argparse
import io
import json


def read_events(path: str):
    if path.endswith(".zstd") or path.endswith(".zst"):
        import zstandard

        with open(path, "rb") as fh:
            stream = zstandard.ZstdDecompressor().stream_reader(fh)
            yield from (json.loads(line) for line in io.TextIOWrapper(stream, encoding="utf-8"))
    else:
        with open(path) as fh:
            yield from (json.loads(line) for line in fh)


def main() -> None:
    ap = argparse.ArgumentParser()
    ap.add_argument("path")
    ap.add_argument("--top", type=int, default=30)
    args = ap.parse_args()
    stages, jobs = [], 0
    for e in read_events(args.path):
        if e["Event"] == "SparkListenerStageCompleted":
            si = e["Stage Info"]
            dur = (si.get("Completion Time", 0) - si.get("Submission Time", 0)) / 1000
            stages.append((dur, si["Stage ID"], si["Number of Tasks"], si["Stage Name"][:70]))
        elif e["Event"] == "SparkListenerJobStart":
            jobs += 1
    print(f"jobs={jobs} stages={len(stages)} stage_seconds={sum(s[0] for s in stages):.2f}")
    for dur, sid, tasks, name in sorted(stages, reverse=True)[: args.top]:
        print(f"{dur:7.2f}s stage={sid:<4d} tasks={tasks:<4d} {name}")


if __name__ == "__main__":
    main()

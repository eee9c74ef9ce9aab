"""Per-job-group stage and task times from a Spark event log folder.

usage: python tools/stage_times.py <event-log-dir> [job-group ...]

Reads plain or zstd-compressed event logs (written with
spark.eventLog.enabled=true and spark.eventLog.dir=<scratch folder>) and
prints, per job group and stage: task count, max / median task time and the
summed task time - the numbers that show skew (max >> median).
"""

from __future__ import annotations

import glob
import io
import json
import os
import sys


def events(path: str):
    for f in sorted(glob.glob(os.path.join(path, "**", "*"), recursive=True)):
        if os.path.isdir(f) or "appstatus" in os.path.basename(f):
            continue
        raw = open(f, "rb").read()
        if f.endswith(".zstd"):
            import zstandard
            raw = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(raw)).read()
        for line in raw.decode("utf-8", "replace").splitlines():
            try:
                yield json.loads(line)
            except ValueError:
                continue


def main() -> None:
    path, want = sys.argv[1], set(sys.argv[2:])
    group, tasks = {}, {}
    for ev in events(path):
        kind = ev.get("Event")
        if kind == "SparkListenerJobStart":
            g = ev.get("Properties", {}).get("spark.jobGroup.id")
            for s in ev["Stage IDs"]:
                group[s] = g
        elif kind == "SparkListenerTaskEnd":
            ti = ev["Task Info"]
            tasks.setdefault(ev["Stage ID"], []).append(ti["Finish Time"] - ti["Launch Time"])
    for s in sorted(tasks):
        g = group.get(s)
        if want and g not in want:
            continue
        d = sorted(tasks[s])
        print(f"{g}\tstage {s}\ttasks {len(d)}\tmax_ms {d[-1]}\tp50_ms {d[len(d) // 2]}\tsum_ms {sum(d)}")


if __name__ == "__main__":
    main()

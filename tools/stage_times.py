"""Print per-stage wall time and task count from a Spark event log folder.

    python tools/stage_times.py <eventlog dir or file>
"""

from __future__ import annotations

import glob
import io
import json
import os
import sys

import zstandard


def _lines(path):
    with open(path, "rb") as fh:
        head = fh.read(4)
        fh.seek(0)
        if head == b"\x28\xb5\x2f\xfd":
            reader = zstandard.ZstdDecompressor().stream_reader(fh)
            yield from io.TextIOWrapper(reader, encoding="utf-8")
        else:
            yield from io.TextIOWrapper(fh, encoding="utf-8")


def main(path):
    files = sorted(glob.glob(os.path.join(path, "*"))) if os.path.isdir(path) else [path]
    stages, tasks = {}, {}
    for f in files:
        for line in _lines(f):
            e = json.loads(line)
            ev = e.get("Event")
            if ev == "SparkListenerStageCompleted":
                i = e["Stage Info"]
                stages[i["Stage ID"]] = (i["Stage Name"][:48], i["Number of Tasks"],
                                         i["Completion Time"] - i["Submission Time"])
            elif ev == "SparkListenerTaskEnd":
                t = e["Task Info"]
                tasks.setdefault(e["Stage ID"], []).append(t["Finish Time"] - t["Launch Time"])
    for sid, (name, n, ms) in sorted(stages.items()):
        tt = tasks.get(sid, [])
        print(f"stage {sid:4d} {ms:7d} ms  tasks={n:4d}  max_task={max(tt) if tt else 0:6d} ms  {name}")


if __name__ == "__main__":
    main(sys.argv[1])

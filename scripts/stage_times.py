"""Summarise stage durations from a Spark event log folder: python scripts/stage_times.py <eventlog dir>."""

from __future__ import annotations

import glob
import io
import json
import os
import sys


def _lines(path):
    if path.endswith(".zstd"):
        import zstandard
        with open(path, "rb") as fh:
            yield from io.TextIOWrapper(zstandard.ZstdDecompressor().stream_reader(fh), encoding="utf-8")
    else:
        with open(path, encoding="utf-8") as fh:
            yield from fh


def main(root: str, top: int = 15) -> None:
    stages = []
    for f in sorted(glob.glob(os.path.join(root, "**", "events_*"), recursive=True)):
        for line in _lines(f):
            e = json.loads(line)
            if e.get("Event") == "SparkListenerStageCompleted":
                si = e["Stage Info"]
                dur = (si.get("Completion Time", 0) - si.get("Submission Time", 0)) / 1000
                stages.append((round(dur, 2), si["Stage ID"], si["Number of Tasks"], si["Stage Name"][:80]))
    for s in sorted(stages, reverse=True)[:top]:
        print(s)
    print("stages", len(stages), "total stage seconds", round(sum(s[0] for s in stages), 1))


if __name__ == "__main__":
    main(sys.argv[1], int(sys.argv[2]) if len(sys.argv) > 2 else 15)

"""Summarise a Spark event log: slowest stages with task time, input and
shuffle bytes.  ``python tools/stage_report.py EVENT_LOG_DIR [top_n]``."""

from __future__ import annotations

import json
import os
import sys


def _lines(f: str):
    if f.endswith(".zstd"):
        import io
        import zstandard
        with open(f, "rb") as fh:
            text = io.TextIOWrapper(zstandard.ZstdDecompressor().stream_reader(fh), encoding="utf-8")
            yield from text
    else:
        with open(f) as fh:
            yield from fh


def stages(path: str):
    files = ([os.path.join(r, f) for r, _, fs in os.walk(path) for f in fs if not f.startswith(("appstatus", "."))]
             if os.path.isdir(path) else [path])
    out = {}
    for f in files:
        if True:
            for line in _lines(f):
                ev = json.loads(line)
                if ev.get("Event") != "SparkListenerStageCompleted":
                    continue
                info = ev["Stage Info"]
                acc = {a.get("Name"): a.get("Value") for a in info.get("Accumulables", [])}
                took = (info.get("Completion Time", 0) - info.get("Submission Time", 0)) / 1000.0
                out[(info["Stage ID"], info.get("Stage Attempt ID", 0))] = {
                    "stage": info["Stage ID"], "name": info.get("Stage Name", "")[:60],
                    "tasks": info.get("Number of Tasks"), "seconds": round(took, 3),
                    "input_mb": round(int(acc.get("internal.metrics.input.bytesRead", 0) or 0) / 2**20, 2),
                    "shuffle_write_mb": round(int(acc.get("internal.metrics.shuffle.write.bytesWritten", 0) or 0) / 2**20, 2),
                    "shuffle_read_mb": round(int(acc.get("internal.metrics.shuffle.read.remoteBytesRead", 0) or 0)
                                             / 2**20 + int(acc.get("internal.metrics.shuffle.read.localBytesRead", 0) or 0)
                                             / 2**20, 2),
                    "spill_mb": round(int(acc.get("internal.metrics.diskBytesSpilled", 0) or 0) / 2**20, 2),
                }
    return list(out.values())


def main():
    path = sys.argv[1]
    top = int(sys.argv[2]) if len(sys.argv) > 2 else 15
    rows = sorted(stages(path), key=lambda r: -r["seconds"])
    total = sum(r["seconds"] for r in rows)
    print(f"{len(rows)} stages, {total:.1f} s of stage time; spill {sum(r['spill_mb'] for r in rows):.1f} MB")
    for r in rows[:top]:
        print(json.dumps(r))


if __name__ == "__main__":
    main()

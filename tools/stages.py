"""Summarise a Spark event log: per stage, task count and task-time spread.

Usage: python tools/stages.py <event-log file or folder> [--top N]

Reads the event log Spark writes when ``spark.eventLog.enabled`` is set
(``TESSERA_EVENT_LOG_DIR`` makes ``tessera.session.build_session`` set it):
a single file or a rolling-log folder of ``events_N_*`` files, plain or
zstd-compressed.  A stage whose max task time is far above its median is
skewed.
"""

from __future__ import annotations

import io
import json
import os
import statistics
import sys
from collections import defaultdict


def _open(path: str):
    if path.endswith(".zstd") or path.endswith(".zst"):
        import zstandard
        raw = open(path, "rb")  # noqa: SIM115 - closed by the wrapper
        return io.TextIOWrapper(zstandard.ZstdDecompressor().stream_reader(raw), encoding="utf-8")
    return open(path, encoding="utf-8")  # noqa: SIM115


def _lines(path: str):
    if os.path.isdir(path):
        files = sorted((f for f in os.listdir(path) if f.startswith("events_")),
                       key=lambda f: int(f.split("_")[1]))
        paths = [os.path.join(path, f) for f in files]
    else:
        paths = [path]
    for p in paths:
        with _open(p) as f:
            yield from f


def summarise(path: str) -> list[dict]:
    tasks = defaultdict(list)
    names, records = {}, defaultdict(int)
    for line in _lines(path):
        ev = json.loads(line)
        kind = ev.get("Event")
        if kind == "SparkListenerStageCompleted":
            info = ev["Stage Info"]
            names[(info["Stage ID"], info["Stage Attempt ID"])] = info["Stage Name"]
        elif kind == "SparkListenerTaskEnd":
            ti = ev["Task Info"]
            key = (ev["Stage ID"], ev["Stage Attempt ID"])
            tasks[key].append(ti["Finish Time"] - ti["Launch Time"])
            m = ev.get("Task Metrics") or {}
            records[key] += (m.get("Input Metrics") or {}).get("Records Read", 0)
            records[key] += (m.get("Shuffle Read Metrics") or {}).get("Total Records Read", 0)
    return [{"stage": k[0], "attempt": k[1], "name": names.get(k, "?")[:60], "tasks": len(ts),
             "max_ms": max(ts), "median_ms": statistics.median(ts), "sum_ms": sum(ts),
             "records_in": records[k]}
            for k, ts in sorted(tasks.items())]


def main(argv: list[str]) -> None:
    rows = summarise(argv[0])
    top = int(argv[argv.index("--top") + 1]) if "--top" in argv else len(rows)
    for r in sorted(rows, key=lambda r: -r["sum_ms"])[:top]:
        print(f"stage {r['stage']:4d}.{r['attempt']} tasks {r['tasks']:4d} max {r['max_ms']:6d}ms "
              f"median {r['median_ms']:8.1f}ms sum {r['sum_ms']:7d}ms in {r['records_in']:9d}  {r['name']}")


if __name__ == "__main__":
    main(sys.argv[1:])

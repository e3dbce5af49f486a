"""Summarise stage and task times from a Spark event log.

Usage: python tools/event_log_summary.py <event-log-dir> [top]

Reads the JSON event log Spark writes with ``spark.eventLog.enabled=true``
and ``spark.eventLog.dir=<dir>`` and prints, per stage: number of tasks,
total and maximum task time, and the max/median ratio (a skew indicator),
sorted by total task time.
"""

from __future__ import annotations

import glob
import io
import json
import os
import statistics
import sys
from collections import defaultdict


def _lines(path: str):
    """Lines of a plain or zstd-compressed (Spark 4 default) event log file."""
    if path.endswith(".zstd"):
        import zstandard

        with open(path, "rb") as fh:
            data = zstandard.ZstdDecompressor().stream_reader(fh).read()
        yield from io.StringIO(data.decode("utf-8"))
    else:
        with open(path, encoding="utf-8") as fh:
            yield from fh


def main(argv: list[str]) -> None:
    root = argv[1].rstrip("/")
    # Spark writes either plain files or (rolling logs) one folder per app
    paths = sorted(p for p in glob.glob(root + "/**/*", recursive=True) if os.path.isfile(p))
    paths = [p for p in paths if not os.path.basename(p).startswith("appstatus")]
    top = int(argv[2]) if len(argv) > 2 else 15
    tasks: dict[tuple[int, int], list[float]] = defaultdict(list)
    names: dict[tuple[int, int], str] = {}
    for path in paths:
        for line in _lines(path):
            ev = json.loads(line)
            kind = ev.get("Event")
            if kind == "SparkListenerTaskEnd":
                info = ev["Task Info"]
                key = (ev["Stage ID"], ev["Stage Attempt ID"])
                tasks[key].append((info["Finish Time"] - info["Launch Time"]) / 1000.0)
            elif kind == "SparkListenerStageCompleted":
                si = ev["Stage Info"]
                names[(si["Stage ID"], si["Stage Attempt ID"])] = si["Stage Name"].split(" at ")[0]
    rows = []
    for key, times in tasks.items():
        med = statistics.median(times)
        rows.append((sum(times), key, len(times), max(times), (max(times) / med) if med > 0 else 0.0))
    rows.sort(reverse=True)
    print(f"stages: {len(rows)}, tasks: {sum(r[2] for r in rows)}, task seconds: {sum(r[0] for r in rows):.1f}")
    print("stage | name | tasks | total s | max s | max/median")
    for total, key, n, mx, skew in rows[:top]:
        print(f"{key[0]} | {names.get(key, '?')} | {n} | {total:.2f} | {mx:.2f} | {skew:.1f}")
    worst = max(rows, key=lambda r: r[4]) if rows else None
    if worst:
        print(f"largest max/median ratio: stage {worst[1][0]} ({worst[4]:.1f}, {worst[2]} tasks)")


if __name__ == "__main__":
    main(sys.argv)

"""Task metrics from a Spark event log, for tests and scale checks.

Spark writes the log when ``spark.eventLog.enabled`` is true, into
``spark.eventLog.dir``; it is complete once the session has stopped.
"""

from __future__ import annotations

import glob
import io
import json
import os


def _lines(path: str):
    raw = open(path, "rb")
    if path.endswith(".zstd"):
        import zstandard

        raw = zstandard.ZstdDecompressor().stream_reader(raw)
    yield from io.TextIOWrapper(raw, encoding="utf-8")


def task_stats(event_dir: str) -> dict[str | None, dict[str, int]]:
    """Per job group: shuffle bytes written, longest task, most shuffle records one task read."""
    stage_group: dict[int, str | None] = {}
    stats: dict[str | None, dict[str, int]] = {}
    for path in glob.glob(os.path.join(event_dir, "*", "events_*")) + glob.glob(os.path.join(event_dir, "local-*")):
        for line in _lines(path):
            e = json.loads(line)
            if e["Event"] == "SparkListenerJobStart":
                group = (e.get("Properties") or {}).get("spark.jobGroup.id")
                for stage in e["Stage IDs"]:
                    stage_group[stage] = group
            elif e["Event"] == "SparkListenerTaskEnd":
                m = e.get("Task Metrics") or {}
                info = e["Task Info"]
                s = stats.setdefault(
                    stage_group.get(e["Stage ID"]),
                    {"shuffle_bytes": 0, "max_task_ms": 0, "max_task_records": 0},
                )
                s["shuffle_bytes"] += (m.get("Shuffle Write Metrics") or {}).get("Shuffle Bytes Written", 0)
                s["max_task_ms"] = max(s["max_task_ms"], info["Finish Time"] - info["Launch Time"])
                s["max_task_records"] = max(
                    s["max_task_records"], (m.get("Shuffle Read Metrics") or {}).get("Total Records Read", 0)
                )
    return stats

"""bench.py keeps the driver's contract: one JSON line with the agreed keys."""

from __future__ import annotations

import json
import os
import subprocess
import sys

from tests.conftest import TESTDATA

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_bench_prints_one_json_line():
    env = {**os.environ, "BENCH_SF_DIR": f"{TESTDATA}/sf0.001", "BENCH_CPUS": "2", "BENCH_RUNS": "1", "BENCH_QUERIES": "revenue_by_region"}
    proc = subprocess.run(
        [sys.executable, os.path.join(REPO, "bench.py")],
        capture_output=True,
        text=True,
        timeout=600,
        env=env,
        cwd="/",
    )
    assert proc.returncode == 0, proc.stderr[-3000:]
    lines = [line for line in proc.stdout.splitlines() if line.strip()]
    assert len(lines) == 1
    out = json.loads(lines[0])
    assert {"metric", "value", "unit", "queries", "sf"} <= set(out) and (out["runs"], out["corpus_runs"]) == (1, 1)
    assert out["unit"] == "sec" and out["sf"] == 0.001
    assert set(out["queries"]) == {"revenue_by_region"}
    assert out["value"] == round(sum(out["queries"].values()), 4)

"""Hot keys stay out of single tasks, measured from Spark's task metrics.

A fresh Spark process (event logging needs its own session) derives a
skewed copy of the sf0.01 tables with ``scripts/scale_check.derive``: one
order gets a third of the line items and one customer a third of the
orders. It runs this plan and, as a control, the join-then-group SQL with
Spark's size-based broadcasts off and without AQE merging partitions. The
control shows that the metric sees skew: one of its tasks reads every line
item of the hot order. This plan must keep every task far below that.
"""

from __future__ import annotations

import json
import os
import subprocess
import sys

from scripts.eventlog import task_stats
from tests.conftest import TESTDATA

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

CHILD = """
import json, sys
sys.path.insert(0, sys.argv[1])
from pyspark.sql import functions as F
from keelson.session import local_session
from keelson.plans import revenue_by_region
from scripts.scale_check import derive, join_first

src, data, events = sys.argv[2:5]
spark = local_session(4, shuffle_partitions=16, extra_conf={
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    # One task per hash partition, so a task's records show the keys hashed
    # to it rather than how many small partitions AQE merged into it.
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
    "spark.eventLog.enabled": "true",
    "spark.eventLog.dir": events,
})
derive(spark, src, data, 4, True)
lineitem = spark.read.parquet(data + "/lineitem.parquet")
hot = lineitem.groupBy("l_orderkey").count().agg(F.max("count")).first()[0]
results = {}
for name, plan in (("keelson", revenue_by_region), ("join_first", join_first)):
    spark.sparkContext.setJobGroup(name, name)
    results[name] = sorted([list(r) for r in plan(spark, data).collect()])
spark.stop()
print(json.dumps({"hot": hot, "results": results}))
"""


def test_hot_keys_do_not_land_in_one_task(tmp_path):
    events = tmp_path / "events"
    events.mkdir()
    proc = subprocess.run(
        [sys.executable, "-c", CHILD, REPO, f"{TESTDATA}/sf0.01", str(tmp_path / "data"), str(events)],
        capture_output=True,
        text=True,
        timeout=600,
    )
    assert proc.returncode == 0, proc.stderr[-3000:]
    out = json.loads(proc.stdout.strip().splitlines()[-1])
    stats = task_stats(str(events))

    assert out["results"]["keelson"] == out["results"]["join_first"]
    hot = out["hot"]
    assert hot > 50_000  # a third of the 4 x 60,000 line items
    assert stats["join_first"]["max_task_records"] >= hot  # the control sees the skew
    assert stats["keelson"]["max_task_records"] < hot / 4

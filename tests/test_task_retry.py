"""Failed tasks are run again to the same result.

The first attempt of every line-item scan task fails after reading its
rows (``local[4,4]`` retries a task up to four times); the retried job must return
exactly the result of an undisturbed run. This covers failed map tasks
only: shuffle output lost with an executor is not simulated here.
"""

from __future__ import annotations

import json
import os
import subprocess
import sys

from tests.conftest import TESTDATA

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

CHILD = """
import json, sys
sys.path.insert(0, sys.argv[1])
from pyspark import TaskContext
from pyspark.sql import SparkSession
from keelson.plans import revenue_by_region, revenue_by_region_of
from keelson.sources import read_table

sf = sys.argv[2]
spark = (SparkSession.builder.master("local[4,4]").config("spark.ui.enabled", "false")
         .config("spark.sql.shuffle.partitions", "8").getOrCreate())
clean = sorted([list(r) for r in revenue_by_region(spark, sf).collect()])

def fail_first_attempt(batches):
    for batch in batches:
        yield batch
    if TaskContext.get().attemptNumber() == 0:
        raise RuntimeError("simulated loss of this task")

lineitem = read_table(spark, sf, "lineitem", "l_orderkey", "l_extendedprice", "l_discount")
flaky = lineitem.repartition(4).mapInPandas(fail_first_attempt, lineitem.schema)
tables = [read_table(spark, sf, n, *c) for n, c in (
    ("orders", ("o_orderkey", "o_custkey")), ("customer", ("c_custkey", "c_nationkey")),
    ("nation", ("n_nationkey", "n_regionkey")), ("region", ("r_regionkey", "r_name")))]
retried = sorted([[r.r_name, str(r.revenue), r.n_lines] for r in revenue_by_region_of(flaky, *tables).collect()])
spark.stop()
print(json.dumps({"clean": clean, "retried": retried}))
"""


def test_result_survives_failed_tasks():
    proc = subprocess.run(
        [sys.executable, "-c", CHILD, REPO, f"{TESTDATA}/sf0.01"],
        capture_output=True,
        text=True,
        timeout=600,
    )
    assert proc.returncode == 0, proc.stderr[-3000:]
    assert "simulated loss of this task" in proc.stderr  # the failures did happen
    out = json.loads(proc.stdout.strip().splitlines()[-1])
    assert out["retried"] == out["clean"]
    assert len(out["clean"]) == 5

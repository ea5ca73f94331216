"""Compare the registered plan with join-then-group on scaled-up tables.

The scaled tables are derived by Spark from the driver's tables: ``--copies``
copies of lineitem, orders and customer with keys offset per copy, so every
copy joins only to itself, once as they are and once skewed: a third of the
line items pointed at one order and a third of the orders at one customer. Spark's size-based
broadcasts are turned off, as they would be off for tables of this size
on a cluster.

Prints one JSON line per plan and data set: warm wall time, whether both
plans returned the same rows (the script fails if not), and from
Spark's event log the shuffle bytes written, the longest task and the most
shuffle records read by one task.

    python scripts/scale_check.py --src /root/testdata/sf0.1 --out DIR --copies 20
"""

from __future__ import annotations

import argparse
import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from scripts.eventlog import task_stats  # noqa: E402
from keelson.plans import REVENUE_BY_REGION_SQL, revenue_by_region  # noqa: E402
from keelson.session import local_session  # noqa: E402
from keelson.sources import read_table  # noqa: E402

ORDER_OFFSET = 10**9
CUSTOMER_OFFSET = 10**7


def derive(spark, src: str, out: str, copies: int, skew: bool) -> None:
    def copied(name):
        copy_numbers = F.sequence(F.lit(0).cast("long"), F.lit(copies - 1).cast("long"))
        return read_table(spark, src, name).withColumn("copy", F.explode(copy_numbers))

    lineitem = copied("lineitem").withColumn("l_orderkey", F.col("l_orderkey") + F.col("copy") * ORDER_OFFSET)
    orders = (
        copied("orders")
        .withColumn("o_orderkey", F.col("o_orderkey") + F.col("copy") * ORDER_OFFSET)
        .withColumn("o_custkey", F.col("o_custkey") + F.col("copy") * CUSTOMER_OFFSET)
    )
    customer = copied("customer").withColumn("c_custkey", F.col("c_custkey") + F.col("copy") * CUSTOMER_OFFSET)
    if skew:
        hot_order = orders.agg(F.min("o_orderkey")).first()[0]
        hot_customer = customer.agg(F.min("c_custkey")).first()[0]
        third = F.pmod(F.xxhash64("l_partkey", "l_suppkey", "l_linenumber", "copy"), F.lit(3)) == 0
        lineitem = lineitem.withColumn("l_orderkey", F.when(third, F.lit(hot_order)).otherwise(F.col("l_orderkey")))
        orders = orders.withColumn(
            "o_custkey",
            F.when(F.pmod(F.xxhash64("o_orderkey"), F.lit(3)) == 0, F.lit(hot_customer)).otherwise(F.col("o_custkey")),
        )
    for name, df in (("lineitem", lineitem), ("orders", orders), ("customer", customer)):
        df.drop("copy").repartition(16).write.mode("errorifexists").parquet(f"{out}/{name}.parquet")
    for name in ("nation", "region"):
        read_table(spark, src, name).write.mode("errorifexists").parquet(f"{out}/{name}.parquet")


def join_first(spark, sf_dir):
    for name in ("lineitem", "orders", "customer", "nation", "region"):
        read_table(spark, sf_dir, name).createOrReplaceTempView(name)
    return spark.sql(REVENUE_BY_REGION_SQL)


def main() -> None:
    ap = argparse.ArgumentParser()
    ap.add_argument("--src", default="/root/testdata/sf0.1")
    ap.add_argument("--out", required=True, help="new directory for derived tables and event logs")
    ap.add_argument("--copies", type=int, default=20)
    ap.add_argument("--cpus", type=int, default=8)
    args = ap.parse_args()
    os.makedirs(args.out, exist_ok=False)
    events = os.path.join(args.out, "events")
    os.makedirs(events)
    spark = local_session(
        args.cpus,
        shuffle_partitions=64,
        extra_conf={
            "spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.eventLog.enabled": "true",
            "spark.eventLog.dir": events,
        },
    )
    timings, same = {}, {}
    for skew in (False, True):
        variant = "skewed" if skew else "plain"
        data = os.path.join(args.out, variant)
        derive(spark, args.src, data, args.copies, skew)
        results = []
        for plan_name, plan in (("keelson", revenue_by_region), ("join_first", join_first)):
            group = f"{plan_name}-{variant}"
            plan(spark, data).collect()  # warm-up, not measured
            spark.sparkContext.setJobGroup(group, group)
            start = time.perf_counter()
            results.append(sorted(plan(spark, data).collect()))
            timings[group] = round(time.perf_counter() - start, 2)
            spark.sparkContext.setJobGroup("other", "other")
        same[variant] = results[0] == results[1]
    spark.stop()
    stats = task_stats(events)
    for group, seconds in timings.items():
        variant = group.split("-")[1]
        print(json.dumps({"run": group, "copies": args.copies, "warm_sec": seconds, "same_result": same[variant], **stats.get(group, {})}))
    if not all(same.values()):
        sys.exit("the two plans returned different results")


if __name__ == "__main__":
    main()

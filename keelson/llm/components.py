"""Connected components of a link table, without ever holding one in one place."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keelson.llm.common import dropped, stored

MAX_ROUNDS = 60


def components(links: DataFrame) -> DataFrame:
    """(v, root) for every vertex of the links (a, b); root is the smallest vertex reachable.

    Every round each vertex takes the least root among itself and its neighbours, then the
    root of that root, so paths shrink at least by half on a chain of hooks. Counts of neighbours are
    aggregated before the shuffle, and joins have stored tables on both sides, which lets
    AQE split a hub.
    """
    both = stored(links.select("a", "b").union(links.select("b", "a")).where("a != b").distinct().toDF("a", "b"), "cc-links")
    root = stored(both.groupBy(F.col("a").alias("v")).agg(F.least(F.min("b"), F.first("a")).alias("root")), "cc-root")
    for _ in range(MAX_ROUNDS):
        near = both.join(root.select(F.col("v").alias("a"), "root"), "a").groupBy(F.col("b").alias("v")).agg(F.min("root").alias("near"))
        hooked = stored(root.join(near, "v").select("v", F.least("root", "near").alias("root"), F.col("root").alias("old")), "cc-hook")
        of = hooked.select(F.col("v").alias("root"), F.col("root").alias("next"))
        jumped = stored(hooked.join(of, "root").select("v", F.least("root", "next").alias("root"), "old"), "cc-jump")
        changed = not jumped.where("root != old").isEmpty()
        dropped(root, hooked)
        root = jumped.select("v", "root")
        root._keelson_path = jumped._keelson_path
        if not changed:
            dropped(both)
            return root
    raise RuntimeError(f"no fixed point after {MAX_ROUNDS} rounds")

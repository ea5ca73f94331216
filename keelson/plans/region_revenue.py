"""Revenue and line count per customer region.

Meaning (the oracle SQL below): join every line item to its order, the
order to its customer, the customer to its nation and the nation to its
region; per region name, sum ``price * (1 - discount)`` in decimals, exactly,
and count the joined rows.

Plan. Joining first and grouping last would carry every line item through
three joins and shuffle all of them a second time, by customer, after the
order join. A customer or order holding a third of all rows would then put a
third of the data into one join task. Instead the plan sums before each
join, down to the key of the next one: line items per ``l_orderkey``, orders
per ``o_custkey``, customers per ``c_nationkey``, nations per ``n_regionkey``,
regions per ``r_name``. Every sum combines on the map side before its
shuffle, so no key is hot on the summed side of a join. No hint, probe or
size is involved: AQE turns the later joins into broadcasts from what it
has measured.

Sums and counts distribute over joins, duplicated keys included: a row
that meets k partners is summed k times either way. So the result equals
the join-then-group query for any data, with inner-join semantics (orphans
and null keys drop out) and SQL null handling (``sum`` skips nulls, the
count counts rows).

Contract for speed, not for the result: ``o_orderkey`` and ``c_custkey`` are
unique. A key that very many rows of orders or customer share stays
correct, but its join is one task, since AQE does not split a join whose other
side is an aggregate.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from keelson.functions import discounted
from keelson.sources import read_table

ORACLE_SQL = """
SELECT r_name,
       CAST(CAST(SUM(CAST(l_extendedprice AS DECIMAL(18,2))
                     * (1 - CAST(l_discount AS DECIMAL(18,2)))) AS DECIMAL(38,4)) AS STRING) AS revenue,
       CAST(COUNT(*) AS BIGINT) AS n_lines
FROM lineitem
JOIN orders   ON l_orderkey  = o_orderkey
JOIN customer ON o_custkey   = c_custkey
JOIN nation   ON c_nationkey = n_nationkey
JOIN region   ON n_regionkey = r_regionkey
GROUP BY r_name
"""


def _summed(df: DataFrame, key: str) -> DataFrame:
    return df.groupBy(key).agg(F.sum("revenue").alias("revenue"), F.sum("n_lines").alias("n_lines"))


def revenue_by_region_of(
    lineitem: DataFrame,
    orders: DataFrame,
    customer: DataFrame,
    nation: DataFrame,
    region: DataFrame,
) -> DataFrame:
    """r_name, revenue decimal(38,4) and n_lines over given DataFrames (tables or test fixtures)."""
    per_order = lineitem.groupBy("l_orderkey").agg(
        F.sum(discounted("l_extendedprice", "l_discount")).alias("revenue"),
        F.count(F.lit(1)).alias("n_lines"),
    )
    steps = (
        (orders, "l_orderkey", "o_orderkey", "o_custkey"),
        (customer, "o_custkey", "c_custkey", "c_nationkey"),
        (nation, "c_nationkey", "n_nationkey", "n_regionkey"),
        (region, "n_regionkey", "r_regionkey", "r_name"),
    )
    sums = per_order
    for table, summed_by, key, next_key in steps:
        joined = sums.join(table.select(key, next_key), F.col(summed_by) == F.col(key))
        sums = _summed(joined, next_key)
    return sums


def revenue_by_region(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The query over the parquet tables in ``sf_dir``, revenue as text.

    The text shows all four decimals of the exact total in any tool; a
    decimal may print as 1.2300 in one and 1.23 in another.
    """
    exact = revenue_by_region_of(
        read_table(spark, sf_dir, "lineitem", "l_orderkey", "l_extendedprice", "l_discount"),
        read_table(spark, sf_dir, "orders", "o_orderkey", "o_custkey"),
        read_table(spark, sf_dir, "customer", "c_custkey", "c_nationkey"),
        read_table(spark, sf_dir, "nation", "n_nationkey", "n_regionkey"),
        read_table(spark, sf_dir, "region", "r_regionkey", "r_name"),
    )
    return exact.withColumn("revenue", F.col("revenue").cast("string"))

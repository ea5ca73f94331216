"""Read the driver's parquet tables.

A table ``name`` under ``sf_dir`` is ``{sf_dir}/{name}.parquet``: a file
or a directory of part files, so the same call reads the single test
files and a partitioned copy on shared storage.

Tables with a declared schema are read with it. Spark then skips the job
that opens a file footer to infer the schema, and a file whose column
types differ fails at read time instead of changing the result type. (A
column missing from a file reads as null, as with any declared schema.)
"""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructField, StructType

# Column types of the driver's tables, as stored in its files.
SCHEMAS: dict[str, str] = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "orders": (
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
        "o_orderdate timestamp_ntz, o_orderpriority string"
    ),
    "lineitem": (
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
        "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
        "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"
    ),
}


@functools.cache
def _parsed(name: str) -> StructType:
    return StructType.fromDDL(SCHEMAS[name])


def table_schema(name: str, columns: tuple[str, ...] = ()) -> StructType:
    """The declared schema of ``name``, narrowed to ``columns`` if any are given."""
    full = _parsed(name)
    if not columns:
        return full
    by_name: dict[str, StructField] = {f.name: f for f in full.fields}
    missing = [c for c in columns if c not in by_name]
    if missing:
        raise KeyError(f"{name} has no column(s) {missing}")
    return StructType([by_name[c] for c in columns])


def read_table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """Scan one table, keeping only ``columns`` when any are given."""
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    if name in SCHEMAS:
        return spark.read.schema(table_schema(name, columns)).parquet(path)
    df = spark.read.parquet(path)
    return df.select(*columns) if columns else df

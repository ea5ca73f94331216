"""Physical plan shape, read from ``explain``.

``large_tables`` turns off Spark's own broadcast decisions, so the plan is
the one Spark picks when orders and customers are far too big to
broadcast, as at the target scale.
"""

from __future__ import annotations

import contextlib
import io
import re

import pytest

from keelson.plans import revenue_by_region, revenue_by_region_of
from keelson.sources import read_table
from tests.conftest import TESTDATA

SF = f"{TESTDATA}/sf0.01"


def plan_text(df) -> str:
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


@pytest.fixture
def large_tables(spark):
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    old = {k: spark.conf.get(k, None) for k in keys}
    for k in keys:
        spark.conf.set(k, "-1")
    yield
    for k, v in old.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


def initial_plan(text: str) -> str:
    """The operator tree AQE starts from (before any runtime change)."""
    if "== Initial Plan ==" in text:
        return text.split("== Initial Plan ==", 1)[1]
    return text


def test_scans_read_only_needed_columns(spark):
    text = plan_text(revenue_by_region(spark, SF))
    schemas = set(re.findall(r"ReadSchema: (struct<[^>]*>)", text))
    assert schemas == {
        "struct<l_orderkey:bigint,l_extendedprice:double,l_discount:double>",
        "struct<o_orderkey:bigint,o_custkey:bigint>",
        "struct<c_custkey:bigint,c_nationkey:int>",
        "struct<n_nationkey:int,n_regionkey:int>",
        "struct<r_regionkey:int,r_name:string>",
    }


def test_one_shuffle_per_key_at_scale(spark, large_tables):
    text = plan_text(revenue_by_region(spark, SF))
    shuffles = re.findall(r"Arguments: hashpartitioning\((\w+)#", text)
    # Each key is shuffled once: the sums keep their partitioning into the
    # join that follows them.
    sums = ["l_orderkey", "o_custkey", "c_nationkey", "n_regionkey", "r_name"]
    assert sorted(shuffles) == sorted([*sums, "o_orderkey", "c_custkey", "n_nationkey", "r_regionkey"])
    assert "SortMergeJoin" in text and "BroadcastExchange" not in text
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_sums_are_partial_before_every_aggregate_shuffle(spark, large_tables):
    text = plan_text(revenue_by_region(spark, SF))
    partial_keys = re.findall(r"HashAggregate.*\n.*\nKeys \[1\]: \[(\w+)#[^\n]*\nFunctions \[2\]: \[partial_", text)
    assert sorted(partial_keys) == sorted(["l_orderkey", "o_custkey", "c_nationkey", "n_regionkey", "r_name"])


def test_building_the_query_starts_no_job(spark):
    sc = spark.sparkContext
    sc.setJobGroup("build-test", "build-test")
    try:
        revenue_by_region(spark, SF)
    finally:
        sc.setJobGroup("other", "other")
    assert list(sc.statusTracker().getJobIdsForGroup("build-test")) == []


def test_bucketed_tables_need_no_shuffle_on_the_order_key(spark, large_tables, tmp_path):
    """lineitem and orders bucketed by order key meet without an exchange, same result."""
    names = {}
    for name, key in (("lineitem", "l_orderkey"), ("orders", "o_orderkey")):
        names[name] = f"bucketed_{name}"
        spark.sql(f"DROP TABLE IF EXISTS {names[name]}")
        read_table(spark, SF, name).write.bucketBy(8, key).option("path", str(tmp_path / name)).saveAsTable(names[name])
    try:
        rest = [read_table(spark, SF, n) for n in ("customer", "nation", "region")]
        df = revenue_by_region_of(spark.table(names["lineitem"]), spark.table(names["orders"]), *rest)
        shuffles = re.findall(r"Arguments: hashpartitioning\((\w+)#", plan_text(df))
        assert "o_custkey" in shuffles and not {"l_orderkey", "o_orderkey"} & set(shuffles)
        got = sorted((r.r_name, str(r.revenue), r.n_lines) for r in df.collect())
        assert got == sorted(map(tuple, revenue_by_region(spark, SF).collect()))
    finally:
        for name in names.values():
            spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_read_table_without_a_declared_schema(spark):
    df = read_table(spark, SF, "events", "event_id", "user_id")
    assert df.columns == ["event_id", "user_id"] and df.count() == 10_000
    assert "text" in read_table(spark, SF, "documents").columns

"""The revenue formula, on ordinary and on extreme amounts."""

from __future__ import annotations

from decimal import ROUND_HALF_UP, Decimal, getcontext

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from keelson.functions import discounted
from keelson.plans import revenue_by_region_of

getcontext().prec = 60  # Python's own sums must not round


def _money(x: float) -> Decimal:
    return Decimal(repr(x)).quantize(Decimal("0.01"), rounding=ROUND_HALF_UP)


@settings(max_examples=20, deadline=None)
@given(
    st.lists(
        st.tuples(
            st.one_of(st.integers(-10**15, 10**15).map(lambda c: c / 100), st.none()),
            st.one_of(st.integers(-1500, 1500).map(lambda c: c / 100), st.none()),
        ),
        min_size=1,
        max_size=100,
    )
)
def test_formula(spark, rows):
    got = [r[0] for r in spark.createDataFrame(rows, "p double, d double").select(discounted("p", "d")).collect()]
    assert got == [None if None in r else _money(r[0]) * (1 - _money(r[1])) for r in rows]


def _one_region(spark, amounts):
    """The query's revenue for line items of one order."""
    lineitem = spark.createDataFrame([(1, p, d) for p, d in amounts], "l_orderkey long, l_extendedprice double, l_discount double")
    orders = spark.createDataFrame([(1, 1)], "o_orderkey long, o_custkey long")
    customer = spark.createDataFrame([(1, 1)], "c_custkey long, c_nationkey int")
    nation = spark.createDataFrame([(1, 1)], "n_nationkey int, n_regionkey int")
    region = spark.createDataFrame([(1, "ASIA")], "r_regionkey int, r_name string")
    row = revenue_by_region_of(lineitem, orders, customer, nation, region).first()
    return row.revenue, row.n_lines


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_no_row_is_lost_to_overflow(spark, ansi):
    old = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        assert _one_region(spark, [(9e15, -9e15), (5.0, 0.0)]) == (Decimal("81000000000000009000000000000005.0000"), 2)
        for exponent in (14, 15):
            p = 10.0**exponent
            want = 2 * _money(p) * (1 + _money(p)) + Decimal("0.9999")
            assert _one_region(spark, [(p, -p), (p, -p), (1.01, 0.01)]) == (want, 3)
    finally:
        spark.conf.set("spark.sql.ansi.enabled", old)


def test_totals_keep_all_decimals(spark):
    """A 21-digit total is exact to its four decimals, which a double would not hold."""
    amounts = [(9999999999999.99, 0.07)] * 2000 + [(0.01, 0.01)]
    want = 2000 * Decimal("9999999999999.99") * Decimal("0.93") + Decimal("0.0099")
    revenue, n = _one_region(spark, amounts)
    assert (revenue, n) == (want, 2001)
    assert len(str(revenue).replace(".", "")) >= 21 and Decimal(float(revenue)) != revenue


def test_type(spark):
    df = spark.range(1).select(discounted(F.lit(1.0), F.lit(0.5)).alias("r"))
    assert df.schema["r"].dataType.simpleString() == "decimal(38,4)"

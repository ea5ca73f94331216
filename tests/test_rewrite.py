"""The pre-summing plan equals join-then-group on adversarial small tables.

Brute force: nested loops over the five tables with SQL inner-join
semantics (null keys never match) and exact decimal sums. Fixtures draw keys
from tiny ranges, so duplicate keys, orphans, null keys and hot keys are
the normal case rather than the exception.
"""

from __future__ import annotations

from decimal import ROUND_HALF_UP, Decimal

import duckdb
import pyarrow as pa
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from keelson.plans import REVENUE_BY_REGION_SQL, revenue_by_region_of

SCHEMAS = {
    "lineitem": "l_orderkey bigint, l_extendedprice double, l_discount double",
    "orders": "o_orderkey bigint, o_custkey bigint",
    "customer": "c_custkey bigint, c_nationkey int",
    "nation": "n_nationkey int, n_regionkey int",
    "region": "r_regionkey int, r_name string",
}
ARROW = {
    "lineitem": pa.schema([("l_orderkey", pa.int64()), ("l_extendedprice", pa.float64()), ("l_discount", pa.float64())]),
    "orders": pa.schema([("o_orderkey", pa.int64()), ("o_custkey", pa.int64())]),
    "customer": pa.schema([("c_custkey", pa.int64()), ("c_nationkey", pa.int32())]),
    "nation": pa.schema([("n_nationkey", pa.int32()), ("n_regionkey", pa.int32())]),
    "region": pa.schema([("r_regionkey", pa.int32()), ("r_name", pa.string())]),
}


def _money(x: float) -> Decimal:
    # Spark's cast of a double to decimal(18,2): half up on the shortest decimal form.
    return Decimal(repr(x)).quantize(Decimal("0.01"), rounding=ROUND_HALF_UP)


def brute_force(t):
    groups: dict = {}
    for lk, price, disc in t["lineitem"]:
        for ok, ock in t["orders"]:
            if lk is None or ok != lk:
                continue
            for ck, cn in t["customer"]:
                if ock is None or ck != ock:
                    continue
                for nk, nr in t["nation"]:
                    if cn is None or nk != cn:
                        continue
                    for rk, rn in t["region"]:
                        if nr is None or rk != nr:
                            continue
                        acc = groups.setdefault(rn, [None, 0])
                        acc[1] += 1
                        if price is not None and disc is not None:
                            value = _money(price) * (1 - _money(disc))
                            acc[0] = value if acc[0] is None else acc[0] + value
    return sorted(
        ((name, s, n) for name, (s, n) in groups.items()),
        key=str,
    )


def run_spark(spark, t):
    dfs = {name: spark.createDataFrame(rows, SCHEMAS[name]) for name, rows in t.items()}
    result = revenue_by_region_of(dfs["lineitem"], dfs["orders"], dfs["customer"], dfs["nation"], dfs["region"])
    return sorted(((r.r_name, r.revenue, r.n_lines) for r in result.collect()), key=str)


def run_duckdb(t):
    con = duckdb.connect()
    for name, rows in t.items():
        columns = list(zip(*rows)) if rows else [[] for _ in ARROW[name]]
        con.register(name, pa.table([pa.array(list(c), type=f.type) for c, f in zip(columns, ARROW[name])], schema=ARROW[name]))
    rows = con.execute(REVENUE_BY_REGION_SQL).fetchall()
    return sorted(((name, None if s is None else Decimal(s), n) for name, s, n in rows), key=str)


def key(hi):
    """A key in 0..hi, or null about one time in 5 * (hi + 1) + 1."""
    return st.sampled_from(list(range(hi + 1)) * 5 + [None])


cents = st.integers(-10**9, 10**9).map(lambda c: c / 100)
# Beyond the whole-cent contract: mills, half cents included, are rounded half up.
mills = st.integers(-10**9, 10**9).map(lambda m: m / 1000)


def maybe(values):
    """A value, or null about one time in eight."""
    return st.tuples(st.sampled_from([True] * 7 + [False]), values).map(lambda t: t[1] if t[0] else None)


def tables(price, discount):
    # Small key ranges, rare nulls and at least one row per table, so that
    # most examples join through all five tables: when this was written, 58%
    # and 70% of 300 drawn examples (brute-force and oracle variants) gave
    # result rows, most of them with duplicate order keys.
    return st.fixed_dictionaries(
        {
            "lineitem": st.lists(st.tuples(key(3), maybe(price), maybe(discount)), min_size=2, max_size=40),
            "orders": st.lists(st.tuples(key(3), key(2)), min_size=2, max_size=12),
            "customer": st.lists(st.tuples(key(2), key(1)), min_size=2, max_size=8),
            "nation": st.lists(st.tuples(key(1), key(1)), min_size=2, max_size=6),
            "region": st.lists(st.tuples(key(1), st.sampled_from(["AFRICA", "ASIA", "EUROPE", None])), min_size=1, max_size=4),
        }
    )


SETTINGS = settings(max_examples=20, deadline=None, suppress_health_check=[HealthCheck.too_slow, HealthCheck.data_too_large])


@SETTINGS
@given(
    tables(
        st.one_of(cents, mills),
        st.one_of(
            st.integers(0, 100).map(lambda c: c / 100),
            st.integers(-50, 1500).map(lambda m: m / 1000),
        ),
    )
)
def test_matches_brute_force(spark, t):
    assert run_spark(spark, t) == brute_force(t)


@SETTINGS
@given(tables(cents, st.integers(0, 100).map(lambda c: c / 100)))
def test_matches_oracle_sql_on_fixtures(spark, t):
    # Whole-cent amounts only: on other doubles Spark and DuckDB round the
    # cast to decimal(18,2) differently (see README).
    assert run_spark(spark, t) == run_duckdb(t)


def test_hot_order_and_hot_customer(spark):
    """One order holds a third of the line items, one customer a third of the orders."""
    n = 3000
    lineitem = [(0 if i % 3 == 0 else i, 100.0 + (i % 997) / 100, (i % 11) / 100) for i in range(n)]
    orders = [(k, 7 if k % 3 == 0 else k % 50) for k in range(n)]
    customer = [(c, c % 5) for c in range(50)]
    nation = [(k, k % 3) for k in range(5)]
    region = [(0, "AFRICA"), (1, "ASIA"), (2, "EUROPE")]
    t = {"lineitem": lineitem, "orders": orders, "customer": customer, "nation": nation, "region": region}
    assert run_spark(spark, t) == brute_force(t) == run_duckdb(t)


def test_empty_tables(spark):
    t = {name: [] for name in SCHEMAS}
    assert run_spark(spark, t) == [] == run_duckdb(t)

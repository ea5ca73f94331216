"""Clusters against whole-vector arithmetic and DuckDB."""

from __future__ import annotations

import hashlib
import math
import random

import numpy as np
import pytest

from keelson.llm.centroids import ORACLE_SQL, clustered, encoded, op12_centroids
from tests.conftest import TESTDATA, duckdb_on

VECTORS = "vec_id long, embedding array<double>, label int, cluster string, distance double"


def brute(rows):
    """Plain rounds over Python integers."""
    kept = [(i, [math.floor(1024 * x) for x in v]) for i, v in rows if v is not None and len(v) == 64 and all(x is not None and math.isfinite(x) for x in v)]
    order = sorted((hashlib.sha256(f"3:{i}".encode()).hexdigest(), v) for i, v in kept)
    centroids = [v for _, v in order[:8]]
    for r in range(11):
        d = [[sum((a - b) ** 2 for a, b in zip(v, c, strict=True)) for c in centroids] for _, v in kept]
        own = [min(range(len(x)), key=lambda k: (x[k], k)) for x in d]
        if r < 10:
            for k in range(len(centroids)):
                m = [v for (_, v), o in zip(kept, own, strict=True) if o == k]
                if m:
                    centroids[k] = [sum(col) // len(m) for col in zip(*m, strict=True)]
    inertia = [sum(d[i][k] for i, o in enumerate(own) if o == k) for k in range(len(centroids))]
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return sorted((i, k, d[n][k], inertia[k], sum(inertia), sha[k]) for n, ((i, _), k) in enumerate(zip(kept, own, strict=True)))


def test_matches_oracle(spark):
    for sf in ("sf0.001", "sf0.1"):
        got = op12_centroids(spark, f"{TESTDATA}/{sf}")
        want = duckdb_on(f"{TESTDATA}/{sf}").execute(ORACLE_SQL)
        assert got.columns == [c[0] for c in want.description]
        assert sorted(map(tuple, got.collect())) == sorted(want.fetchall())


def awkward(seed):
    r = random.Random(seed)
    base = [[r.gauss(0, 1) for _ in range(64)] for _ in range(5)]
    rows = [(i, [round(x + r.gauss(0, 0.05), 2) for x in r.choice(base)]) for i in range(60)]
    rows += [(100 + i, list(base[0])) for i in range(40)] + [(3, base[1]), (3, base[1])]  # one vector many times, a repeated row
    return rows + [(200, None), (201, []), (202, base[0][:63]), (203, base[0] + [0.0]), (204, [None, *base[0][1:]]), (205, [math.nan, *base[0][1:]]), (206, [math.inf, *base[0][1:]])]


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 1, "x", 0.5) for i, v in rows], VECTORS)


def test_awkward_vectors(spark):
    rows = awkward(1)
    df = frame(spark, rows)
    got = clustered(df.repartition(4))
    assert got.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    assert sorted(map(tuple, got.collect())) == brute(rows)
    assert clustered(df.limit(0)).count() == 0 and clustered(df.where("vec_id >= 200")).count() == 0
    few = [(1, [0.0] * 64), (2, [-0.5] * 64), (2, [-0.5] * 64)]
    assert sorted(map(tuple, clustered(frame(spark, few)).collect())) == brute(few)
    assert {r.vec_id for r in clustered(frame(spark, [(None, [0.1] * 64), (5, [3.0] * 64)])).collect()} == {None, 5}
    with pytest.raises(Exception, match="64 bits"):
        clustered(frame(spark, [(1, [1e30] * 64)])).collect()


def test_encoding_is_lossless_and_picks_the_cheapest_blocks():
    r = np.random.default_rng(2)
    pairs = r.integers(0, 500, (20, 2))
    tables = [r.integers(-3, 3, (500, 64)), np.tile(r.integers(-999, 999, (3, 64)), (200, 1)), r.integers(-(10**6), 10**6, (400, 64))]
    chosen = set()
    for x in (*tables, np.hstack([pairs[r.integers(0, 20, 2000)] for _ in range(32)])):
        length, books, codes = encoded(x)
        assert np.array_equal(np.hstack([b[c] for b, c in zip(books, codes, strict=True)]), x)
        assert all(len(np.unique(b, axis=0)) == len(b) for b in books) and len(books) * length == 64
        cost = {n: sum(len(np.unique(x[:, j : j + n], axis=0)) * n for j in range(0, 64, n)) + 64 // n * len(x) for n in (1, 2, 4, 8, 16, 32, 64)}
        assert cost[length] == min(cost.values())
        chosen.add(length)
    assert len(chosen) > 1

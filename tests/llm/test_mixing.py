"""Targets against the rule applied step by step; totals, caps, reruns."""

from __future__ import annotations

import math
from collections import defaultdict

import pytest

from keelson.llm import mixing
from keelson.llm.mixing import mix, mixed_documents, op5_mixing
from tests.conftest import TESTDATA
from tests.llm.helpers import awkward_docs, words


def targets(sizes):
    """sizes: {source: words}. Share by weight, stop at twice the source, share the excess again."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    left, free, out = 1.5 * sum(sizes.values()), set(names), {}
    while free:
        share = {s: left * weight[s] / sum(weight[t] for t in free) for s in free}
        over = {s for s in free if share[s] > 2 * sizes[s]}
        if not over:
            return out | share
        for s in over:
            out[s] = 2.0 * sizes[s]
            left -= out[s]
        free -= over
    return out


def check(rows, docs):
    sizes = defaultdict(int)
    for _, source, text in docs:
        sizes[source] += len(words(text))
    want = targets(sizes)
    assert len(rows) == len(docs)
    taken, largest = defaultdict(int), defaultdict(int)
    for r in rows:
        assert r.source_size == sizes[r.source] and abs(r.target - want[r.source]) <= 1e-6 * (1 + want[r.source])
        assert 0 <= r.taken <= 2 * r.size and r.taken == r.copies * r.size
        taken[r.source] += r.taken
        largest[r.source] = max(largest[r.source], r.size)
    for s in sizes:
        assert abs(taken[s] - want[s]) <= 0.51 * largest[s] + 1e-6 * want[s], s


def test_whole_table_and_rerun(spark):
    sf = f"{TESTDATA}/sf0.01"
    docs = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "source", "text").collect()]
    rows = op5_mixing(spark, sf).collect()
    check(rows, docs)
    moved = spark.read.parquet(f"{sf}/documents.parquet").repartition(11)
    assert sorted((r.doc_id, r.copies) for r in mix(moved).collect()) == sorted((r.doc_id, r.copies) for r in rows)


def test_awkward_docs(spark):
    df, _ = awkward_docs(spark)
    rows = mix(df).collect()
    check(rows, [(r.doc_id, r.source, r.text) for r in df.collect()])
    out = mixed_documents(df)
    assert out.columns == df.columns and out.count() == sum(r.copies for r in rows)
    assert mix(df.limit(0)).count() == 0 and mixed_documents(df.limit(0)).count() == 0
    assert mix(df.where("doc_id in (3, 4)")).select("target", "taken").distinct().collect() == [(0.0, 0)]


def test_one_hot_source(spark):
    """One source with nine tenths of the words; sizes from 1 to 2,000."""
    docs = [(i, "hot" if i % 10 else f"cold{i % 7}", " ".join(["w"] * (1 + i * i % 2000))) for i in range(600)]
    check(mix(spark.createDataFrame(docs, "doc_id long, source string, text string")).collect(), docs)


def test_rates_are_the_optimum(spark):
    """Per source the tilt of a bisection over its documents, one at a time."""
    sf = f"{TESTDATA}/sf0.01"
    rows = mix(spark.read.parquet(f"{sf}/documents.parquet")).collect()
    of = defaultdict(list)
    for r in rows:
        if r.size:
            of[r.source].append(r)
    for own in of.values():
        mean = sum(r.size for r in own) / len(own)
        rate = lambda lam, r: min(2.0, math.exp(min(50.0, lam * r.size / mean)))  # noqa: B023, E731
        if own[0].target >= 2 * own[0].source_size * (1 - 1e-12):
            assert all(r.rate == 2 for r in own)
            continue
        low, high = -1e4, 1e4
        for _ in range(200):
            lam = (low + high) / 2
            low, high = (lam, high) if sum(rate(lam, r) * r.size for r in own) < own[0].target else (low, lam)
        assert all(abs(rate(lam, r) - r.rate) < 1e-6 for r in own)


def test_rates_do_not_depend_on_the_partitions(spark):
    docs = spark.read.parquet(f"{TESTDATA}/sf0.001/documents.parquet")
    rates = [sorted((r.doc_id, r.rate, r.copies, r.target) for r in mix(docs.repartition(n, "doc_id") if n else docs).collect()) for n in (0, 7)]
    assert all(x == rates[0] for x in rates)


def test_many_sources(spark):
    """Ranks and fill-up levels over ranges of sources, with ties, small ones and a null."""
    sizes = {f"s{i:05d}": (i * 7919) % 97 * (i % 5 + 1) for i in range(5000)} | {None: 50, "a": 10**6}
    rows = spark.createDataFrame([(s, n) for s, n in sizes.items()], "source string, source_size long").repartition(5)
    want = targets(sizes)
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None]
    got = {r.source: r for r in mixing.targets(rows).collect()}
    assert {s: r.k for s, r in got.items()} == {s: i for i, s in enumerate(names, 1)}
    assert all(abs(got[s].target - want[s]) <= 1e-6 * (1 + want[s]) for s in sizes)


def test_an_unsolved_dual_is_an_error(spark, monkeypatch):
    monkeypatch.setattr(mixing, "MAX_STEPS", 1)
    docs = [(i, f"s{i % 3}", "w " * (1 + i * i % 200)) for i in range(60)]
    with pytest.raises(RuntimeError, match="not solved"):
        mix(spark.createDataFrame(docs, "doc_id long, source string, text string"))

"""Exact duplicates against plain grouping and DuckDB; the index files by looking texts up."""

from __future__ import annotations

import hashlib
import random
import re

import numpy as np

from keelson.llm.exact_dedup import ORACLE_SQL, build, directory, first_of_equal, op13_exact_dedup
from tests.conftest import TESTDATA, duckdb_on
from tests.llm.helpers import awkward_docs


def plain(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


def brute(texts):
    """(doc_id, keep_id, group_size, text_sha256) rows and the number of groups."""
    groups = {}
    for i, t in texts:
        groups.setdefault(plain(t), []).append(i)
    keep = {t: min((i for i in ids if i is not None), default=None) for t, ids in groups.items()}
    rows = [(i, keep[plain(t)], len(groups[plain(t)]), hashlib.sha256(plain(t).encode()).hexdigest()) for i, t in texts]
    return sorted(rows, key=repr), len(groups)


def check(df, texts):
    rows = df.collect()
    want, groups = brute(texts)
    assert sorted([(r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in rows], key=repr) == want
    kept = [r for r in rows if r.kept]
    assert len(kept) == groups == len({r.text_sha256 for r in kept}) and all(r.doc_id == r.keep_id for r in kept)


def test_matches_oracle(spark):
    for sf in ("sf0.001", "sf0.01"):
        got = op13_exact_dedup(spark, f"{TESTDATA}/{sf}")
        con = duckdb_on(f"{TESTDATA}/{sf}")
        want = con.execute(ORACLE_SQL)
        assert got.columns == [c[0] for c in want.description]
        assert sorted(map(tuple, got.collect())) == sorted(want.fetchall())


def test_awkward_docs(spark):
    df, texts = awkward_docs(spark)
    check(first_of_equal(df), texts)
    assert first_of_equal(df).columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    assert first_of_equal(df.limit(0)).count() == 0


def messy(seed):
    r = random.Random(seed)
    texts = [f"t{i} {'x' * r.randrange(40)}" for i in range(150)] + ["", " "]
    hot = "the very same text"
    spaced = lambda t: re.sub(" ", lambda _: r.choice([" ", "\t", "\n \r", "\x0b\x0c  "]), t)
    ids = r.sample(range(10**6), 900)
    return [(i, spaced(r.choice(texts))) for i in ids[:600]] + [(i, spaced(hot)) for i in ids[600:]] + [(None, hot), (None, None), (ids[0], texts[0]), (None, "alone"), (None, "alone")]


def test_splits_chains_of_pages_and_collisions(spark):
    """Buckets of a few bytes, so that the directory doubles and the hot text takes many pages; short keys, so that texts collide."""
    for bits, depth, capacity in ((64, 8, 200), (3, 3, 100), (1, 1, 1 << 20), (64, 12, 1)):
        texts = messy(bits)
        df = spark.createDataFrame(texts, "doc_id long, text string").repartition(5)
        rows, index = build(df, capacity=capacity, bits=bits, max_depth=depth)
        check(rows, texts)
        chained = np.diff(index.directory.first_page)
        assert (chained.max() > 1) == (capacity < 1 << 20)
        groups = {}
        for i, t in texts:
            groups.setdefault(plain(t), []).append(i)
        for t, ids in list(groups.items())[:12] + [("the very same text", groups["the very same text"])]:
            assert index.find(t.replace(" ", " \t")) == (min((i for i in ids if i is not None), default=None), len(ids))
        assert index.find("never seen") is None


def test_directory_splits_only_overfull_buckets():
    cells = np.zeros(16, np.int64)
    cells[0], cells[1], cells[9] = 5, 6, 30
    d = directory(cells, owners=4, capacity=10)
    # the upper half holds one hot cell, so it splits down to it; the lower one splits at its last bit
    sizes = [int(cells[p << (4 - n) : (p + 1) << (4 - n)].sum()) for n, p in d.local]
    assert sum(sizes) == 41 and all(s <= 10 or n == 4 for s, (n, _) in zip(sizes, d.local, strict=True))
    assert d.depth == 4 and len(d.slots) == 16
    assert int(np.diff(d.first_page).max()) == 3  # 30 bytes on pages of 10
    for cell in range(16):
        n, p = d.local[d.bucket(cell << 60)]
        assert p == cell >> (4 - n)
    assert (np.diff(d.owner) >= 0).all() and d.owner.max() < 4
    assert directory(np.zeros(16, np.int64), 4, 10).depth == 0

"""The similarity join against plain set arithmetic and DuckDB."""

from __future__ import annotations

import os
import random

import numpy as np

from keelson.llm import jaccard
from keelson.llm.common import shared_folder
from keelson.llm.jaccard import ORACLE_SQL, counted, joined, links, one_of_each, op2_jaccard_join
from tests.conftest import TESTDATA, duckdb_on
from tests.llm.helpers import awkward_docs, words

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text):
    w = words((text or "").translate(LOWER))
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def brute(texts):
    """(linked pairs of different sets, doc_id -> component)."""
    sets = [(i, shingles(t)) for i, t in texts]
    root = {i: i for i, _ in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    pairs = set()
    for x, (i, a) in enumerate(sets):
        for j, b in sets[:x]:
            if a and b and 100 * len(a & b) >= 80 * len(a | b):
                root[max(find(i), find(j))] = min(find(i), find(j))
                if a != b:
                    pairs.add((min(i, j), max(i, j)))
    return pairs, {i: find(i) for i, _ in sets}


def chains(seed):
    """Copies of copies with a few words changed: chains and stars around 0.8, small and large sets."""
    r = random.Random(seed)
    texts = []
    for size in (5, 8, 9, 12, 20, 60, 200, 400):
        own = [[f"{size}x{r.randrange(10**6)}" for _ in range(size)]]
        for _ in range(8):
            new = list(r.choice(own))
            for _ in range(r.choice([0, 0, 1, 1, 1, 2, max(1, size // 60)])):
                new[r.randrange(len(new))] = f"y{r.randrange(10**6)}"
            if r.random() < 0.4:
                new.append(f"z{r.randrange(10**6)}")
            own.append(new)
        texts += [" ".join(w) for w in own]
    r.shuffle(texts)
    return list(enumerate(texts))


def test_chains_and_links(spark):
    texts = chains(5)
    pairs, components = brute(texts)
    df = spark.createDataFrame(texts, "doc_id long, text string")
    got = {r.doc_id: r for r in joined(df).collect()}
    assert {i: r.component_id for i, r in got.items()} == components
    assert all(got[i].n_shingles == len(shingles(t)) for i, t in texts)
    assert len(set(components.values())) < len(texts) - 10  # many links to lose
    found = {(r.a, r.b) for r in links(df).collect()}
    assert found <= pairs and {(components[a], components[b]) for a, b in pairs} <= {(components[a], components[a]) for a, _ in found}
    by_id = {i: frozenset(shingles(t)) for i, t in texts}
    assert {frozenset((by_id[a], by_id[b])) for a, b in found} == {frozenset((by_id[a], by_id[b])) for a, b in pairs}


def test_awkward_docs(spark):
    df, texts = awkward_docs(spark)
    rows = joined(df).collect()
    assert len(rows) == len(texts)
    _, components = brute([(i, t) for i, t in texts if i is not None])
    assert {r.doc_id: r.component_id for r in rows if r.doc_id is not None} == components
    assert components[2] == components[1] == 0 and components[7] == 6
    assert sorted(r.n_shingles for r in rows if r.doc_id is None) == [0, 76]
    kept = one_of_each(df)
    assert kept.columns == df.columns
    ids = [r.doc_id for r in kept.collect()]
    assert sorted(i for i in ids if i is not None) == sorted(set(components.values())) and ids.count(None) == 2
    assert joined(df.limit(0)).count() == 0


def test_awkward_docs_are_counted(spark):
    df, texts = awkward_docs(spark)
    rows = counted(df).collect()
    sets = [shingles(t) for _, t in texts]
    want = [(i, len(a), sum(bool(a and b) and x != y and 100 * len(a & b) >= 80 * len(a | b) for y, b in enumerate(sets))) for x, ((i, _), a) in enumerate(zip(texts, sets, strict=True))]
    assert sorted(((r.doc_id, r.n_shingles, r.n_links) for r in rows), key=repr) == sorted(want, key=repr)
    _, components = brute([(i, t) for i, t in texts if i is not None])
    assert {r.doc_id: r.component_id for r in rows if r.doc_id is not None} == components
    empty = counted(df.limit(0))
    assert empty.count() == 0 and empty.columns == ["doc_id", "n_shingles", "component_id", "n_links"]


def test_matches_oracle(spark):
    for sf in ("sf0.001", "sf0.01"):
        got = op2_jaccard_join(spark, f"{TESTDATA}/{sf}")
        want = duckdb_on(f"{TESTDATA}/{sf}").execute(ORACLE_SQL)
        assert got.columns == [c[0] for c in want.description]
        assert sorted(map(tuple, got.collect())) == sorted(want.fetchall())


def folders(spark):
    return {x for x in os.listdir(shared_folder(spark).removeprefix("file:"))}


def test_only_the_result_is_left(spark):
    df = spark.createDataFrame(chains(7), "doc_id long, text string")
    before = folders(spark)
    kept = one_of_each(df)
    assert kept.count() and len(folders(spark) - before) == 1
    assert counted(df).count() and len(folders(spark) - before) == 2


def dense_group(seed, n):
    """n different near copies of one text, some too far from it; documents that share most of their frequent lines; near copies of 4 sizes."""
    r = random.Random(seed)
    base = [f"b{i}" for i in range(140)]
    texts = []
    for _ in range(n):
        new = list(base)
        for _ in range(r.choice([1, 1, 2, 3, 6, 20])):
            new[r.randrange(140)] = f"n{r.randrange(10**6)}"
        texts.append(" ".join(new[: r.choice([140, 140, 130, 115])]))
    lines = [" ".join(f"l{i}x{j}" for j in range(12)) for i in range(12)]
    for _ in range(n // 4):
        texts.append("\n".join(r.sample(lines, r.choice([5, 6, 7]))) + f" own{r.randrange(10**6)} end")
    return list(enumerate(texts))


def test_dense_groups(spark, monkeypatch):
    """Blocks of a few members, so that dense keys and large components take many of them."""
    monkeypatch.setattr(jaccard, "BLOCK", 50)
    texts = dense_group(3, 400)
    sets = [shingles(t) for _, t in texts]
    want = {i: sum(x != i and 100 * len(a & b) >= 80 * len(a | b) for x, b in enumerate(sets)) for i, a in enumerate(sets)}
    components = brute(texts)[1]
    rows = counted(spark.createDataFrame(texts, "doc_id long, text string").repartition(4)).collect()
    assert {r.doc_id: r.component_id for r in rows} == components
    assert {r.doc_id: r.n_links for r in rows} == want
    assert max(want.values()) > 150 and len(set(components.values())) > 30


def test_large_dense_group(spark):
    """2,000 different near copies: every link is counted, and no join makes a row per pair."""
    r = random.Random(8)
    base = [f"b{i}" for i in range(60)]
    texts = []
    for i in range(2000):
        new = list(base)
        new[r.randrange(60)] = f"n{i}"
        texts.append((i, " ".join(new)))
    sets = [shingles(t) for _, t in texts]
    places = {}
    for s in sets:
        places.setdefault(next(j for j in range(60) if not any(f"b{j}" in g for g in s)), []).append(s)
    # a link depends only on where the two words were changed, and on whether they are the same document
    one = {p: v[0] for p, v in places.items()}
    other = {p: v[1] for p, v in places.items()}
    linked = {(p, q): 100 * len(one[p] & other[q]) >= 80 * len(one[p] | other[q]) for p in places for q in places}
    of = {i: next(p for p, v in places.items() if any(s is x for x in v)) for i, s in enumerate(sets)}
    want = {i: sum(len(v) * linked[of[i], p] for p, v in places.items()) - linked[of[i], of[i]] for i, _ in texts}
    rows = counted(spark.createDataFrame(texts, "doc_id long, text string")).collect()
    assert {x.doc_id: x.n_links for x in rows} == want and {x.component_id for x in rows} == {0}


def test_open_keys_make_no_row_per_pair(spark, monkeypatch):
    """Near copies of which the pivots find none: the open keys connect them, and no table has a row per pair."""
    base = [f"b{i}" for i in range(200)]
    texts = [(i, " ".join([*base[:i], f"n{i}", *base[i + 1 :]])) for i in range(150)]
    made, keep = {}, jaccard.Scratch.stored

    def counting(self, df, name):
        out = keep(self, df, name)
        if name in ("join-pairs", "join-near", "join-links", "join-found"):
            made[name] = max(made.get(name, 0), out.count())
        return out

    monkeypatch.setattr(jaccard.Scratch, "stored", counting)
    monkeypatch.setattr(jaccard, "_proposed", lambda keys, scratch: keys.selectExpr("cls as a", "cls as b").limit(0))
    rows = joined(spark.createDataFrame(texts, "doc_id long, text string")).collect()
    assert len(rows) == len(texts) and {x.component_id for x in rows} == {0}
    assert 0 < made["join-found"] and max(made.values()) < len(texts), made


def test_signatures_bound_the_difference():
    r = np.random.default_rng(1)
    for n in (4, 900, 1100, 5000):
        a = np.unique(r.integers(0, 1 << 63, n, dtype=np.uint64))
        for changed in (0, 1, n // 10, n // 3):
            b = np.unique(np.concatenate([a[changed:], r.integers(0, 1 << 63, changed + n // 7, dtype=np.uint64)]))
            x, y = jaccard.parity(a).view(np.uint64), jaccard.parity(b).view(np.uint64)
            while len(x) > len(y):
                x = x[: len(x) // 2] ^ x[len(x) // 2 :]
            while len(y) > len(x):
                y = y[: len(y) // 2] ^ y[len(y) // 2 :]
            differ, exact = int(np.bitwise_count(x ^ y).sum()), len(np.setxor1d(a, b))
            assert exact * 0.5 <= differ <= exact
            assert jaccard.shared_tokens([a, b], np.array([0]), np.array([1]))[0, 0] == len(np.intersect1d(a, b))


def test_every_link_is_counted(spark):
    """Per document the others it links with, exact copies and near ones, also inside a component that is already connected."""
    texts = chains(6)
    r = random.Random(6)
    base = [f"b{i}" for i in range(150)]
    for _ in range(30):  # a group of different near copies of one text
        new = list(base)
        new[r.randrange(150)] = f"n{r.randrange(10**6)}"
        texts.append((len(texts), " ".join(new)))
    texts += [(len(texts) + i, texts[i * 7][1]) for i in range(12)] + [(900, ""), (901, None)]
    sets = [(i, shingles(t)) for i, t in texts]
    want = {i: sum(bool(a and b) and i != j and 100 * len(a & b) >= 80 * len(a | b) for j, b in sets) for i, a in sets}
    rows = counted(spark.createDataFrame(texts, "doc_id long, text string")).collect()
    assert {x.doc_id: x.n_links for x in rows} == want and len(rows) == len(texts)
    assert {x.doc_id: x.component_id for x in rows} == brute(texts)[1]
    assert max(want.values()) >= 29

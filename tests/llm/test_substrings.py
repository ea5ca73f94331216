"""Removed passages against DuckDB and a plain loop; the automaton against substring search."""

from __future__ import annotations

import hashlib
import random

from keelson.llm.substrings import NONE, ORACLE_SQL, SuffixAutomaton, op7_substring_dedup, remove_repeats
from tests.conftest import TESTDATA, duckdb_on
from tests.llm.helpers import awkward_docs, words


def test_automaton():
    r = random.Random(3)
    for _ in range(60):
        texts = [[r.randrange(3) for _ in range(r.randrange(1, 25))] for _ in range(r.randrange(1, 8))]
        window = r.randrange(1, 5)
        a = SuffixAutomaton()
        for label, t in enumerate(texts):
            a.add(t, label)
        a.close()
        first = {}
        for label, t in reversed(list(enumerate(texts))):
            first |= {tuple(t[i : i + window]): label for i in range(len(t) - window + 1)}
        for t in [*texts, [r.randrange(4) for _ in range(20)]]:
            want = [first.get(tuple(t[i : i + window]), NONE) for i in range(len(t) - window + 1)]
            assert a.firsts(t, window) == want


def brute(texts):
    first = {}
    for i, t in texts:
        w = words(t)
        for k in range(len(w) - 12):
            g = tuple(w[k : k + 13])
            first[g] = min(i, first.get(g, i))
    out = []
    for i, t in texts:
        w = words(t)
        gone = {k + j for k in range(len(w) - 12) if first[tuple(w[k : k + 13])] < i for j in range(13)}
        kept = " ".join(x for k, x in enumerate(w) if k not in gone)
        out.append((i, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest(), kept))
    return sorted(out)


def test_shared_passages(spark):
    r = random.Random(4)
    shared = [[f"p{k}w{j}" for j in range(r.choice([12, 13, 14, 40, 70]))] for k in range(6)]
    texts = []
    for i in range(60):
        parts = [[f"d{i}x{j}" for j in range(r.randrange(0, 30))]]
        for _ in range(r.randrange(0, 3)):
            parts += [r.choice(shared), [f"d{i}y{r.randrange(10**6)}" for _ in range(r.randrange(0, 8))]]
        texts.append((i, " ".join(w for p in parts for w in p)))
    texts += [(100, "a " * 60), (101, "b a " * 30 + "a " * 40), (102, texts[5][1])]
    got = sorted(map(tuple, remove_repeats(spark.createDataFrame(texts, "doc_id long, text string")).collect()))
    assert got == brute(texts)


def test_awkward_docs(spark):
    df, texts = awkward_docs(spark)
    rows = remove_repeats(df).collect()
    assert len(rows) == len(texts)
    assert sorted(tuple(r) for r in rows if r.doc_id is not None) == brute([(i, t) for i, t in texts if i is not None])
    assert sorted((r.n_words, r.n_removed) for r in rows if r.doc_id is None) == [(0, 0), (80, 0)]
    assert remove_repeats(df.limit(0)).count() == 0


def test_matches_oracle(spark):
    sf = f"{TESTDATA}/sf0.001"
    got = sorted(map(tuple, op7_substring_dedup(spark, sf).select("doc_id", "n_words", "n_removed", "kept_sha256").collect()))
    assert got == sorted(duckdb_on(sf).execute(ORACLE_SQL).fetchall())

"""Counts and verdicts against DuckDB and, for awkward rows, a plain loop."""

from __future__ import annotations

import hashlib
from collections import Counter

from keelson.llm.line_rules import ORACLE_SQL, op8_line_rules, rules, without_lines
from tests.conftest import TESTDATA, duckdb_on
from tests.llm.helpers import awkward_docs, words

COUNTS = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]


def brute(text):
    text = text or ""
    w = words(text)
    grams = Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
    covered = {i + j for i in range(len(w) - 2) if grams[tuple(w[i : i + 3])] > 1 for j in range(3)}
    lines = [x for x in text.split("\n") if words(x)]
    symbols = sum(c in "#*$%&|<>" for c in text)
    return (len(w), sum(map(len, w)), symbols, len(lines) - len(set(lines)), len(covered), len(w) < 50 or 100 * len(covered) > 50 * len(w))


def test_matches_oracle(spark):
    sf = f"{TESTDATA}/sf0.01"
    got = op8_line_rules(spark, sf)
    want = duckdb_on(sf).execute(ORACLE_SQL)
    assert got.columns == [c[0] for c in want.description]
    assert sorted(map(tuple, got.collect())) == sorted(want.fetchall())


def test_awkward_docs(spark):
    df, texts = awkward_docs(spark)
    rows = rules(df).collect()
    assert len(rows) == len(texts)
    by_id = dict(texts)
    for r in rows:
        if r.doc_id is not None:
            assert tuple(r[c] for c in COUNTS[1:]) == brute(by_id[r.doc_id])
    assert rules(df.limit(0)).count() == 0


def test_depleted_documents(spark):
    """A line in 20 different documents of a host goes; copies of one text count once; other hosts keep it."""
    line = " ".join(f"shared{i}" for i in range(60))
    own = lambda i, n: " ".join(f"own{i}x{j}" for j in range(n))
    docs = [(i, "a", f"{own(i, 30)}\n{line.upper() if i % 2 else line}  ") for i in range(20)]
    docs += [(100 + i, "a", own(i, 60)) for i in range(20)] + [(200, "b", f"{own(200, 30)}\n{line}"), (300, None, f"{own(300, 30)}\n{line}")]
    docs += [(400 + i, "c", own(400, 60)) for i in range(30)]
    rows = {r.doc_id: r for r in rules(spark.createDataFrame(docs, "doc_id long, source string, text string")).collect()}
    assert sorted(i for i, r in rows.items() if not r.kept) == list(range(20))
    assert all(rows[i].n_words_removed == 60 and not rows[i].base_failed for i in range(20))


def test_lines_are_taken_out(spark):
    """The texts without the lines above the limits; the query's counts and digests are those of these texts."""
    line = " ".join(f"shared{i}" for i in range(20))
    own = lambda i, n: " ".join(f"own{i}x{j}" for j in range(n))
    docs = [(i, "a", f"{own(i, 30)}\n{line.upper() if i % 2 else line}  \n\n{own(i, 3)}\n{line}", i) for i in range(20)]
    docs += [(100, "b", f"{own(100, 30)}\n{line}", 1), (101, None, None, 2), (102, "a", "", 3), (0, "a", docs[0][2], 4)]
    df = spark.createDataFrame(docs, "doc_id long, source string, text string, key int")
    want = {(i, k): f"{own(i, 30)}\n\n{own(i, 3)}" if i < 20 else t for i, _, t, k in docs}
    got = without_lines(df)
    assert got.columns == df.columns
    rows = got.collect()
    assert {(r.doc_id, r.key): r.text for r in rows} == want and len(rows) == len(docs)
    for r in rules(df).collect():
        text = next(t for (i, _), t in want.items() if i == r.doc_id)
        assert r.left_sha256 == hashlib.sha256((text or "").encode()).hexdigest()
        assert (r.n_lines_removed, r.n_words_removed) == ((1, 40) if r.doc_id < 20 else (0, 0))
    many = df.union(spark.createDataFrame([(1000 + i, "a", own(1000 + i, 3), 0) for i in range(500)], df.schema))
    assert line not in without_lines(many).where("doc_id = 0").first().text  # other documents of the host never bring a line back
    assert line in without_lines(many, min_docs=20).where("doc_id = 0").first().text

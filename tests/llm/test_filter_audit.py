"""The filter audit against the filters applied one after the other, and DuckDB."""

from __future__ import annotations

import random
import re
from itertools import permutations

from pyspark.sql import functions as F

from keelson.llm.filter_audit import ORACLE_SQL, audit, op11_filter_audit, potential
from tests.conftest import TESTDATA, duckdb_on
from tests.llm.helpers import awkward_docs, words

COLUMNS = ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]


def brute(docs, labels):
    """docs: (doc_id, text, source); labels: (doc_id, quality, toxic). Every order applied to the documents."""
    fails = []
    for i, t, _ in docs:
        t = t or ""
        w = words(t)
        same = [j for j, u, _ in docs if (u or "") == t and j is not None and i is not None and j < i]
        tests = (len(w) < 200, 100 * len(set(w)) < 50 * len(w), 100 * len(re.findall("[A-Z]", t)) > 2 * len(t), bool(re.search(r"[#$%&*|]", t)), bool(same))
        fails.append({f for f, x in zip("ABCDE", tests, strict=True) if x})
    good = {i for i, q, _ in labels if q == 1}
    toxic = {i for i, _, x in labels if x == 1}
    out = []
    for part in {s or "" for _, _, s in docs}:
        own = [(i, f) for (i, _, s), f in zip(docs, fails, strict=True) if (s or "") == part]
        shapley = dict.fromkeys("ABCDE", 0)
        rows = []
        for order in permutations("ABCDE"):
            left = own
            for step, f in enumerate(order, 1):
                gone = [x for x in left if f in x[1]]
                left = [x for x in left if f not in x[1]]
                shapley[f] += len(gone)
                rows.append((part, "".join(order), step, len(left), len(gone), sum(f in x[1] for x in own) - len(gone), sum(x[1] == {f} for x in own), sum(i in good for i, _ in gone), sum(i in toxic for i, _ in gone), f))
        out += [(*r[:-1], shapley[r[-1]]) for r in rows]
    return sorted(out)


def test_matches_oracle(spark):
    for sf in ("sf0.001", "sf0.01"):
        got = op11_filter_audit(spark, f"{TESTDATA}/{sf}")
        want = duckdb_on(f"{TESTDATA}/{sf}").execute(ORACLE_SQL)
        assert got.columns == [c[0] for c in want.description] == COLUMNS
        assert sorted(map(tuple, got.collect())) == sorted(want.fetchall())


def test_orders_step_by_step(spark):
    r = random.Random(4)
    texts = []
    for i in range(260):
        n = r.choice([3, 150, 199, 200, 240])
        w = [f"w{r.randrange(r.choice([20, 120, 10**6]))}" for _ in range(n)]
        w[0] = r.choice(["A" * 40, "plain", "a$b", "100%"])
        texts.append(" ".join(w))
    docs = [(r.randrange(10**6), r.choice(texts), r.choice(["a", "b", None, ""])) for _ in range(400)]
    docs += [(docs[0][0], docs[0][1], "a"), (None, docs[1][1], "b"), (None, None, None), (10**7, None, "only empty"), (10**7 + 1, "", "only empty")]
    labels = [(i, r.randrange(2), r.choice([0, 1, None])) for i, _, _ in docs[:300] if i is not None] + [(docs[0][0], 1, 0), (5, None, 1)]
    got = audit(
        spark.createDataFrame([(*d, 1, "x") for d in docs], "doc_id long, text string, source string, hash int, part string").repartition(3),
        spark.createDataFrame([(*x, 2) for x in labels], "doc_id long, quality int, toxic int, mask int"),
    )
    rows = sorted(map(tuple, got.collect()))
    assert rows == brute(docs, labels)
    assert got.schema["step"].dataType.simpleString() == "int" and all(got.schema[c].dataType.simpleString() == "bigint" for c in COLUMNS[3:])


def test_awkward_docs(spark):
    df, texts = awkward_docs(spark)
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    docs = [(r.doc_id, r.text, r.source) for r in df.collect()]
    assert sorted(map(tuple, audit(df, none).collect())) == brute(docs, [])
    assert audit(df.limit(0), none).count() == 0


def test_potential_of_a_game(spark):
    """P by its definition through dividends: the sum over subsets T of S of d(T) / |T|."""
    r = random.Random(9)
    weight = [0] + [r.randrange(50) for _ in range(31)]  # documents per mask
    v = [sum(w for m, w in enumerate(weight) if m & s) for s in range(32)]
    dividend = [0] * 32
    for s in range(1, 32):
        dividend[s] = v[s] - sum(dividend[t] for t in range(s) if t & s == t)
    want = [sum(120 * dividend[t] // t.bit_count() for t in range(1, 32) if t & s == t) for s in range(32)]
    got = spark.createDataFrame([(v,)], "v array<long>").select(potential(F.col("v")).alias("q")).first().q
    assert got == want

"""Marginals against enumeration; accuracy on the held-out fold."""

from __future__ import annotations

import itertools
import zlib

import numpy as np
import pyarrow as pa

from keelson.llm.quality_crf import classify, fit, good_documents, line_features, marginals, op10_quality_crf
from keelson.llm.words import chunks
from tests.conftest import TESTDATA
from tests.llm.helpers import awkward_docs


def test_marginals():
    rng = np.random.default_rng(0)
    for lengths in ([1], [2, 1, 4], [5, 5, 1, 3]):
        node, move = rng.normal(size=sum(lengths)), rng.normal(size=(2, 2))
        row = np.repeat(np.arange(len(lengths)), lengths)
        good, _ = marginals(node, row, move)
        for r in range(len(lengths)):
            x = node[row == r]
            total, want = 0.0, np.zeros(len(x))
            for y in itertools.product((0, 1), repeat=len(x)):
                w = np.exp(np.dot(x, y) + sum(move[a, b] for a, b in itertools.pairwise(y)))
                total += w
                want += w * np.array(y)
            assert np.allclose(good[row == r], want / total)


def test_features_do_not_depend_on_the_chunk():
    texts = ["one line", "", "a b\n\n c d\na b\n", None, "é ü\n#$ 12 |", "x" * 3000, "last line\nof two"]
    whole = [line_features(d, o) for _, _, d, o in chunks(pa.array(texts))]
    small = [line_features(d, o) for _, _, d, o in chunks(pa.array(texts), 4)]
    assert len(whole) == 1 and len(small) > 1
    assert np.allclose(whole[0][0], np.concatenate([s[0] for s in small]))
    assert np.bincount(whole[0][1]).tolist() == [1, 1, 3, 1, 2, 1, 2]


def test_held_out_accuracy(spark):
    sf = f"{TESTDATA}/sf0.1"
    quality = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    rows = op10_quality_crf(spark, sf).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    held = [(r.predicted, quality[r.doc_id]) for r in rows if r.held_out and r.doc_id in quality]
    assert len(held) > 500 and sum(p == q for p, q in held) >= 0.98 * len(held)


def test_awkward_docs(spark):
    df, texts = awkward_docs(spark)
    labels = spark.createDataFrame([(0, 1, 0), (2, 1, 0), (6, 0, 0), (13, 0, 1), (13, 1, 1), (None, 1, 1), (8, None, 0), (99, 1, 0)], "doc_id long, quality int, toxic int")
    rows = classify(df, labels).collect()
    assert len(rows) == len(texts) and all(0 <= r.score <= 1 and r.held_out is not None for r in rows)
    assert len({r.score for r in rows if r.doc_id in (3, 4)}) == 1  # null and empty alike
    assert good_documents(df, labels).columns == df.columns
    assert {r.score for r in classify(df, labels.limit(0)).collect()} == {0.5}
    assert classify(df.limit(0), labels).count() == 0
    assert fit([], []) is None

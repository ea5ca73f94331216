"""The pipeline stage by stage against what each stage promises for its own input."""

from __future__ import annotations

import zlib

import numpy as np
from tokenizers import Tokenizer

import __spark_entry__
import corpus_pipeline
from keelson.llm.common import stored
from keelson.llm.quality_crf import classify
from keelson.llm.tokens import default_tokenizer
from tests.conftest import TESTDATA
from tests.llm.helpers import awkward_docs
from tests.llm.test_jaccard import brute

SF = f"{TESTDATA}/sf0.001"


def test_registered():
    assert __spark_entry__.queries()["pipeline"] is corpus_pipeline.run
    names = [f"op{n}_" for n in range(1, 14)]
    assert all(sum(q.startswith(n) for q in __spark_entry__.queries()) == 1 for n in names)
    assert len(corpus_pipeline.STAGES) == 5


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    items = [r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    kept = [docs]
    for name, stage in corpus_pipeline.STAGES:
        kept.append(stored(stage(spark, kept[-1], SF), f"test-{name}"))
    rows = [[tuple(r) for r in d.orderBy("doc_id").collect()] for d in kept]
    whole = {r[0]: r for r in rows[0]}
    assert all(d.columns == docs.columns for d in kept[:-1])
    assert all(r == whole[r[0]] for d in rows[1:-1] for r in d)  # rows pass unchanged
    ids = [[r[0] for r in d] for d in rows[:-1]]

    predicted = classify(docs, spark.read.parquet(f"{SF}/labels.parquet")).where("predicted = 1")
    assert ids[1] == sorted(r.doc_id for r in predicted.collect())
    _, component = brute([(r[0], r[1]) for r in rows[1]])
    assert ids[2] == sorted(set(component.values()))
    held = {r[0] for r in rows[2] if any(x in r[1] for x in items)}
    gone = set(ids[2]) - set(ids[3])
    assert held <= gone and len(gone - held) <= 2
    assert set(ids[4]) <= set(ids[3]) and max(map(ids[4].count, set(ids[4]))) <= 2

    tokenizer = Tokenizer.from_file(default_tokenizer())
    at = 0
    for (doc_id, start, n, crc), (want_id, text, *_) in zip(sorted(rows[5], key=lambda r: r[1]), rows[4], strict=True):
        encoded = np.array([*tokenizer.encode(text, add_special_tokens=False).ids, 0], "<u4")
        assert (doc_id, start, n, crc) == (want_id, at, len(encoded), zlib.crc32(encoded.tobytes()))
        at += n
    assert sorted(map(tuple, corpus_pipeline.run(spark, SF).collect())) == sorted(rows[5])


def test_awkward_docs(spark):
    """Every stage takes nulls, empty and long texts, repeats, extra columns and no rows."""
    df, _ = awkward_docs(spark)
    for docs in (df, df.limit(0)):
        for name, stage in corpus_pipeline.STAGES:
            out = stored(stage(spark, docs, SF), f"test-{name}")
            if name != "token_output":
                assert out.columns == corpus_pipeline.COLUMNS
            assert (out.count() > 0) == (docs is df)

"""Shards round trip: the ids that come back are those of the tokenizer on whole texts."""

from __future__ import annotations

import random
import zlib
from itertools import product

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from keelson.llm.common import filesystem, new_folder
from keelson.llm.tokens import Encoder, default_tokenizer, encode_corpus, op4_tokens, open_shard, read_document, read_shards, write_shards
from tests.conftest import TESTDATA
from tests.llm.helpers import awkward_docs


@pytest.fixture(scope="module")
def tokenizer():
    t = Tokenizer.from_file(default_tokenizer())
    t.encode_special_tokens = True
    return t


def ids_of(tokenizer, text):
    return np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 0], "<u4")


ODD = [
    "", "a  b", "a   b", " a b ", "a\t b", "a \tb\n  c", "it's 's  ''s", "é😀 x", "<|endoftext|> x", "   ", "\n\n a", "x,y. z", "a, b.\nc d,\ne", "a.\n\nb", "1, 2,. ñ, ß.",
    "\n", "a \n b", "end.", "end,", "x y 　z", "﻿q",
]


def same_ids(encoder, tokenizer, texts):
    got = encoder.encode(pa.array(texts, pa.string()))
    want = tokenizer.encode_batch([t or "" for t in texts], add_special_tokens=False)
    return [i for i, (x, e) in enumerate(zip(got, want, strict=True)) if x.tolist() != e.ids] == []


def test_chunks_encode_as_whole_texts(tokenizer):
    encoder = Encoder(default_tokenizer())
    assert encoder.separable
    for _ in range(2):  # unknown chunks, then known ones
        assert same_ids(encoder, tokenizer, [*ODD, None])
    assert encoder.encode(pa.array([], pa.string())) == []


def test_every_kind_of_white_space(tokenizer):
    """All strings of up to 6 characters over a letter and white space, where merges reach over spaces; then longer ones at random."""
    encoder = Encoder(default_tokenizer())
    spaces = "a \xa0\n\u3000\t"
    for n in range(1, 7):
        texts = ["".join(x) for x in product(spaces, repeat=n)]
        for i in range(0, len(texts), 5000):
            assert same_ids(encoder, tokenizer, texts[i : i + 5000])
    assert encoder.encode(pa.array([" \xa0 \xa0"]))[0].tolist() == [11504]
    r = random.Random(2)
    letters = "ab1.,'s é\xa0\u2003\u2028\x85\x1c\x0b\r\n\t  \u200b\ufeff\u180e😀ß"
    for _ in range(12):
        assert same_ids(encoder, tokenizer, ["".join(r.choices(letters, k=r.randrange(1, 40))) for _ in range(5000)])


def test_other_tokenizers_encode_whole_texts():
    from public_tokenizers import path

    encoder = Encoder(path("word_bpe_49k.json"))
    plain = Tokenizer.from_file(path("word_bpe_49k.json"))
    plain.encode_special_tokens = True
    assert not encoder.separable and same_ids(encoder, plain, ODD)


def check(rows, texts, tokenizer):
    """texts: (doc_id, text) in file order."""
    at = 0
    for r, (doc_id, text) in zip(sorted(rows, key=lambda r: r.start), texts, strict=True):
        ids = ids_of(tokenizer, text)
        assert (r.doc_id, r.start, r.n_tokens, r.ids_crc32) == (doc_id, at, len(ids), zlib.crc32(ids.tobytes()))
        at += len(ids)


def test_awkward_docs(spark, tokenizer):
    df, texts = awkward_docs(spark)
    order = sorted(texts, key=lambda x: (x[0] is not None, x[0] or 0, x[1] is not None, x[1] or ""))
    check(encode_corpus(df).collect(), order, tokenizer)
    assert encode_corpus(df.limit(0)).count() == 0


def test_short_documents_are_read_alone(spark, tokenizer):
    texts = [(i, t) for i, t in enumerate(ODD)]
    folder = new_folder(spark, "tokens-test")
    manifest = write_shards(spark.createDataFrame(texts, "doc_id long, text string"), folder)
    seen = {}
    for row in manifest.collect():
        f, index, key = open_shard(row.path)
        f.close()
        seen |= {int(d): read_document(row.path, i) for i, d in enumerate(index["doc_id"])}
    assert {i: x.tolist() for i, x in seen.items()} == {i: ids_of(tokenizer, t).tolist() for i, t in texts}
    # another dictionary under the same name is refused
    fs, path = filesystem(f"{folder}/{key.hex()}.zdict")
    with fs.open_output_stream(path) as f:
        f.write(b"another dictionary")
    with pytest.raises(Exception, match="another hash"):
        read_shards(manifest).collect()


def test_whole_table(spark, tokenizer):
    sf = f"{TESTDATA}/sf0.001"
    texts = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").orderBy("doc_id").collect()]
    check(op4_tokens(spark, sf).collect(), texts, tokenizer)

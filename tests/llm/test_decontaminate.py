"""The search against exhaustive scores; planted items are found and clean documents are not."""

from __future__ import annotations

import random

import numpy as np

from keelson.llm.decontaminate import PASSAGE, STRIDE, THRESHOLD, Index, clean_documents, matches, op9_decontaminate, plain_words
from tests.conftest import TESTDATA
from tests.llm.helpers import awkward_docs


def test_search_is_exhaustive():
    """Every item at or above the threshold, none below, and no passage is passed over."""
    r = random.Random(7)
    vocabulary = [f"v{i}" for i in range(150)]
    pick = lambda n: [vocabulary[min(149, int(r.expovariate(0.03)))] for _ in range(n)]
    items = [(i, " ".join(pick(r.randrange(3, 40)))) for i in range(300)]
    index = Index(items)
    hits = 0
    for _ in range(30):
        text = " ".join(pick(200) + items[r.randrange(300)][1].split() + pick(50))
        data = np.frombuffer(text.encode(), np.uint8)
        words = plain_words(data, np.array([0, len(data)]))
        for threshold in (0.4, THRESHOLD, 0.9):
            may = {p for _, p in index.may_match(words, threshold)}
            for p in range(-(-len(words.hashes) // STRIDE)):
                terms = set(words.hashes[p * STRIDE : p * STRIDE + PASSAGE].tolist())
                scores = np.zeros(len(index.ids))
                for t in terms & set(index.lists):
                    scores[index.lists[t][0]] += index.lists[t][1]
                want = {i for i in range(len(scores)) if scores[i] >= threshold - 1e-9}
                assert {i for i, _ in index.search(terms, threshold)} == want
                assert not want or p in may
                hits += len(want)
    assert hits > 1000


def test_planted_items(spark):
    r = random.Random(8)
    word = lambda: "".join(r.choice("abcdefgh") for _ in range(r.randrange(2, 8)))
    items = [(i, " ".join(word() for _ in range(r.randrange(15, 60))) + ". " + " ".join(word() for _ in range(6)) + ".") for i in range(50)]
    items += [(60, None), (61, ""), (None, "x y z"), (62, "...")]
    docs = [(i, " ".join(word() for _ in range(r.randrange(0, 600)))) for i in range(200)]
    planted = {}
    for i in range(0, 200, 5):
        at = r.randrange(50)
        text = items[at][1] if i % 2 else items[at][1].upper().replace(". ", " -- ")
        cut = docs[i][1].split()
        k = r.randrange(len(cut) + 1)
        docs[i] = (i, " ".join([*cut[:k], text, *cut[k:]]))
        planted[i] = at
    df = spark.createDataFrame([(*d, 1.0) for d in docs], "doc_id long, text string, score double")
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = matches(df, bench).collect()
    assert {(x.doc_id, x.item_id) for x in got} == set(planted.items()) and len(got) == len(planted)
    kept = clean_documents(df, bench)
    assert kept.columns == df.columns and {x.doc_id for x in kept.collect()} == {i for i, _ in docs} - set(planted)


def test_awkward_docs(spark):
    df, texts = awkward_docs(spark)
    bench = spark.createDataFrame([(1, "w7919 w12648 unknown words here and there")], "item_id long, text string")
    assert matches(df, bench).count() == 0 and clean_documents(df, bench).count() == len(texts)
    assert matches(df, bench.limit(0)).count() == 0 and matches(df.limit(0), bench).count() == 0
    item = " ".join(next(t for i, t in texts if i == 0).split()[10:50])
    held = matches(df, spark.createDataFrame([(5, item)], "item_id long, text string")).collect()
    assert sorted(r.doc_id for r in held) == [0, 1, 2, 14]


def normal(text):
    return " " + " ".join("".join(c if c.isalnum() or ord(c) > 127 else " " for c in (text or "").casefold()).split()) + " "


def test_upper_case(spark):
    """Upper case in German, French and Spanish, with letters beyond ASCII."""
    items = [
        (1, "Die größte Straße über den Fluß führt nach Österreich und weiter. Die Antwort heißt Zürich."),
        (2, "Où est né le célèbre écrivain français à l'âge de vingt ans déjà connu ? Réponse : à Besançon près du château."),
        (3, "¿Cuántos años tenía el niño cuando llegó a la montaña más alta del país? Él tenía ocho años y medio."),
    ]
    docs = [(10 * i + k, f"before it some words {f(t)} and after it some more") for i, t in items for k, f in enumerate((str, str.upper, str.lower, str.title))]
    docs.append((99, "Die Straße nach Österreich ist lang und der Fluß ist breit"))
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in matches(spark.createDataFrame(docs, "doc_id long, text string"), bench).collect()}
    assert got == {(10 * i + k, i) for i, _ in items for k in range(4)}


def test_copies_in_any_case(spark):
    """At sf0.1 every document that holds an item but for case and punctuation is found."""
    sf = f"{TESTDATA}/sf0.1"
    items = [(r.item_id, normal(r.text)) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    docs = [(r.doc_id, normal(r.text)) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    want = {(i, k) for i, t in docs for k, x in items if x in t}
    got = {(r.doc_id, r.item_id) for r in op9_decontaminate(spark, sf).collect()}
    assert len(want) > 200 and want <= got


def test_whole_table(spark):
    """All documents that hold an item word for word, and few others."""
    sf = f"{TESTDATA}/sf0.01"
    items = [tuple(r) for r in spark.read.parquet(f"{sf}/benchmark.parquet").select("item_id", "text").collect()]
    docs = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    want = {(i, k) for i, t in docs for k, x in items if x in t}
    got = {(r.doc_id, r.item_id) for r in op9_decontaminate(spark, sf).collect()}
    assert want <= got and len(got - want) <= 0.05 * len(want) + 1


def test_long_items(spark):
    """Items of any length are found word for word, wherever they stand; a single piece of one is not enough."""
    r = random.Random(9)
    word = lambda: "".join(r.choice("abcdefgh") for _ in range(r.randrange(4, 9)))
    prose = lambda n: " ".join(word() for _ in range(n))
    sizes = (60, 200, 500, 2000)
    items = [(n, f"{prose(n - 6)}. {prose(6)}.") for n in sizes] + [(n + 1, prose(n)) for n in sizes]
    docs, want = [], set()
    for item, text in items:
        for before in (0, 7, 47, 48, 95, 400):
            want.add((len(docs), item))
            docs.append((len(docs), f"{prose(before)} {text} {prose(200)}"))
        words = text.split()
        if len(words) > 60:
            docs.append((len(docs), f"{prose(50)} {' '.join(words[60:120])} {prose(50)}"))
    df = spark.createDataFrame(docs, "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = matches(df, bench).collect()
    assert {(x.doc_id, x.item_id) for x in got} == want and len(got) == len(want)
    assert {x.doc_id for x in clean_documents(df, bench).collect()} == {i for i, _ in docs} - {i for i, _ in want}


def test_shards_give_equal_hits(spark):
    """One index and many: the same documents, items and figures, with scores on both sides of the threshold."""
    r = random.Random(10)
    vocabulary = [f"v{i}" for i in range(400)]
    prose = lambda n: [vocabulary[min(399, int(r.expovariate(0.01)))] for _ in range(n)]
    items = [(i, prose(r.choice((8, 20, 40, 70, 150)))) for i in range(60)]
    docs = []
    for i in range(400):
        words = list(items[r.randrange(60)][1])
        for _ in range(r.randrange(1 + len(words) // 2)):
            words[r.randrange(len(words))] = r.choice(vocabulary)
        docs.append((i, " ".join([*prose(r.randrange(80)), *words, *prose(60)])))
    df = spark.createDataFrame(docs, "doc_id long, text string")
    bench = spark.createDataFrame([(i, " ".join(w)) for i, w in items], "item_id long, text string")
    one, many = (sorted(map(tuple, matches(df, bench, overlap=0.1, shard_items=n).collect())) for n in (None, 40))
    assert one == many and len(one) > 300
    kept = [sorted(x.doc_id for x in clean_documents(df, bench, shard_items=n).collect()) for n in (None, 40)]
    assert kept[0] == kept[1]

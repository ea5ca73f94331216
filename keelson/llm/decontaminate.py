"""Operator 9: benchmark decontamination by BM25 search with block-max WAND.

The benchmark items are the indexed texts, passages of the documents the queries:
``PASSAGE`` words, a new passage every half of that, over every whole document. An item's score for a
passage is the BM25 sum over the terms they share, divided by the item's score
for itself, so one threshold fits all items. Items at or above it are verified: enough 3-word
sequences of the item's question (all but its last sentence) and of its answer (the last
sentence) must stand in the passage or next to it.

Long items. An item of more than ``PIECE`` words is indexed whole and also in pieces of that length, a new one
every half of that, each normalised by its own score; any entry at the threshold makes the item a candidate. A piece fits into a
passage wherever it stands, so an item copied word for word is found whatever its length. Question and answer
are looked for in a span that holds the whole item, on whichever side of the passage it goes on.

Search. Postings are in item order, cut into blocks with the block's largest impact. ``search`` is
document-at-a-time block-max WAND: the pivot is the first item at which the lists' maxima reach
the threshold; if the maxima of its blocks do not, all lists skip past the nearest block end.
Most passages need no search: per item the impacts of its commonest terms, up to
``COMMON`` of its score, are set aside, and a passage can only reach the threshold
if the other terms it shares with some item weigh at least threshold - (what was set aside).
That bound is computed for all passages of a chunk at once.

Scale. The index is built in tasks, one for about ``SHARD_ITEMS`` items and pieces, and written to the shared folder, from where each worker
loads it; no item reaches the driver. A larger benchmark is
searched shard after shard, each by one pass over the documents. Item number, mean length and document
frequencies are counted once over the whole benchmark, and each shard gets those of its own terms, so scores and hits do not depend on
the number of shards. No shuffle but for these counts and
the hits, which are grouped per document and item.

Case. Texts and items are compared after Unicode case folding, so upper-case copies are found in every language.

Edge cases. Null or wordless items and documents never match. Repeated document rows
give one hit per (doc_id, item). Items with equal texts are all reported. Null doc_ids are reported as null. An empty
table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import pickle
from collections import Counter
from collections.abc import Iterator
from math import fsum, log

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keelson.llm.common import Scratch, attempt_name, filesystem, make_folder, new_folder, read, ship, shuffle_partitions
from keelson.llm.words import Words, chunks

PASSAGE = 96
STRIDE = PASSAGE // 2
PIECE = PASSAGE - STRIDE  # any span of so many words stands in one passage
THRESHOLD = 0.6  # of an item's own score
COMMON = 0.3
OVERLAP = 0.6  # of the 3-word sequences of the question, and of the answer
K1, B = 1.2, 0.75
BLOCK = 64
SHARD_ITEMS = 20_000  # with their pieces

# letters and digits stay; ASCII punctuation parts words
_PLAIN = np.arange(256, dtype=np.uint8)
for _c in range(128):
    if not chr(_c).isalnum():
        _PLAIN[_c] = 0x20
_PLAIN[10] = 10


def plain_words(data: np.ndarray, offsets: np.ndarray) -> Words:
    return Words(_PLAIN[data], offsets)


def folded(texts: pa.Array) -> pa.Array:
    """Texts without case: Unicode case folding, which also makes ss of a German sharp s."""
    return pa.array([t if t is None else t.casefold() for t in texts.to_pylist()], pa.string())


def hashes_of(text: str) -> np.ndarray:
    data = np.frombuffer(text.casefold().encode(), np.uint8)
    return plain_words(data, np.array([0, len(data)])).hashes


def question_and_answer(text: str) -> tuple[str, str]:
    """All but the last sentence or line, and that; a single one is both."""
    body = text.rstrip().rstrip(".!?")
    cut = max(body.rfind(c) for c in (". ", "! ", "? ", "\n", ".\n"))
    if cut < 0 or not len(hashes_of(body[: cut + 1])) or not len(hashes_of(body[cut + 1 :])):
        return text, text
    return body[: cut + 1], body[cut + 1 :]


def share(part: np.ndarray, near: np.ndarray) -> float:
    """The share of a part's 3-word sequences that also stand in ``near``; shorter parts are one sequence."""
    k = min(3, len(part))
    own, other = (set(zip(*(h[i:].tolist() for i in range(k)), strict=False)) for h in (part, near))
    return len(own & other) / len(own)


def entries(words: list[int]) -> Iterator[list[int]]:
    """What an item is indexed as: all its words, and its pieces if it is long."""
    yield words
    if len(words) > PIECE:
        for a in range(0, len(words) - PIECE, PIECE // 2):
            yield words[a : a + PIECE]
        yield words[-PIECE:]


class Index:
    """BM25 postings of items and their pieces, each normalised by its own score; frequencies are those of whole items."""

    def __init__(self, items: list[tuple[int, str]], counts: tuple[int, int, dict[int, int]] | None = None):
        """``counts``: number of items, their words, and items per term, if ``items`` are only a part of the benchmark."""
        whole = [(i, t, hashes_of(t).tolist()) for i, t in items if t]
        whole = [x for x in whole if x[2]]
        self.texts = [x[1] for x in whole]
        self.sizes = [len(x[2]) for x in whole]
        n_items, n_words, seen = counts or (len(whole), sum(self.sizes), Counter(t for _, _, words in whole for t in set(words)))
        mean = n_words / max(1, n_items)
        weight = {t: log(1 + (n_items - n + 0.5) / (n + 0.5)) for t, n in seen.items()}
        bags = [(at, Counter(words)) for at, x in enumerate(whole) for words in entries(x[2])]
        self.texts_at = [at for at, _ in bags]
        self.ids = [whole[at][0] for at, _ in bags]
        lists: dict[int, list[tuple[int, float]]] = {}
        rare_terms, rare_items, rare_impacts = [], [], []
        self.aside = np.zeros(len(bags))
        for at, (_, bag) in enumerate(bags):
            size = sum(bag.values())
            raw = {t: weight[t] * n * (K1 + 1) / (n + K1 * (1 - B + B * size / mean)) for t, n in bag.items()}
            total = fsum(raw.values())
            for t in sorted(raw, key=lambda t: (-seen[t], t)):
                impact = raw[t] / total
                lists.setdefault(t, []).append((at, impact))
                if self.aside[at] + impact <= COMMON:
                    self.aside[at] += impact
                else:
                    rare_terms.append(t)
                    rare_items.append(at)
                    rare_impacts.append(impact)
        self.lists = {t: (np.array([a for a, _ in x]), np.array([s for _, s in x])) for t, x in lists.items()}
        self.top = {t: float(s.max()) for t, (_, s) in self.lists.items()}
        self.blocks = {t: [(int(a[i : i + BLOCK][-1]), float(s[i : i + BLOCK].max())) for i in range(0, len(a), BLOCK)] for t, (a, s) in self.lists.items()}
        order = np.argsort(np.array(rare_terms, np.uint64), kind="stable")
        terms = np.array(rare_terms, np.uint64)[order]
        self.rare, self.rare_first = np.unique(terms, return_index=True)
        self.rare_first = np.append(self.rare_first, len(terms))
        self.rare_items = np.array(rare_items, np.int64)[order]
        self.rare_impacts = np.array(rare_impacts, np.float64)[order]

    def may_match(self, words: Words, threshold: float) -> list[tuple[int, int]]:
        """(row, passage) of the passages of a chunk that some item might match."""
        h = words.hashes
        if not len(h) or not len(self.rare):
            return []
        at = np.minimum(np.searchsorted(self.rare, h), len(self.rare) - 1)
        word = np.flatnonzero(self.rare[at] == h)
        term = at[word]
        rows = np.searchsorted(words.first, word, "right") - 1
        passage = (word - words.first[rows]) // STRIDE
        # passages are numbered through the chunk; a word stands in its own and in the one before
        base = np.concatenate([[0], np.cumsum(-(-np.diff(words.first) // STRIDE))])
        own = base[rows] + passage
        earlier = passage > 0
        own, term = np.concatenate([own, own[earlier] - 1]), np.concatenate([term, term[earlier]])
        pairs = np.unique(own * len(self.rare) + term)
        own, term = pairs // len(self.rare), pairs % len(self.rare)
        count = self.rare_first[term + 1] - self.rare_first[term]
        posting = np.repeat(self.rare_first[term], count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        key, inverse = np.unique(np.repeat(own, count) * len(self.ids) + self.rare_items[posting], return_inverse=True)
        bound = np.bincount(inverse, self.rare_impacts[posting]) + self.aside[key % len(self.ids)]
        hit = np.unique(key[bound >= threshold - 1e-9] // len(self.ids))
        row = np.searchsorted(base, hit, "right") - 1
        return list(zip(row.tolist(), (hit - base[row]).tolist(), strict=True))

    def search(self, terms: set[int], threshold: float) -> list[tuple[int, float]]:
        """(entry, score) of all entries at or above the threshold, by block-max WAND."""
        cursors = [[int(self.lists[t][0][0]), 0, t] for t in terms if t in self.lists]
        out = []

        def seek(c: list, item: int) -> None:
            items = self.lists[c[2]][0]
            c[1] = c[1] + int(np.searchsorted(items[c[1] :], item))
            c[0] = int(items[c[1]]) if c[1] < len(items) else len(self.ids)

        while cursors:
            cursors = sorted(c for c in cursors if c[0] < len(self.ids))
            reach, pivot = 0.0, None
            for n, c in enumerate(cursors):
                reach += self.top[c[2]]
                if reach >= threshold - 1e-9:
                    pivot = c[0]
                    break
            if pivot is None:
                break
            while n + 1 < len(cursors) and cursors[n + 1][0] == pivot:
                n += 1
            # the blocks that hold the pivot, or the first item after it
            held, ends = 0.0, []
            for c in cursors[: n + 1]:
                blocks = self.blocks[c[2]]
                b = c[1] // BLOCK
                while b < len(blocks) and blocks[b][0] < pivot:
                    b += 1
                if b < len(blocks):
                    held += blocks[b][1]
                    ends.append(blocks[b][0])
            if held < threshold - 1e-9:
                after = min([*ends, *(c[0] - 1 for c in cursors[n + 1 : n + 2])], default=pivot)
                for c in cursors[: n + 1]:
                    if c[0] <= after:
                        seek(c, max(after, pivot) + 1)
                continue
            if cursors[0][0] == pivot:
                # exact, so that the order of the lists does not show in the last bits
                total = fsum(float(self.lists[c[2]][1][c[1]]) for c in cursors[: n + 1] if c[0] == pivot)
                if total >= threshold - 1e-9:
                    out.append((pivot, total))
                for c in cursors[: n + 1]:
                    if c[0] == pivot:
                        seek(c, pivot + 1)
            else:
                for c in cursors[: n + 1]:
                    if c[0] < pivot:
                        seek(c, pivot)
        return out


HITS = "doc_id long, item_id long, score double, question_overlap double, answer_overlap double, passage long"


def counted(items: DataFrame) -> DataFrame:
    """item_id, text, words, entries and distinct terms of the items that have words."""
    ship(items.sparkSession)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = [hashes_of(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_pydict(
                {
                    "item_id": batch.column("item_id"),
                    "text": batch.column("text"),
                    "words": pa.array(map(len, words), pa.int64()),
                    "entries": pa.array([sum(1 for _ in entries(w)) for w in words], pa.int64()),
                    "terms": pa.array([np.unique(w).view(np.int64) for w in words], pa.list_(pa.int64())),
                }
            )

    return items.mapInArrow(scan, "item_id long, text string, words long, entries long, terms array<long>").where("words > 0")


def indexes(benchmark: DataFrame, shard_items: int | None = None) -> list[str]:
    """Files of indexes of about ``shard_items`` (SHARD_ITEMS) items and pieces each, together all items.

    Every index is built by one task from the items of its shard and the counts of their terms, and written to the shared folder; the
    driver gets the paths.
    """
    spark = benchmark.sparkSession
    ship(spark)
    folder = new_folder(spark, "benchmark-index")
    make_folder(folder)
    with Scratch() as scratch:
        items = benchmark.where("item_id is not null and text is not null")
        items = items.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")).distinct()
        items = scratch.stored(counted(items), "benchmark-items")
        total = items.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("words"), F.lit(0)).alias("words"), F.coalesce(F.sum("entries"), F.lit(0)).alias("entries")).first()
        limit = shard_items or SHARD_ITEMS
        shards = 1 if total.entries <= limit else -(-total.entries * 5 // (limit * 4))
        shard = F.pmod(F.xxhash64("item_id", "text"), F.lit(shards)).alias("shard")
        seen = items.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("n"))
        of_shard = items.select(shard, F.explode("terms").alias("term")).distinct().join(seen, "term")
        none = F.lit(None)
        rows = items.select(shard, "item_id", "text", none.cast("long").alias("term"), none.cast("long").alias("n"))
        rows = rows.union(of_shard.select("shard", none.cast("long"), none.cast("string"), "term", "n"))

        def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            number, own, counts = None, [], {}

            def done() -> pa.RecordBatch:
                fs, path = filesystem(folder)
                name = attempt_name(f"shard-{number:06d}", ".index")
                with fs.open_output_stream(f"{path}/{name}") as f:
                    f.write(pickle.dumps(Index(own, (total.n, total.words, counts))))
                return pa.RecordBatch.from_pydict({"path": [f"{folder}/{name}"]})

            for batch in batches:
                for row in batch.to_pylist():
                    if row["shard"] != number:
                        if number is not None:
                            yield done()
                        number, own, counts = row["shard"], [], {}
                    if row["term"] is None:
                        own.append((row["item_id"], row["text"]))
                    else:
                        counts[row["term"] % (1 << 64)] = row["n"]
            if number is not None:
                yield done()

        dealt = rows.repartition(min(shards, shuffle_partitions(spark)), "shard").sortWithinPartitions("shard", "item_id", "text")
        built = scratch.stored(dealt.mapInArrow(build, "path string"), "benchmark-shards")
        return sorted(r.path for r in built.collect())


_loaded: dict[str, Index] = {}


def load(path: str) -> Index:
    """The index of a file, kept until the worker needs another one."""
    if path not in _loaded:
        fs, name = filesystem(path)
        with fs.open_input_stream(name) as f:
            index = pickle.loads(f.read())  # written by ``indexes``
        _loaded.clear()
        _loaded[path] = index
    return _loaded[path]


def verified_hits(ix: Index, column: pa.Array, threshold: float, overlap: float) -> Iterator[tuple]:
    """(row, item_id, score, question overlap, answer overlap, passage) for a column of texts."""
    parts: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    for i, _, data, offsets in chunks(folded(column)):
        words = plain_words(data, offsets)
        spans: dict[tuple[int, int, int], tuple[float, float]] = {}
        for row, passage in ix.may_match(words, threshold):
            a, b = int(words.first[row]), int(words.first[row + 1])
            begin = a + passage * STRIDE
            best: dict[int, tuple[float, int]] = {}  # text -> score and entry
            for entry, score in ix.search(set(words.hashes[begin : min(b, begin + PASSAGE)].tolist()), threshold):
                item = ix.texts_at[entry]
                best[item] = max(best.get(item, (0.0, entry)), (score, entry))
            for item, (score, entry) in best.items():
                if item not in parts:
                    parts[item] = tuple(hashes_of(x) for x in question_and_answer(ix.texts[item]))
                # a long item may start or end its length away; passages close together look at one span
                reach = max(PASSAGE, ix.sizes[item])
                step = STRIDE if reach == PASSAGE else reach
                first = a + (begin - a) // step * step
                if (row, item, first) not in spans:
                    near = words.hashes[max(a, first - reach) : min(b, first + (step if step > STRIDE else 0) + PASSAGE + reach)]
                    spans[row, item, first] = tuple(share(p, near) for p in parts[item])
                q, r = spans[row, item, first]
                if q >= overlap and r >= overlap:
                    yield i + row, ix.ids[entry], score, q, r, passage


def matches(
    docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD, overlap: float = OVERLAP, shard_items: int | None = None
) -> DataFrame:
    """Verified hits, one row per document and item, with the best passage's figures."""
    ship(docs.sparkSession)
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))

    def searcher(path: str):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            index = load(path)
            for batch in batches:
                ids = batch.column("doc_id")
                hits = [(ids[h[0]].as_py(), *h[1:]) for h in verified_hits(index, batch.column("text"), threshold, overlap)]
                if hits:
                    kinds = (pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.float64(), pa.int64())
                    names = [c.split()[0] for c in HITS.split(", ")]
                    yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*hits, strict=True), kinds, strict=True)], names=names)

        return run

    found = docs.sparkSession.createDataFrame([], HITS)
    for path in indexes(benchmark, shard_items):
        found = found.union(own.mapInArrow(searcher(path), HITS))
    return found.groupBy("doc_id", "item_id").agg(
        F.max("score").alias("score"), F.max("question_overlap").alias("question_overlap"), F.max("answer_overlap").alias("answer_overlap"),
        F.count(F.lit(1)).alias("passages"),
    )


def clean_documents(
    docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD, overlap: float = OVERLAP, shard_items: int | None = None
) -> DataFrame:
    """The rows of docs without a verified hit, with all their columns."""
    ship(docs.sparkSession)

    def keeper(path: str):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            index = load(path)
            for batch in batches:
                keep = np.ones(batch.num_rows, bool)
                keep[[h[0] for h in verified_hits(index, batch.column("text"), threshold, overlap)]] = False
                yield batch.filter(pa.array(keep))

        return run

    for path in indexes(benchmark, shard_items):
        docs = docs.mapInArrow(keeper(path), docs.schema)
    return docs


def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents that hold a benchmark item, with the item."""
    return matches(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))

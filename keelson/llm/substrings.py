r"""Operator 7: remove passages that stand in an earlier document, by suffix automata.

A window is ``WINDOW`` consecutive words of a document. A word is removed if a window over it is also, word
for word, a window of a document with a smaller doc_id.

1. Every window picks its minimizer, the least hash among its 5-word runs; equal windows pick
   the same one. Minimizers of a single document are done with.
2. Documents are cut into segments, the runs of windows with one shared minimizer. Equal segments are one reference
   text with the least doc_id that has it.
3. References are cut into shards by minimizer, so all windows that could be equal meet in one
   shard. A task builds a suffix automaton over a shard, in which each state knows the
   least doc_id of its occurrences, and streams the segments through it: where the match is at least a window
   long, the state of its last ``WINDOW`` words gives the window's first document.
4. Each document drops the windows whose first document is smaller than itself, and with them
   the maximal spans they cover.

The method as dealt broadcasts every shard's automaton and streams all documents past all of
them. That is (documents x shards) work and broadcasts that grow with the corpus; here a
segment only goes to the one shard that can hold its match, with the same result.

Scale. A shard is built whole minimizers at a time, up to ``SHARD_WORDS`` words. Hot passages
are combined into one reference before the shuffle, and all joins have stored tables on both sides, which AQE can
split. Texts are shuffled twice: to be cut, for documents with shared minimizers, and to be cleaned. The memory of a
task grows with the different contexts of one 5-word run within 21 words, not with its copies.

Words are compared by 64-bit hashes to find minimizers and by 32-bit hashes of 13 words in a
row in the automaton.

Edge cases. Null and wordless texts have no words and the hash of the empty string. Texts under
``WINDOW`` words lose nothing. Rows with a null doc_id lose nothing and are no reference. Rows with the same doc_id are one document
to others; each gets a result. An empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keelson.llm.common import dropped, read, ship, stored
from keelson.llm.words import Words, chunks, mix

WINDOW = 13
GRAM = 5
SHARD_WORDS = 60_000
NONE = (1 << 63) - 1


def minimizers(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """(minimizer, is a window) for the window that begins at each word."""
    grams, _ = words.grams(GRAM)
    whole = words.grams(WINDOW)[1]
    span = WINDOW - GRAM + 1  # 5-word runs in a window
    top = np.uint64(0xFFFFFFFFFFFFFFFF)
    least, width = np.append(grams, np.full(span, top)), 1
    while width < span:
        step = min(width, span - width)
        least = np.minimum(least[: len(least) - step], least[step:])
        width += step
    return least[: len(grams)], whole


def runs(words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(row, first word, windows, minimizer) of the runs of windows with one minimizer."""
    least, whole = minimizers(words)
    at = np.flatnonzero(whole)
    if not len(at):
        z = np.zeros(0, np.int64)
        return z, z, z, np.zeros(0, np.uint64)
    row, key = words.rows()[at], least[at]
    new = np.append(True, (key[1:] != key[:-1]) | (row[1:] != row[:-1]))
    first = np.flatnonzero(new)
    return row[first], at[first], np.diff(np.append(first, len(at))), key[first]


class SuffixAutomaton:
    """A generalised suffix automaton over lists of ints; states know the least label of their occurrences."""

    def __init__(self) -> None:
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length, self.first = [-1], [0], [NONE]

    def _state(self, length: int, link: int, moves: dict[int, int]) -> int:
        self.next.append(moves)
        self.length.append(length)
        self.link.append(link)
        self.first.append(NONE)
        return len(self.next) - 1

    def _clone(self, p: int, q: int, c: int) -> int:
        copy = self._state(self.length[p] + 1, self.link[q], dict(self.next[q]))
        while p >= 0 and self.next[p].get(c) == q:
            self.next[p][c] = copy
            p = self.link[p]
        self.link[q] = copy
        return copy

    def add(self, text: list[int], label: int) -> None:
        nxt, link, length, first = self.next, self.link, self.length, self.first
        last = 0
        for c in text:
            q = nxt[last].get(c)
            if q is not None:
                last = q if length[q] == length[last] + 1 else self._clone(last, q, c)
            else:
                new = self._state(length[last] + 1, 0, {})
                p = last
                while p >= 0 and c not in nxt[p]:
                    nxt[p][c] = new
                    p = link[p]
                if p >= 0:
                    q = nxt[p][c]
                    link[new] = q if length[q] == length[p] + 1 else self._clone(p, q, c)
                last = new
            if label < first[last]:
                first[last] = label

    def close(self) -> None:
        """Hand labels up the suffix links, longest states first."""
        first, link = self.first, self.link
        for v in sorted(range(1, len(first)), key=self.length.__getitem__, reverse=True):
            if first[v] < first[link[v]]:
                first[link[v]] = first[v]

    def firsts(self, text: list[int], window: int) -> list[int]:
        """Per window of the text the least label of a text that holds it, from matching statistics."""
        nxt, link, length, first = self.next, self.link, self.length, self.first
        v = matched = 0
        out = []
        for i, c in enumerate(text):
            while v and c not in nxt[v]:
                v = link[v]
                matched = length[v]
            if c in nxt[v]:
                v = nxt[v][c]
                matched += 1
            if i >= window - 1:
                if matched >= window:
                    u = v
                    while length[link[u]] >= window:
                        u = link[u]
                    out.append(first[u])
                else:
                    out.append(NONE)
        return out


def _mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = batch.column("doc_id")
        for i, j, data, offsets in chunks(batch.column("text")):
            row, _, _, key = runs(Words(data, offsets))
            ends = np.searchsorted(row, np.arange(j - i + 1))
            yield pa.RecordBatch.from_pydict(
                {"doc_id": ids.slice(i, j - i), "keys": pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(key.view(np.int64)))}
            )


SEGMENTS = "doc_id long, segment long, key long, words binary, start int"


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, shared = batch.column("doc_id").to_numpy(zero_copy_only=False), batch.column("keys")
        for i, j, data, offsets in chunks(batch.column("text")):
            words = Words(data, offsets)
            row, at, count, key = runs(words)
            own = shared.slice(i, j - i)
            wanted = np.sort(own.flatten().to_numpy(zero_copy_only=False).view(np.uint64) ^ mix(np.repeat(np.arange(j - i), np.asarray(own.value_lengths().fill_null(0))).astype(np.uint64) + np.uint64(1)))
            mine = key ^ mix(row.astype(np.uint64) + np.uint64(1))
            place = np.minimum(np.searchsorted(wanted, mine), max(0, len(wanted) - 1))
            keep = wanted[place] == mine if len(wanted) else np.zeros(len(mine), bool)
            row, at, count, key = row[keep], at[keep], count[keep], key[keep]
            if not len(row):
                continue
            short = words.hashes.astype(np.uint32)
            texts = [short[a : a + n + WINDOW - 1].tobytes() for a, n in zip(at.tolist(), count.tolist(), strict=True)]
            names = [int.from_bytes(hashlib.blake2b(t, digest_size=8).digest(), "little", signed=True) for t in texts]
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": pa.array(ids[i:j][row], pa.int64()),
                    "segment": pa.array(names, pa.int64()),
                    "key": pa.array(key.view(np.int64)),
                    "words": pa.array(texts, pa.binary()),
                    "start": pa.array(at - words.first[row], pa.int32()),
                }
            )


def _match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (segment, key, words, first) sorted by key to (segment, firsts), shard by shard."""

    def shard(held: list[tuple[int, list[int], int]]) -> pa.RecordBatch:
        automaton = SuffixAutomaton()
        for _, text, label in held:
            automaton.add(text, label)
        automaton.close()
        return pa.RecordBatch.from_pydict(
            {
                "segment": pa.array([s for s, _, _ in held], pa.int64()),
                "firsts": pa.array([automaton.firsts(text, WINDOW) for _, text, _ in held], pa.list_(pa.int64())),
            }
        )

    held, size, last = [], 0, None
    for batch in batches:
        for segment, key, words, first in zip(*(batch.column(c).to_pylist() for c in ("segment", "key", "words", "first")), strict=True):
            if size >= SHARD_WORDS and key != last:
                yield shard(held)
                held, size = [], 0
            text = np.frombuffer(words, np.uint32).tolist()
            held.append((segment, text, first))
            size += len(text)
            last = key
    if held:
        yield shard(held)


CLEANED = "doc_id long, n_words long, n_removed long, kept_sha256 string"


def _cleaner(texts_too: bool):
    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, spans = batch.column("text").to_pylist(), batch.column("starts").to_pylist()
            total, gone, kept = [], [], []
            for text, starts in zip(texts, spans, strict=True):
                words = (text or "").encode().split()
                total.append(len(words))
                if starts:
                    out = np.zeros(len(words) + 1, np.int64)
                    starts = np.unique(np.asarray(starts, np.int64))
                    np.add.at(out, starts, 1)
                    np.add.at(out, starts + WINDOW, -1)
                    left = np.cumsum(out[:-1]) == 0
                    words = [w for w, stays in zip(words, left.tolist(), strict=True) if stays]
                gone.append(total[-1] - len(words))
                kept.append(b" ".join(words))
            columns = {
                "doc_id": batch.column("doc_id"),
                "n_words": pa.array(total, pa.int64()),
                "n_removed": pa.array(gone, pa.int64()),
                "kept_sha256": pa.array([hashlib.sha256(k).hexdigest() for k in kept], pa.string()),
            }
            if texts_too:
                columns["kept_text"] = pa.array([k.decode() for k in kept], pa.string())
            yield pa.RecordBatch.from_pydict(columns)

    return clean


def repeated_windows(docs: DataFrame) -> DataFrame:
    """(doc_id, starts): the first words of the windows that a smaller doc_id has as well."""
    ship(docs.sparkSession)
    named = docs.where("doc_id is not null")
    marks = stored(named.mapInArrow(_mark, "doc_id long, keys array<long>").select("doc_id", F.explode("keys").alias("key")), "repeat-marks")
    twice = stored(marks.groupBy("key").agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi")).where("lo < hi").select("key"), "repeat-keys")
    shared = stored(marks.join(twice, "key").groupBy("doc_id").agg(F.collect_set("key").alias("keys")), "repeat-shared")
    dropped(marks, twice)
    segments = stored(named.join(shared, "doc_id").select("doc_id", "text", "keys").mapInArrow(_cut, SEGMENTS), "repeat-segments")
    texts = segments.groupBy("segment").agg(F.min("doc_id").alias("first"), F.first("key").alias("key"), F.first("words").alias("words"))
    matched = texts.repartition("key").sortWithinPartitions("key", "segment").mapInArrow(_match, "segment long, firsts array<long>")
    # segments that only their first document has, with no window of an earlier one, need no join
    matched = stored(matched, "repeat-matched")
    hit = segments.select("doc_id", "segment", "start").join(matched, "segment")
    hit = hit.select("doc_id", F.expr("filter(transform(firsts, (f, i) -> if(f < doc_id, start + i, -1)), x -> x >= 0)").alias("starts")).where("size(starts) > 0")
    out = stored(hit.groupBy("doc_id").agg(F.array_distinct(F.flatten(F.collect_list("starts"))).alias("starts")), "repeat-starts")
    dropped(shared, segments, matched)
    return out


def remove_repeats(docs: DataFrame, texts: bool = True) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 and, if asked for, kept_text for every row of docs (doc_id, text)."""
    ship(docs.sparkSession)
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    starts = repeated_windows(own)
    return own.join(starts, "doc_id", "left").select("doc_id", "text", "starts").mapInArrow(_cleaner(texts), CLEANED + ", kept_text string" * texts)


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without the passages of earlier ones."""
    return remove_repeats(read(spark, sf_dir, "documents"), texts=False)


ORACLE_SQL = r"""
WITH d AS (
    SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), word AS (
    SELECT doc_id, unnest(w) AS w, unnest(range(len(w))) AS i FROM d
), win AS (
    SELECT doc_id, unnest(range(len(w) - 12)) AS i, unnest(list_transform(range(len(w) - 12), lambda x: array_to_string(w[x + 1:x + 13], ' '))) AS g
    FROM d WHERE len(w) >= 13
), hit AS (
    SELECT doc_id, i FROM (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY g) AS first FROM win) WHERE first < doc_id
), gone AS (
    SELECT DISTINCT doc_id, i + j AS i FROM hit, range(13) AS o(j)
), kept AS (
    SELECT doc_id, count(*) AS n, string_agg(w, ' ' ORDER BY i) AS t FROM word ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id
)
SELECT doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(len(d.w) - coalesce(kept.n, 0) AS BIGINT) AS n_removed, sha256(coalesce(kept.t, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
"""

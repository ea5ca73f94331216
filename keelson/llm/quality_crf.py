"""Operator 10: document quality from a conditional random field over lines.

Every line with a word is a position of a linear chain with two labels, good and bad. Its
features describe the line and its two neighbours: lengths, character classes,
word repetition, punctuation, a repeated line. In training each line carries the
label of its document. A document's score is the mean of its lines' marginal probabilities of
good, from the forward-backward recursion, weighted by line length.

Training uses a bounded sample: of the labelled rows outside the held-out fold
(crc32(doc_id as text) mod 5 = 0), the ``TRAIN_DOCS`` with the least hash of
doc_id, each with its whole text. The model is a few hundred numbers; scoring reads
every whole text, one pass, no shuffle. Labels, lang, source and doc_id are never features.

Edge cases. A text without words (null, empty, blank) is one empty line with all
features 0 and is scored as such. Repeated rows are scored each. A null doc_id is not
held out. Null labels are ignored; a doc_id labelled twice counts with its smaller label. Without any
training row every score is 0.5. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from keelson.llm.common import read, ship
from keelson.llm.words import Words, chunks, mix

TRAIN_DOCS = 1500
FOLDS = 5
THRESHOLD = 0.3
STEPS = 150
RATE = 0.05
L2 = 1e-4

# Byte classes counted per line.
CLASSES = (b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b"#*$%&|<>", b".!?", b",;:", b"\"'()[]{}-_/\\=+~^@`")
_OF = np.full(256, 255, np.uint8)
for _i, _c in enumerate(CLASSES):
    _OF[list(_c)] = _i
_OF[128:] = len(CLASSES)


def line_features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(features, row, length) of the lines with a word in a chunk of texts, in order.

    A row without such a line has one line of zeros with length 1.
    """
    n, rows = len(data), len(offsets) - 1
    words = Words(data, offsets)
    breaks = np.flatnonzero(data == 10)
    starts = np.unique(np.concatenate([offsets[:-1], breaks + 1]))
    starts = starts[starts < n]
    ends = np.append(starts[1:], n)
    row = np.searchsorted(offsets, starts, "right") - 1
    w0, w1 = np.searchsorted(words.starts, starts), np.searchsorted(words.starts, ends)
    keep = w1 > w0
    starts, ends, row, w0, w1 = starts[keep], ends[keep], row[keep], w0[keep], w1[keep]
    m = len(starts)

    def count(flags: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        run = np.zeros(len(flags) + 1, np.int64)
        np.cumsum(flags, out=run[1:])
        return (run[b] - run[a]).astype(np.float64)

    size, k = (ends - starts).astype(np.float64), (w1 - w0).astype(np.float64)
    kinds = _OF[data]
    f = [np.log1p(size), np.log1p(k)]
    f += [count(kinds == i, starts, ends) / np.maximum(size, 1) for i in range(len(CLASSES) + 1)]
    lengths = words.ends - words.starts
    f += [count(lengths, w0, w1) / np.maximum(k, 1) / 10, count(lengths <= 2, w0, w1) / np.maximum(k, 1), count(lengths >= 15, w0, w1) / np.maximum(k, 1)]
    letter = words.data[words.starts] if len(words.starts) else np.zeros(0, np.uint8)
    f.append(count((letter >= 65) & (letter <= 90), w0, w1) / np.maximum(k, 1))
    # words that repeat: the one before, and any in the line
    h = words.hashes
    line = np.repeat(np.arange(m), w1 - w0)  # every word is in a kept line
    if len(h):
        again = np.zeros(len(h), bool)
        again[1:] = (h[1:] == h[:-1]) & (line[1:] == line[:-1])
        _, first = np.unique(h ^ mix(line.astype(np.uint64) + np.uint64(1)), return_index=True)
        fresh = np.zeros(len(h), bool)
        fresh[first] = True
        f += [count(again, w0, w1) / np.maximum(k, 1), count(fresh, w0, w1) / np.maximum(k, 1)]
        sums = np.add.reduceat(mix(h + np.arange(len(h), dtype=np.uint64) - np.repeat(w0, w1 - w0).astype(np.uint64)), w0)
        _, inverse, times = np.unique(sums ^ mix(row.astype(np.uint64) + np.uint64(7)), return_inverse=True, return_counts=True)
        f.append((times[inverse] > 1).astype(np.float64))
        f.append(np.isin(data[words.ends[w1 - 1] - 1], list(b".!?\"")).astype(np.float64))
    else:
        f += [np.zeros(0)] * 4
    own = np.stack(f, 1) if m else np.zeros((0, len(f)))

    missing = np.setdiff1d(np.arange(rows), row, assume_unique=False)
    own = np.concatenate([own, np.zeros((len(missing), own.shape[1]))])
    row = np.concatenate([row, missing])
    size = np.concatenate([size, np.ones(len(missing))])
    order = np.argsort(row, kind="stable")
    own, row, size = own[order], row[order], size[order]
    before, after = np.zeros_like(own), np.zeros_like(own)
    same = row[1:] == row[:-1]
    before[1:][same] = own[:-1][same]
    after[:-1][same] = own[1:][same]
    alone = np.ones((2, len(own), 1))
    alone[0, 1:, 0] = ~same
    alone[1, :-1, 0] = ~same
    return np.concatenate([own, before, after, alone[0], alone[1], own[:, 2:] ** 2], 1), row, size


def marginals(node: np.ndarray, row: np.ndarray, move: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """P(good) per line and P(pair of labels) for each line and the next in its row.

    node: log-odds of good; move[i, j]: log weight of label j after label i. Chains advance together, one
    position at a time, the longest first, in log space.
    """
    first = np.flatnonzero(np.append(True, row[1:] != row[:-1]))
    count = np.diff(np.append(first, len(row)))
    order = np.argsort(-count, kind="stable")
    first, count = first[order], count[order]
    unary = np.zeros((len(node), 2))
    unary[:, 1] = node
    alpha, beta = unary.copy(), np.zeros_like(unary)
    longest = int(count[0])
    live = np.searchsorted(-count, -np.arange(longest), "left")  # chains longer than t
    for t in range(1, longest):
        i = first[: live[t]] + t
        p = alpha[i - 1][:, :, None] + move
        alpha[i] += np.logaddexp(p[:, 0], p[:, 1])
    for t in range(longest - 1, 0, -1):
        i = first[: live[t]] + t
        p = (beta[i] + unary[i])[:, None, :] + move
        beta[i - 1] = np.logaddexp(p[:, :, 0], p[:, :, 1])
    joint = alpha + beta
    total = np.logaddexp(joint[:, 0], joint[:, 1])
    good = np.exp(joint[:, 1] - total)
    pair = alpha[:-1, :, None] + move + (unary[1:] + beta[1:])[:, None, :] - total[:-1, None, None]
    return good, np.exp(np.minimum(pair, 0.0))


class Crf:
    def __init__(self, mean, scale, weights, bias, move):
        self.mean, self.scale, self.weights, self.bias, self.move = mean, scale, weights, bias, move

    def lines(self, features: np.ndarray, row: np.ndarray) -> np.ndarray:
        x = np.clip((features - self.mean) / self.scale, -8, 8)
        return marginals(x @ self.weights + self.bias, row, self.move)[0]

    def score(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """One score per row of a chunk of texts."""
        features, row, size = line_features(data, offsets)
        rows = len(offsets) - 1
        total = np.bincount(row, size, rows)
        return np.clip(np.bincount(row, size * self.lines(features, row), rows) / total, 0.0, 1.0)


def fit(texts: list[str], labels: list[int]) -> Crf | None:
    """Maximum likelihood with a small ridge, by Adam on all lines at once."""
    if not texts:
        return None
    parts, at = [], 0
    for i, j, data, offsets in chunks(pa.array(texts, pa.string())):
        f, row, _ = line_features(data, offsets)
        parts.append((f, row + i))
    features, row = np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
    mean, scale = features.mean(0), features.std(0)
    scale[scale < 1e-6] = 1.0
    x = np.clip((features - mean) / scale, -8, 8)
    y = np.asarray(labels, np.float64)[row]
    same = row[1:] == row[:-1]
    seen = np.array([[((y[:-1] == i) & (y[1:] == j) & same).sum() for j in (0, 1)] for i in (0, 1)], np.float64)
    docs = len(texts)
    p = np.zeros(x.shape[1] + 5)
    m, v = np.zeros_like(p), np.zeros_like(p)
    for step in range(1, STEPS + 1):
        w, b, move = p[:-5], p[-5], p[-4:].reshape(2, 2)
        good, pair = marginals(x @ w + b, row, move)
        gap = y - good
        g = np.concatenate([x.T @ gap, [gap.sum()], (seen - pair[same].sum(0)).ravel()]) / docs - L2 * p
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        p = p + RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return Crf(mean, scale, p[:-5], p[-5], p[-4:].reshape(2, 2))


def in_fold(doc_id: str) -> Column:
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % FOLDS == 0, F.lit(False))


def train(docs: DataFrame, labels: DataFrame) -> Crf | None:
    """Fit on the bounded sample of labelled rows outside the held-out fold."""
    chosen = (
        labels.where("doc_id is not null and quality is not null")
        .where(~in_fold("doc_id"))
        .groupBy("doc_id")
        .agg(F.min("quality").alias("quality"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(TRAIN_DOCS)
    )
    sample = (
        docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
        .join(F.broadcast(chosen), "doc_id")  # TRAIN_DOCS rows at most
        .groupBy("doc_id")
        .agg(F.min("text").alias("text"), F.min("quality").alias("quality"))
        .orderBy("doc_id")
        .collect()
    )
    return fit([r.text for r in sample], [int(r.quality) for r in sample])


def score(docs: DataFrame, model: Crf | None) -> DataFrame:
    """doc_id, text's score for every row of docs (doc_id, text)."""
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, text = batch.column("doc_id"), batch.column("text")
            for i, j, data, offsets in chunks(text):
                got = model.score(data, offsets) if model else np.full(j - i, 0.5)
                yield pa.RecordBatch.from_pydict({"doc_id": ids.slice(i, j - i), "score": pa.array(got)})

    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return own.mapInArrow(run, "doc_id long, score double")


def classify(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score, predicted for every document."""
    scored = score(docs, train(docs, labels))
    return scored.select("doc_id", in_fold("doc_id").alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def good_documents(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of docs that the classifier does not reject, with all their columns."""
    model = train(docs, labels)
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, data, offsets in chunks(batch.column("text")):
                got = model.score(data, offsets) if model else np.full(j - i, 0.5)
                yield batch.slice(i, j - i).filter(pa.array(got >= threshold))

    return docs.mapInArrow(run, docs.schema)


def op10_quality_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The quality of all documents."""
    return classify(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))

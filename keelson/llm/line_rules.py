r"""Operator 8: quality rules, with line frequencies across documents.

Lines are normalised (ASCII lower case, digits to 0, white space to one
space), hashed, and counted per host (``source``): in how many different documents does
a line stand? Copies of one text count once. Lines in more than MIN_DOCS of them are taken out, however large the host
is, and a document that loses more than half of its words with them is depleted and rejected. The base rules of the contract reject first.
``without_lines`` returns the documents without these lines; the counts of removed lines and words and the digest of what
is left are taken from the texts it makes.

Scale. The text is read twice. First a document becomes its distinct lines as hashes. Line counts are
combined before the shuffle; a line that stands in a third of all documents is one row per task. Marked lines are joined back
with stored tables on both sides, which AQE splits where a line is hot, and gathered per (host, text); by that key they meet
the texts in a sort-merge join, for which the texts are shuffled once; AQE splits the copies of one text.

Edge cases. Null and wordless texts have no words: all counts 0, base_failed, not kept. A
null source is a host of its own. Repeated rows each get a result; they count once
as documents. Null doc_ids stay. An empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from keelson.llm.common import dropped, read, ship, stored
from keelson.llm.words import Words, chunks, mix

LEAST_WORDS = 50
MIN_DOCS = 10
DEPLETED = 0.5  # of a document's words in lines above the limit

_NORMAL = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ123456789", b"abcdefghijklmnopqrstuvwxyz000000000")
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_STARTS_CHAR = np.ones(256, bool)  # not a UTF-8 continuation byte
_STARTS_CHAR[0x80:0xC0] = False
_IN_WORD = _STARTS_CHAR.copy()
_IN_WORD[[0x20, *range(9, 14)]] = False

LINES = "host string, text_key long, keys array<long>"


def _key(data: bytes) -> int:
    return int.from_bytes(hashlib.blake2b(data, digest_size=8).digest(), "little", signed=True)


def line_key(line: bytes) -> int | None:
    """The hash of a normalised line; None if it has no words."""
    parts = line.translate(_NORMAL).split()
    return _key(b" ".join(parts)) if parts else None


def again(text: bytes) -> int:
    """Lines with words that equal an earlier one."""
    lines = [x for x in text.split(b"\n") if x.split()]
    return len(lines) - len(set(lines))


def cut(text: bytes, marked: set[int]) -> tuple[bytes, int]:
    """The text without its marked lines, and how many different ones there were."""
    left, gone = [], set()
    for line in text.split(b"\n"):
        key = line_key(line)
        if key in marked:
            gone.add(key)
        else:
            left.append(line)
    return b"\n".join(left), len(gone)


def repeated_words(words: Words) -> np.ndarray:
    """Per row the words inside a 3-word window that its text has twice or more."""
    grams, whole = words.grams(3)
    rows = words.rows()
    covered = np.zeros(len(grams), bool)
    at = np.flatnonzero(whole)
    if len(at):
        own = grams[at] ^ mix(rows[at].astype(np.uint64) + np.uint64(1))
        _, inverse, times = np.unique(own, return_inverse=True, return_counts=True)
        at = at[times[inverse] > 1]
        for j in range(3):
            covered[at + j] = True
    return np.bincount(rows, covered, len(words.first) - 1).astype(np.int64)


def _rows(docs: DataFrame, columns: list[str]) -> DataFrame:
    """doc (a struct of columns of docs), host, text, and the key of the text."""
    host = F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit(""))
    own = docs.select(F.struct(*[docs[c] for c in columns]).alias("doc"), host.alias("host"), F.col("text").cast("string").alias("text"))
    return own.withColumn("text_key", F.xxhash64(F.coalesce("text", F.lit(""))))


def distinct_lines(rows: DataFrame) -> DataFrame:
    """Stored (host, text_key, keys): the hashes of the different lines of every document."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, data, offsets in chunks(batch.column("text")):
                raw, bounds = data.tobytes(), offsets.tolist()
                keys = [{line_key(x) for x in raw[a:b].split(b"\n")} - {None} for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
                yield pa.RecordBatch.from_pydict(
                    {
                        "host": batch.column("host").slice(i, j - i),
                        "text_key": batch.column("text_key").slice(i, j - i),
                        "keys": pa.array(map(list, keys), pa.list_(pa.int64())),
                    }
                )

    return stored(rows.select("host", "text_key", "text").mapInArrow(scan, LINES), "rules-lines")


def marked_lines(rows: DataFrame, min_docs: int) -> DataFrame:
    """Stored (host, text_key, marked): the hashes of the lines above the limit, for texts that have such lines."""
    found = distinct_lines(rows)
    lines = found.select("host", "text_key", F.explode("keys").alias("key"))
    per_line = lines.distinct().groupBy("host", "key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > min_docs)
    above = stored(per_line.select("host", "key"), "rules-above")
    out = stored(lines.join(above, ["host", "key"]).groupBy("host", "text_key").agg(F.collect_set("key").alias("marked")), "rules-marked")
    dropped(found, above)
    return out


def removed(docs: DataFrame, columns: list[str], min_docs: int) -> DataFrame:
    """doc (a struct of columns), the text that is left, and the counts of every row of docs."""
    ship(docs.sparkSession)
    rows = _rows(docs, columns)
    # the marked side grows with the table, so it is never broadcast: the plan is the same at every size
    met = rows.join(marked_lines(rows, min_docs).hint("merge"), ["host", "text_key"], "left").select("doc", "text", "marked")
    counts = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines_removed", "n_words_removed")
    schema = StructType([met.schema["doc"], StructField("left", StringType()), *[StructField(c, LongType()) for c in counts]])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text, marked = batch.column("text"), batch.column("marked")
            for i, j, data, offsets in chunks(text):
                words = Words(data, offsets)
                raw, bounds = data.tobytes(), offsets.tolist()
                left, dups, lines, less = [], [], [], []
                for at, (a, b) in enumerate(zip(bounds[:-1], bounds[1:], strict=True)):
                    own, gone, fewer = raw[a:b], 0, 0
                    dups.append(again(own))
                    if marked[i + at].is_valid:
                        own, gone = cut(own, set(marked[i + at].as_py()))
                        fewer = len(raw[a:b].split()) - len(own.split())
                    left.append(own if text[i + at].is_valid else None)
                    lines.append(gone)
                    less.append(fewer)
                run = np.zeros((2, len(data) + 1), np.int64)
                np.cumsum(_IN_WORD[data], out=run[0, 1:])
                np.cumsum(_SYMBOL[data], out=run[1, 1:])
                chars, symbols = (r[offsets[1:]] - r[offsets[:-1]] for r in run)
                made = (np.diff(words.first), chars, symbols, dups, repeated_words(words), lines, less)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc").slice(i, j - i), pa.array(left, pa.binary()).cast(pa.string()), *[pa.array(x, pa.int64()) for x in made]],
                    names=["doc", "left", *counts],
                )

    return met.mapInArrow(scan, schema)


def without_lines(docs: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """All rows of docs with all their columns, the text without the lines above the limit."""
    found = removed(docs, [c for c in docs.columns if c != "text"], min_docs)
    return found.select(*[F.col("left").alias("text") if c == "text" else F.col("doc")[c].alias(c) for c in docs.columns])


def rules(docs: DataFrame, min_docs: int = MIN_DOCS, depleted: float = DEPLETED) -> DataFrame:
    """The counts, base verdict and final verdict for every row of docs (doc_id, text, source), and the digest of what is left of its text."""
    found = removed(docs, ["doc_id"], min_docs)
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return found.select(
        F.col("doc")["doc_id"].cast("long").alias("doc_id"), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        failed.alias("base_failed"),
        (~failed & (F.col("n_words_removed") <= F.col("n_words") * depleted)).alias("kept"),
        "n_lines_removed", "n_words_removed",
        F.sha2(F.coalesce("left", F.lit("")), 256).alias("left_sha256"),
    )


def op8_line_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rules over all documents."""
    return rules(read(spark, sf_dir, "documents"))


ORACLE_SQL = r"""
WITH d AS (
    SELECT doc_id, coalesce('=' || source, '') AS host, coalesce(text, '') AS text,
           regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
    FROM documents
), raw AS (
    SELECT doc_id, host, text, unnest(string_split(text, chr(10))) AS l, unnest(range(len(string_split(text, chr(10))))) AS i FROM d
), line AS (
    SELECT *, trim(regexp_replace(regexp_replace(translate(l, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9]', '0', 'g'), '[\x20\x09-\x0D]+', ' ', 'g'), ' ') AS k,
           len(regexp_extract_all(l, '[^\x20\x09-\x0D]+')) AS n, row_number() OVER (PARTITION BY doc_id, l ORDER BY i) AS nth
    FROM raw WHERE regexp_matches(l, '[^\x20\x09-\x0D]')
), above AS (
    SELECT host, k FROM line GROUP BY host, k HAVING count(DISTINCT text) > 10
), kept_lines AS (
    SELECT doc_id, string_agg(l, chr(10) ORDER BY i) AS t FROM (
        SELECT *, trim(regexp_replace(regexp_replace(translate(l, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9]', '0', 'g'), '[\x20\x09-\x0D]+', ' ', 'g'), ' ') AS k
        FROM raw
    ) ANTI JOIN above USING (host, k) GROUP BY doc_id
), lost AS (
    SELECT doc_id, sum(n) AS words, count(DISTINCT k) AS lines FROM line JOIN above USING (host, k) GROUP BY doc_id
), dup AS (
    SELECT doc_id, count(*) AS n FROM line WHERE nth > 1 GROUP BY doc_id
), g AS (
    SELECT doc_id, unnest(range(1, len(w) - 1)) AS i, unnest(list_transform(range(1, len(w) - 1), lambda x: array_to_string(w[x:x + 2], ' '))) AS g FROM d
), twice AS (
    SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS c FROM g) WHERE c > 1
), rep AS (
    SELECT doc_id, count(DISTINCT i + j) AS n FROM twice, (VALUES (0), (1), (2)) AS o(j) GROUP BY doc_id
), b AS (
    SELECT doc_id, len(w) AS n_words, length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g')) AS word_chars,
           length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols,
           coalesce(dup.n, 0) AS n_dup_lines, coalesce(rep.n, 0) AS n_repeat_words, coalesce(lost.lines, 0) AS n_lines_removed,
           coalesce(lost.words, 0) AS n_words_removed, sha256(coalesce(kept_lines.t, '')) AS left_sha256
    FROM d LEFT JOIN dup USING (doc_id) LEFT JOIN rep USING (doc_id) LEFT JOIN lost USING (doc_id) LEFT JOIN kept_lines USING (doc_id)
)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars, CAST(n_symbols AS BIGINT) AS n_symbols,
       CAST(n_dup_lines AS BIGINT) AS n_dup_lines, CAST(n_repeat_words AS BIGINT) AS n_repeat_words,
       (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AS base_failed,
       (NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND n_words_removed <= n_words * 0.5) AS kept,
       CAST(n_lines_removed AS BIGINT) AS n_lines_removed, CAST(n_words_removed AS BIGINT) AS n_words_removed, left_sha256
FROM b
"""

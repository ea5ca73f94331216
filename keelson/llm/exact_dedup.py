"""Operator 13: exact duplicates through an extendible-hash index on shared files.

Texts are equal when their bytes are, after each run of white space is replaced by one space. Of
equal texts the row with the least doc_id stays.

1. Every task hashes its texts (SHA-256; the first 64 bits are the key) and counts the bytes under each of
   2**MAX_DEPTH key prefixes. The sums, one number per prefix, build the directory on the driver: it
   starts as one bucket, overfull buckets split at the next key bit, and the directory doubles when a bucket
   as deep as itself splits.
2. A bucket that is overfull at the greatest depth, because of a text with very many copies, gets a chain of pages; its rows are dealt over
   them by doc_id.
3. Owner tasks take ranges of keys, as runs of pages of about equal bytes. A page at a time, an owner
   chains the entries that share a key, compares bytes along the chain, and appends the page
   (a table of entries and the compressed text of each) to its index file in the shared folder.
4. Entries of one key on several pages of a chain are compared as well, by their bytes in the index files,
   and become one group.

``build`` returns the groups and the open index; ``Index.find`` looks up any text in the files.

Scale. Each text is read twice and shuffled once. A page holds at most CAPACITY bytes of text, or 2**-19 of all bytes where
that is more (190 MB at 100 TB), so an owner's memory is bounded and a chain has at most 2**19 pages in all, which bounds the
entries of a key that step 4 sees in one task. The directory has at most 2**MAX_DEPTH slots of 4 bytes. Joins are on
entries, which have at most a page of members.

Recovery. Owners report their files in their result rows, which are stored before anything reads the index, so files of
failed attempts are never read. Rows are dealt by their content alone.

Edge cases. Null text is empty; empty texts are equal. A null doc_id comes after all others, and keep_id is null
where a group has no other. Of rows with equal texts and the same least doc_id one is kept; all carry that keep_id.
White space at the ends becomes a space, it is not removed. An empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keelson.llm.common import attempt_name, filesystem, make_folder, new_folder, read, ship, shuffle_partitions, stored

MAGIC = b"KXHI0001"
MAX_DEPTH = 21
CAPACITY = 4 << 20  # bytes of text on a page
MOST_PAGES = 1 << 19
LEVEL = 1
SLICE_BYTES = 8 << 20  # of texts in a batch of rows
ENTRY = np.dtype([("key", "<u8"), ("doc_id", "<i8"), ("null", "<u8"), ("rows", "<i8"), ("offset", "<i8"), ("length", "<i8")])

_BLANK = bytes(0x20 if 0x09 <= b <= 0x0D else b for b in range(256))
_RUN = re.compile(rb" {2,}")


def normalised(text: bytes) -> bytes:
    """Each run of white space as one space."""
    flat = text.translate(_BLANK)
    return _RUN.sub(b" ", flat) if b"  " in flat else flat


def key_of(digest: bytes, bits: int) -> int:
    """The first ``bits`` bits of the digest, left-aligned in 64 bits."""
    return int.from_bytes(digest[:8], "big") >> (64 - bits) << (64 - bits)


@dataclass
class Directory:
    """Key prefixes to buckets, and buckets to their chains of pages."""

    depth: int
    slots: np.ndarray  # 2**depth bucket numbers
    local: list[tuple[int, int]]  # per bucket its depth and prefix
    first_page: np.ndarray  # per bucket, pages numbered in key order; one more at the end
    owner: np.ndarray  # per page
    capacity: int

    def bucket(self, key: int) -> int:
        return int(self.slots[key >> (64 - self.depth)]) if self.depth else 0

    def page(self, key: int, doc_id: int | None) -> int:
        """The page for a row: buckets with a chain deal their rows by doc_id."""
        b = self.bucket(key)
        first, pages = int(self.first_page[b]), int(self.first_page[b + 1] - self.first_page[b])
        if pages == 1:
            return first
        return first + (((doc_id or 0) * 0x9E3779B97F4A7C15 & (1 << 64) - 1) >> 32) % pages


def directory(cells: np.ndarray, owners: int, capacity: int) -> Directory:
    """The directory for ``cells``, the bytes of text under each prefix of the greatest depth."""
    levels = [cells]
    while len(levels[-1]) > 1:
        levels.append(levels[-1].reshape(-1, 2).sum(axis=1))
    levels.reverse()
    deepest, total = len(levels) - 1, int(levels[0][0])
    capacity = max(capacity, -(-total // MOST_PAGES))
    depth, slots, local = 0, np.zeros(1, np.int32), [(0, 0)]
    full = [0]
    while full := [b for b in full if local[b][0] < deepest and levels[local[b][0]][local[b][1]] > capacity]:
        if local[full[0]][0] == depth:  # buckets that split in one round are equally deep
            slots, depth = np.repeat(slots, 2), depth + 1
        halves = []
        for b in full:
            d, prefix = local[b]
            local[b] = (d + 1, 2 * prefix)
            halves += [b, len(local)]
            span = 1 << (depth - d - 1)
            slots[(2 * prefix + 1) * span : (2 * prefix + 2) * span] = len(local)
            local.append((d + 1, 2 * prefix + 1))
        full = halves
    # number the buckets in key order, so that owners get ranges of keys
    order = sorted(range(len(local)), key=lambda b: local[b][1] << (deepest - local[b][0]))
    rank = np.empty(len(order), np.int32)
    rank[order] = np.arange(len(order), dtype=np.int32)
    slots, local = rank[slots], [local[b] for b in order]
    sizes = np.array([int(levels[d][p]) for d, p in local])
    pages = np.maximum(1, -(-sizes // capacity))
    each = np.repeat(sizes / pages, pages)
    middle = np.cumsum(each) - each / 2
    owner = np.minimum(owners - 1, (middle * owners / max(1, total)).astype(np.int64)).astype(np.int32)
    return Directory(depth, slots, local, np.concatenate([[0], np.cumsum(pages)]), owner, capacity)


def _column(batch: pa.RecordBatch, name: str) -> list[bytes]:
    return [t or b"" for t in batch.column(name).cast(pa.binary()).to_pylist()]


def weigh(docs: DataFrame, bits: int, deepest: int) -> np.ndarray:
    """The bytes of normalised text under each key prefix of ``deepest`` bits."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = np.zeros(1 << deepest, np.int64)
        for batch in batches:
            for text in _column(batch, "text"):
                text = normalised(text)
                # a byte more, so that empty texts weigh as well
                cells[key_of(hashlib.sha256(text).digest(), bits) >> (64 - deepest)] += len(text) + 1
        some = np.flatnonzero(cells)
        for i in range(0, len(some), 1 << 16):
            at = some[i : i + (1 << 16)]
            yield pa.RecordBatch.from_pydict({"cell": pa.array(at, pa.int64()), "bytes": pa.array(cells[at])})

    sums = docs.select("text").mapInArrow(scan, "cell long, bytes long").groupBy("cell").agg(F.sum("bytes").alias("bytes")).toPandas()
    cells = np.zeros(1 << deepest, np.int64)
    cells[sums["cell"].to_numpy(np.int64)] = sums["bytes"].to_numpy(np.int64)
    return cells


class Page:
    """The entries of one page: per key a chain of different texts."""

    def __init__(self) -> None:
        self.chains: dict[int, list[int]] = {}
        self.texts: list[bytes] = []
        self.digests: list[bytes] = []
        self.keys: list[int] = []
        self.least: list[int | None] = []
        self.stays: list[int] = []  # the row that stays of each entry
        self.rows: list[int] = []
        self.ids: list[int | None] = []
        self.of: list[int] = []  # the entry of each row

    def add(self, doc_id: int | None, key: int, digest: bytes, text: bytes) -> None:
        chain = self.chains.setdefault(key, [])
        for e in chain:
            if self.texts[e] == text:
                break
        else:
            e = len(self.texts)
            chain.append(e)
            self.texts.append(text)
            self.digests.append(digest)
            self.keys.append(key)
            self.least.append(doc_id)
            self.stays.append(len(self.ids))
            self.rows.append(0)
        if doc_id is not None and (self.least[e] is None or doc_id < self.least[e]):
            self.least[e], self.stays[e] = doc_id, len(self.ids)
        self.rows[e] += 1
        self.of.append(e)
        self.ids.append(doc_id)


OWNED = (
    "kind string, doc_id long, text_sha256 string, keep_id long, group_size long, stays boolean, entry long, "
    "page int, key long, path string, offset long, length long"
)
_SCHEMA = pa.schema(
    [("kind", pa.string()), ("doc_id", pa.int64()), ("text_sha256", pa.string()), ("keep_id", pa.int64()), ("group_size", pa.int64()), ("stays", pa.bool_()),
     ("entry", pa.int64()), ("page", pa.int32()), ("key", pa.int64()), ("path", pa.string()), ("offset", pa.int64()), ("length", pa.int64())]
)


def _rows(kind: str, n: int, **columns) -> pa.RecordBatch:
    columns["kind"] = [kind] * n
    return pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(n, f.type) for f in _SCHEMA], schema=_SCHEMA)


def _signed(key: int) -> int:
    return key - (1 << 64) if key >> 63 else key


class Writer:
    """An owner's index file, written from start to end."""

    def __init__(self, folder: str, owner: int):
        self.fs, path = filesystem(folder)
        name = attempt_name(f"owner-{owner:06d}", ".kxhi")
        self.uri, self.file = f"{folder}/{name}", self.fs.open_output_stream(f"{path}/{name}")
        self.file.write(MAGIC)
        self.at, self.entries, self.owner = len(MAGIC), 0, owner
        self.press = zstandard.ZstdCompressor(level=LEVEL)

    def write(self, number: int, chained: bool, page: Page) -> Iterator[pa.RecordBatch]:
        table = np.zeros(len(page.texts), ENTRY)
        for e, text in enumerate(page.texts):
            frame = self.press.compress(text)
            self.file.write(frame)
            least = page.least[e]
            table[e] = (page.keys[e], least or 0, least is None, page.rows[e], self.at, len(frame))
            self.at += len(frame)
        self.file.write(table.tobytes())
        names = [self.owner << 32 | self.entries + e for e in range(len(table))]
        self.entries += len(table)
        hexes = [d.hex() for d in page.digests]
        stays = set(page.stays)
        yield _rows("page", 1, page=[number], path=[self.uri], offset=[self.at], length=[len(table)])
        self.at += table.nbytes
        if chained:
            yield _rows(
                "entry", len(table), page=[number] * len(table), key=[_signed(k) for k in page.keys], entry=names, path=[self.uri] * len(table),
                keep_id=page.least, group_size=page.rows, offset=table["offset"], length=table["length"],
            )
        yield _rows(
            "chained" if chained else "row", len(page.ids), doc_id=page.ids, text_sha256=[hexes[e] for e in page.of], keep_id=[page.least[e] for e in page.of],
            group_size=[page.rows[e] for e in page.of], stays=[i in stays for i in range(len(page.ids))], entry=[names[e] for e in page.of],
        )


def _read_at(uri: str, offset: int, length: int, files: dict) -> bytes:
    if uri not in files:
        if len(files) >= 64:
            files.pop(next(iter(files))).close()
        fs, path = filesystem(uri)
        files[uri] = fs.open_input_file(path)
    return files[uri].read_at(length, offset)


@dataclass
class Index:
    """A built index: the directory, and the owners' files with a row for each page."""

    folder: str
    directory: Directory
    owned: DataFrame
    bits: int = 64
    _pages: dict = field(default_factory=dict)

    def find(self, text: str | None) -> tuple[int | None, int] | None:
        """(least doc_id, rows) of the documents equal to ``text``, read from the files; None if there is none."""
        plain = normalised((text or "").encode())
        key = key_of(hashlib.sha256(plain).digest(), self.bits)
        b = self.directory.bucket(key)
        numbers = list(range(int(self.directory.first_page[b]), int(self.directory.first_page[b + 1])))
        rows = self.owned.where((F.col("kind") == "page") & F.col("page").between(numbers[0], numbers[-1])).select("path", "offset", "length").collect()
        ids, total, files = [], 0, {}
        for r in rows:
            table = np.frombuffer(_read_at(r.path, r.offset, r.length * ENTRY.itemsize, files), ENTRY)
            for e in table[table["key"] == np.uint64(key)]:
                if zstandard.ZstdDecompressor().decompress(_read_at(r.path, int(e["offset"]), int(e["length"]), files)) == plain:
                    total += int(e["rows"])
                    ids += [] if e["null"] else [int(e["doc_id"])]
        return (min(ids, default=None), total) if total else None


def _one_of_chains(entries: DataFrame) -> DataFrame:
    """(entry, keep, size, best): the groups that entries on the pages of a chain make together.

    The entries of a key come in a row, one per page at most and text; their bytes are read from the index files.
    """

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files: dict = {}
        unpress = zstandard.ZstdDecompressor()
        key, groups = None, []  # per different text of the key: the text and its entries

        def done() -> pa.RecordBatch:
            out = []
            for _, own in groups:
                best = min(own, key=lambda x: (x[1] is None, x[1], x[0]) if x[1] is not None else (True, 0, x[0]))
                size = sum(x[2] for x in own)
                out += [(x[0], best[1], size, x[0] == best[0]) for x in own]
            return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out, strict=True), (pa.int64(), pa.int64(), pa.int64(), pa.bool_()), strict=True)], ["entry", "keep", "size", "best"])

        for batch in batches:
            for row in batch.to_pylist():
                if row["key"] != key:
                    if groups:
                        yield done()
                    key, groups = row["key"], []
                text = unpress.decompress(_read_at(row["path"], row["offset"], row["length"], files))
                one = (row["entry"], row["keep_id"], row["group_size"])
                for known, own in groups:
                    if known == text:
                        own.append(one)
                        break
                else:
                    groups.append((text, [one]))
        if groups:
            yield done()

    n = shuffle_partitions(entries.sparkSession)
    dealt = entries.select("key", "entry", "keep_id", "group_size", "path", "offset", "length").repartition(n, "key").sortWithinPartitions("key", "entry")
    return dealt.mapInArrow(compare, "entry long, keep long, size long, best boolean")


def build(docs: DataFrame, folder: str | None = None, capacity: int = CAPACITY, bits: int = 64, max_depth: int = MAX_DEPTH) -> tuple[DataFrame, Index]:
    """(one row per row of docs (doc_id, text), the index)."""
    spark = docs.sparkSession
    ship(spark)
    folder = folder or new_folder(spark, "exact-index")
    make_folder(folder)
    owners = shuffle_partitions(spark)
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    plan = directory(weigh(own, bits, max_depth), owners, capacity)
    shared = spark.sparkContext.broadcast(plan)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = shared.value
        for batch in batches:
            rows, size = [], 0
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), _column(batch, "text"), strict=True):
                text = normalised(text)
                digest = hashlib.sha256(text).digest()
                page = at.page(key_of(digest, bits), doc_id)
                rows.append((int(at.owner[page]), page, doc_id, digest, text))
                size += len(text)
                if size > SLICE_BYTES:
                    yield _dealt(rows)
                    rows, size = [], 0
            if rows:
                yield _dealt(rows)

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, out, number, page = shared.value, None, None, Page()
        chained = lambda p: (b := int(np.searchsorted(at.first_page, p, "right")) - 1) >= 0 and int(at.first_page[b + 1] - at.first_page[b]) > 1
        for batch in batches:
            digests, texts = batch.column("digest").to_pylist(), batch.column("text").to_pylist()
            for i, (owner, p, doc_id) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("owner", "page", "doc_id")), strict=True)):
                if out is None:
                    out = Writer(folder, owner)
                if p != number and number is not None:
                    yield from out.write(number, chained(number), page)
                    page = Page()
                number = p
                page.add(doc_id, key_of(digests[i], bits), digests[i], texts[i])
        if out is not None:
            yield from out.write(number, chained(number), page)
            out.file.close()

    dealt = own.mapInArrow(deal, "owner int, page int, doc_id long, digest binary, text binary")
    dealt = dealt.repartitionById(owners, "owner").sortWithinPartitions("page")
    owned = stored(dealt.mapInArrow(index, OWNED), "exact-owned")
    found = Index(folder, plan, owned, bits)
    rows = owned.where("kind = 'row'").select("doc_id", "keep_id", "group_size", F.col("stays").alias("kept"), "text_sha256")
    if len(plan.owner) == len(plan.local):  # no chain has a second page
        return rows, found
    one = stored(_one_of_chains(owned.where("kind = 'entry'")), "exact-chains")
    chained = owned.where("kind = 'chained'").join(one, "entry").select(
        "doc_id", F.col("keep").alias("keep_id"), F.col("size").alias("group_size"), (F.col("stays") & F.col("best")).alias("kept"), "text_sha256"
    )
    return rows.union(chained), found


def _dealt(rows: list[tuple]) -> pa.RecordBatch:
    types = (pa.int32(), pa.int32(), pa.int64(), pa.binary(), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows, strict=True), types, strict=True)], ["owner", "page", "doc_id", "digest", "text"])


def first_of_equal(docs: DataFrame) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 for every row of docs."""
    return build(docs)[0]


def op13_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of equal texts over all documents."""
    return first_of_equal(read(spark, sf_dir, "documents"))


ORACLE_SQL = r"""
WITH t AS (
    SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents
)
SELECT doc_id, min(doc_id) OVER same AS keep_id, CAST(count(*) OVER same AS BIGINT) AS group_size,
       doc_id = min(doc_id) OVER same AS kept, sha256(t) AS text_sha256
FROM t WINDOW same AS (PARTITION BY t)
"""

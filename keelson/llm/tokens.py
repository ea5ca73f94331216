"""Operator 4: token ids of documents in compressed binary shards.

Documents are encoded to token ids, id 0 closes each, and the ids are written
in ascending doc_id order to shard files. A shard holds one zstandard frame per document, all
compressed with one dictionary trained on serialized id arrays, so a single short
document can be read and decoded alone and still compresses well.

Shard file, little-endian::

    magic b"KTOK0001"
    frames                 one per document, ids as uint32
    index                  n rows of (doc_id int64, offset int64, length int64, n_tokens int64, null uint64)
    footer                 n int64, index offset int64, sha256 of the dictionary (32 bytes),
                           sha256 of the tokenizer file (32 bytes), magic

The dictionary is a file beside the shards, named by its hash. A reader
checks the hash before it decodes anything.

Scale. Texts are shuffled once, range-partitioned by doc_id; every task
encodes and writes one shard and reports one manifest row. The manifest is
stored before anything is read, so a lost executor costs
only its own tasks, and files of failed attempts are never listed. Places
of documents follow from a running sum over shards (one row each). Encoding keeps a bounded
per-worker table from chunks of text to their ids. Texts are cut only at a single space between two characters that are
not white space of any kind: there the tokenizer's splitting expression always starts a new piece, and merges stay within pieces
(a merge of spaces and other white space can reach over other spaces). Tokenizers that split in another way encode whole texts.

Edge cases. Null text is empty: the document is the closing id alone. A null
doc_id sorts first. Rows with the same doc_id are documents of their own, ordered by text. Strings of
special tokens in a text are ordinary text. An empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import json
import re
import struct
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from keelson.llm.common import attempt_name, filesystem, make_folder, new_folder, read, ship, shuffle_partitions, stored

MAGIC = b"KTOK0001"
END_ID = 0
FOOTER = "<qq32s32s8s"
INDEX = np.dtype([("doc_id", "<i8"), ("offset", "<i8"), ("length", "<i8"), ("n_tokens", "<i8"), ("null", "<u8")])
DICT_BYTES = 64 * 1024
DICT_DOCS = 300  # documents the dictionary is trained on, at most, whole
CACHED_CHUNKS = 800_000  # per worker
LEVEL = 1
SLICE_CHARS = 1 << 21  # of texts encoded at a time; a longer text is encoded alone


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def separable(definition: dict) -> bool:
    """Whether a tokenizer splits texts before each single space between two characters that are not white space.

    The byte-level splitting expression does: such a space starts a piece, and no merge reaches over two pieces.
    """
    split = definition.get("pre_tokenizer") or {}
    return definition.get("normalizer") is None and split.get("type") == "ByteLevel" and split.get("use_regex", True) and not split.get("add_prefix_space", True)


SPACE = "\u0120"  # how byte-level vocabularies write it

# White space as the splitting expression sees it, and more: where in doubt, a text is cut at fewer places.
_SPACES = r"\s\x0b\x1c-\x1f\x{85}\p{Z}"
_UNSAFE = f"^ | $|[{_SPACES}] | [{_SPACES}]"
_SAFE_SPACE = re.compile(r"(?<=\S) (?=\S)")


class Encoder:
    """Texts to arrays of ids, through the tokenizers library.

    Texts are cut into chunks at single spaces between two characters that are not white space; every chunk is encoded
    once, whole and with its space, and found in a table from then on.
    """

    def __init__(self, path: str):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs one task per core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        with open(path, encoding="utf-8") as f:
            self.separable = separable(json.load(f))
        names = self.tokenizer.get_vocab()
        self.spaced = np.zeros(max(names.values(), default=0) + 1, bool)  # ids of tokens that start with a space
        self.spaced[[i for name, i in names.items() if name.startswith(SPACE)]] = True
        self.known: dict[str, bytes] = {}  # by chunk, for one that follows a space

    def _ids(self, texts: list[str]) -> list[bytes]:
        return [array("I", e.ids).tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _after_spaces(self, chunks: list[str]) -> list[bytes]:
        """The ids of each chunk after a space: as one text of many chunks, taken apart where tokens start with a space."""
        plain = [i for i, c in enumerate(chunks) if c and " " not in c and not c[0].isspace() and not c[-1].isspace()]
        if plain and len(plain) == len(chunks):
            ids = np.array(self.tokenizer.encode_batch_fast([" " + " ".join(chunks)], add_special_tokens=False)[0].ids, np.uint32)
            begins = np.flatnonzero(self.spaced[ids])
            if len(begins) == len(chunks):
                raw, ends = ids.tobytes(), np.append(begins, len(ids)) * 4
                return [raw[a:b] for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)]
            return self._ids([" " + c for c in chunks])
        out: list[bytes] = self._ids([" " + c for c in chunks]) if not plain else [b""] * len(chunks)
        if plain:
            for i, ids in zip(plain, self._after_spaces([chunks[i] for i in plain]), strict=True):
                out[i] = ids
            rest = sorted(set(range(len(chunks))) - set(plain))
            for i, ids in zip(rest, self._ids([" " + chunks[i] for i in rest]), strict=True):
                out[i] = ids
        return out

    def _of_chunks(self, chunks: list[str]) -> list[bytes]:
        """The ids of different chunks, each after a space."""
        known = self.known
        found = list(map(known.get, chunks))
        gaps = [i for i, ids in enumerate(found) if ids is None]
        for begin in range(0, len(gaps), 1 << 14):
            own = gaps[begin : begin + (1 << 14)]
            for i, ids in zip(own, self._after_spaces([chunks[i] for i in own]), strict=True):
                found[i] = ids
            if len(known) < CACHED_CHUNKS:
                known.update((chunks[i], found[i]) for i in own)
        return found

    def encode(self, texts: pa.Array) -> list[np.ndarray]:
        """The ids of each text; null is empty."""
        texts = pc.fill_null(texts, "")
        if not self.separable:
            return [np.frombuffer(x, np.uint32) for x in self._ids(texts.to_pylist())]
        split = pc.split_pattern(texts, " ")
        unsafe = np.flatnonzero(pc.match_substring_regex(texts, _UNSAFE).to_numpy(zero_copy_only=False))
        if len(unsafe):
            rows = split.to_pylist()
            for i in unsafe.tolist():
                rows[i] = _SAFE_SPACE.split(texts[i].as_py())
            split = pa.array(rows, pa.list_(pa.string()))
        offsets = split.offsets.to_numpy()
        words = split.flatten().dictionary_encode()
        index = words.indices.to_numpy()
        chunks = words.dictionary.to_pylist()
        heads = offsets[:-1]  # the first chunk of a text follows no space
        follows = np.ones(len(index), bool)
        follows[heads] = False
        used = np.zeros(len(chunks), bool)
        used[index[follows]] = True
        place = np.flatnonzero(used)
        table: list[bytes] = [b""] * len(chunks)
        for i, ids in zip(place.tolist(), self._of_chunks([chunks[i] for i in place.tolist()]), strict=True):
            table[i] = ids
        index = index.astype(np.int32)
        firsts = [chunks[i] for i in index[heads].tolist()]
        index[heads] = len(table) + np.arange(len(heads))
        table += self._ids(firsts)
        # gather the ids of all chunks in order
        lengths = np.fromiter(map(len, table), np.int64, len(table)) // 4
        flat = np.frombuffer(b"".join(table), np.uint32)
        starts = np.cumsum(lengths) - lengths
        each = lengths[index]
        ends = np.concatenate([[0], np.cumsum(each)])
        kind = np.int32 if ends[-1] < 1 << 31 else np.int64
        ids = flat[np.repeat((starts[index] - ends[:-1]).astype(kind), each) + np.arange(ends[-1], dtype=kind)]
        bounds = ends[offsets]
        return [ids[a:b] for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)]


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One encoder per worker process, kept between tasks."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def file_hash(path: str) -> bytes:
    with open(path, "rb") as f:
        return hashlib.sha256(f.read()).digest()


def train_dictionary(docs: DataFrame, tokenizer: str) -> bytes:
    """A dictionary from a bounded sample: the DICT_DOCS rows with the least hash of doc_id.

    Too few documents to train on give their plain ids as dictionary content.
    """
    sample = (
        docs.where("text is not null and text != ''")
        .select(F.xxhash64("doc_id").alias("h"), "text")
    )
    # the hashes decide first, without the texts, so that tasks send few of those
    last = sample.select("h").orderBy("h").limit(DICT_DOCS).agg(F.max("h")).first()[0]
    sample = sample.where(F.col("h") <= last).select("h", "text").limit(DICT_DOCS).collect() if last is not None else []
    sample.sort()
    samples = [ids.astype("<u4").tobytes() for ids in encoder(tokenizer).encode(pa.array([r.text for r in sample], pa.string()))]
    try:
        return zstandard.train_dictionary(DICT_BYTES, samples).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[:DICT_BYTES]


def zstd_dictionary(raw: bytes) -> zstandard.ZstdCompressionDict | None:
    return zstandard.ZstdCompressionDict(raw) if len(raw) >= 8 else None


def slices(texts: pa.Array) -> Iterator[tuple[int, int]]:
    """(first row, end row) of runs of at most SLICE_CHARS bytes, or one row."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy())
    i = 0
    while i < len(ends):
        j = max(i + 1, int(np.searchsorted(ends, (ends[i - 1] if i else 0) + SLICE_CHARS, "right")))
        yield i, j
        i = j


MANIFEST = "part int, path string, docs long, tokens long"
ROWS = "part int, doc_id long, before long, n_tokens long, ids_crc32 long"


def write_shards(docs: DataFrame, folder: str, tokenizer: str | None = None) -> DataFrame:
    """Write the shards of ``docs`` (doc_id, text) and return their manifest."""
    tokenizer = tokenizer or default_tokenizer()
    spark = docs.sparkSession
    ship(spark)
    raw = train_dictionary(docs, tokenizer)
    key = hashlib.sha256(raw).digest()
    make_folder(folder)
    fs, path = filesystem(folder)
    with fs.open_output_stream(f"{path}/{key.hex()}.zdict") as f:
        f.write(raw)
    named = file_hash(tokenizer)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        enc = encoder(tokenizer)
        d = zstd_dictionary(raw)
        press = zstandard.ZstdCompressor(level=LEVEL, dict_data=d) if d else zstandard.ZstdCompressor(level=LEVEL)
        end = struct.pack("<I", END_ID)
        fs, path = filesystem(folder)
        out, at, index, name = None, len(MAGIC), [], attempt_name(f"shard-{part:06d}", ".ktok")
        for batch in batches:
            for begin, upto in slices(batch.column("text")):
                piece = batch.slice(begin, upto - begin)
                ids = enc.encode(piece.column("text"))
                if out is None:
                    out = fs.open_output_stream(f"{path}/{name}")
                    out.write(MAGIC)
                rows = np.zeros(len(ids), INDEX)
                frames = []
                for i, (doc_id, one) in enumerate(zip(piece.column("doc_id").to_pylist(), ids, strict=True)):
                    frame = press.compress(one.astype("<u4").tobytes() + end)
                    rows[i] = (doc_id or 0, at, len(frame), len(one) + 1, doc_id is None)
                    at += len(frame)
                    frames.append(frame)
                out.write(b"".join(frames))
                index.append(rows)
        if out is None:
            return
        rows = np.concatenate(index)
        out.write(rows.tobytes())
        out.write(struct.pack(FOOTER, len(rows), at, key, named, MAGIC))
        out.close()
        yield pa.RecordBatch.from_pydict(
            {"part": pa.array([part], pa.int32()), "path": [f"{folder}/{name}"], "docs": [len(rows)], "tokens": [int(rows["n_tokens"].sum())]}
        )

    n = shuffle_partitions(spark)
    ordered = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    ordered = ordered.repartitionByRange(n, "doc_id").sortWithinPartitions("doc_id", "text")
    return stored(ordered.mapInArrow(write, MANIFEST), "tokens-manifest")


def open_shard(uri: str):
    """(file, index, dictionary hash) of a shard."""
    fs, path = filesystem(uri)
    f = fs.open_input_file(path)
    size = f.size()
    f.seek(size - struct.calcsize(FOOTER))
    n, at, key, _, magic = struct.unpack(FOOTER, f.read(struct.calcsize(FOOTER)))
    if magic != MAGIC:
        raise ValueError(f"{uri} is not a shard")
    f.seek(at)
    return f, np.frombuffer(f.read(n * INDEX.itemsize), INDEX), key


def shard_dictionary(uri: str, key: bytes) -> zstandard.ZstdCompressionDict | None:
    """The dictionary beside the shard, checked against the shard's hash."""
    fs, path = filesystem(f"{uri.rpartition('/')[0]}/{key.hex()}.zdict")
    with fs.open_input_stream(path) as f:
        raw = f.read()
    if hashlib.sha256(raw).digest() != key:
        raise ValueError(f"the dictionary of {uri} has another hash")
    return zstd_dictionary(raw)


def read_document(uri: str, i: int) -> np.ndarray:
    """The ids of the i-th document of a shard, without reading the others."""
    f, index, key = open_shard(uri)
    with f:
        f.seek(int(index["offset"][i]))
        frame = f.read(int(index["length"][i]))
    return np.frombuffer(zstandard.ZstdDecompressor(dict_data=shard_dictionary(uri, key)).decompress(frame), "<u4")


def read_shards(manifest: DataFrame) -> DataFrame:
    """Decode every document of the shards: doc_id, start, n_tokens, ids_crc32."""

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, uri in zip(batch.column("part").to_pylist(), batch.column("path").to_pylist(), strict=True):
                f, index, key = open_shard(uri)
                press = zstandard.ZstdDecompressor(dict_data=shard_dictionary(uri, key))
                f.seek(len(MAGIC))
                before = 0
                for begin in range(0, len(index), 1024):
                    rows = index[begin : begin + 1024]
                    crc, counts = [], []
                    for length in rows["length"].tolist():
                        ids = press.decompress(f.read(length))
                        crc.append(zlib.crc32(ids))
                        counts.append(len(ids) // 4)
                    counts = np.array(counts, np.int64)
                    if not np.array_equal(counts, rows["n_tokens"]):
                        raise ValueError(f"{uri}: the frames do not fit the index")
                    upto = before + np.cumsum(counts)
                    yield pa.RecordBatch.from_pydict(
                        {
                            "part": pa.array([part] * len(rows), pa.int32()),
                            "doc_id": pa.array(rows["doc_id"].copy(), pa.int64(), mask=rows["null"].astype(bool)),
                            "before": pa.array(upto - counts),
                            "n_tokens": pa.array(counts),
                            "ids_crc32": pa.array(crc, pa.int64()),
                        }
                    )
                    before = int(upto[-1])
                f.close()

    ship(manifest.sparkSession)
    n = shuffle_partitions(manifest.sparkSession)
    earlier = W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)  # one row per shard
    bases = manifest.select(F.col("part").alias("of"), F.coalesce(F.sum("tokens").over(earlier), F.lit(0)).alias("base"))
    rows = manifest.repartition(n, "part").mapInArrow(decode, ROWS)
    return rows.join(F.broadcast(bases), F.col("part") == F.col("of")).select(
        "doc_id", (F.col("base") + F.col("before")).alias("start"), "n_tokens", "ids_crc32"
    )


def encode_corpus(docs: DataFrame, folder: str | None = None, tokenizer: str | None = None) -> DataFrame:
    """Write the shards and read them back: one row per document."""
    folder = folder or new_folder(docs.sparkSession, "tokens")
    return read_shards(write_shards(docs, folder, tokenizer))


def op4_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as token ids in shards, then read back."""
    return encode_corpus(read(spark, sf_dir, "documents"))

"""Operator 1: WARC archives and their capture index, merged externally.

Writing: every page becomes a WARC/1.1 record, one gzip member each. Among
records with equal payloads of at least ``REVISIT_BYTES`` bytes the one with the smallest page_id
is a response and the others are revisits that carry only the HTTP header and
refer to it.

Reading back: each archive is parsed and yields one run, its captures sorted by
(URL key, timestamp, page_id), as a text file with a sparse index beside it.

Merging: key ranges are cut from a sample of the runs' keys, and one task
per range opens all runs, seeks to the start of its range through the sparse index,
and merges them with a loser tree. Tasks hold one line per run and nothing grows with the
data. A range may start or end inside a URL, so a URL with a third of all captures is spread over
many ranges. With more than ``FAN_IN`` runs, groups of about FAN_IN runs are merged
into longer ones first, a task for each group and range, so no pass has fewer tasks than there are ranges. Ranges in order, and captures in order inside them, are the global
order: columns ``part`` and ``seq``.

Files lie in the shared folder; a task attempt writes its own files and only those
listed in a stored manifest are read.

Edge cases. Null html is an empty payload. A null url has the key "-". Rows with a
null page_id are kept and count as the largest. Repeated rows are records of their own; all copies of
the smallest page_id are responses. An empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import bisect
import hashlib
import json
import zlib
from collections.abc import Callable, Iterable, Iterator
from datetime import datetime, timedelta, timezone
from urllib.parse import quote, urlsplit

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keelson.llm.common import attempt_name, dropped, filesystem, make_folder, new_folder, read, ship, shuffle_partitions, stored

REVISIT_BYTES = 100
ARCHIVE_BYTES = 1 << 30  # of payload per archive file
FAN_IN = 256  # runs merged at a time
SPARSE = 128  # captures between two entries of a run's sparse index
EPOCH = datetime(2024, 1, 1, tzinfo=timezone.utc)
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n"
GZIP = 31  # zlib window bits of a gzip member
NO_ID = (1 << 63) - 1  # sorts null page_ids last

# ---- records -------------------------------------------------------------


def url_key(url: str | None) -> str:
    """SURT-like sort key: host labels reversed, then path and query, in printable ASCII."""
    if not url:
        return "-"
    try:
        parts = urlsplit(url.strip())
        host = (parts.hostname or "").removeprefix("www.")
    except ValueError:
        return quote(url, safe="")
    rest = parts.path + ("?" + parts.query if parts.query else "")
    return quote(",".join(reversed(host.split("."))) + ")" + rest, safe="/,)?=&%:;@+~!*'(").lower()


def timestamp(page_id: int | None) -> str:
    """Capture time of a page without one: one second per page_id."""
    if page_id is None:
        return "99991231235959"
    return (EPOCH + timedelta(seconds=page_id % 3_000_000_000)).strftime("%Y%m%d%H%M%S")


def record_id(page_id: int | None) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def page_of(record: str) -> int | None:
    text = record.removeprefix("<urn:page:").removesuffix(">")
    return int(text) if text else None


def uri(url: str | None) -> str:
    """A url with what a URI forbids percent-encoded; what is already encoded stays."""
    return quote((url or "").strip(), safe=":/?#[]@!$&'()*+,;=%-._~")


def record_bytes(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    """One WARC record; ``refers_to`` makes it a revisit without the payload."""
    head = HTTP % len(payload)
    when = timestamp(page_id)
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: {record_id(page_id)}",
        f"WARC-Date: {when[:4]}-{when[4:6]}-{when[6:8]}T{when[8:10]}:{when[10:12]}:{when[12:]}Z",
        f"WARC-Target-URI: {uri(url)}",
        f"WARC-Payload-Digest: sha256:{hashlib.sha256(payload).hexdigest()}",
        "Content-Type: application/http;msgtype=response",
    ]
    if refers_to is not None:
        lines.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
        lines.append(f"WARC-Refers-To: {record_id(refers_to)}")
        payload = b""
    lines.append(f"Content-Length: {len(head) + len(payload)}")
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + head + payload + b"\r\n\r\n"


def members(f, size: int = 1 << 20) -> Iterator[tuple[int, int, bytes]]:
    """(offset, length, content) of each gzip member of a file, streaming."""
    at, held = 0, f.read(size)
    while held:
        un, out, used = zlib.decompressobj(GZIP), [], 0
        while True:
            out.append(un.decompress(held))
            if un.eof:
                used += len(held) - len(un.unused_data)
                held = un.unused_data or f.read(size)
                break
            used += len(held)
            held = f.read(size)
            if not held:
                raise ValueError("the archive ends inside a record")
        yield at, used, b"".join(out)
        at += used


def parse(record: bytes) -> dict:
    """The capture that a record describes; a response's digest is checked."""
    head, _, block = record.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = block[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    length = next(int(x[15:]) for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:"))
    digest = fields["WARC-Payload-Digest"].removeprefix("sha256:")
    kind = fields["WARC-Type"]
    if kind == "response" and (len(payload) != length or hashlib.sha256(payload).hexdigest() != digest):
        raise ValueError(f"{fields['WARC-Record-ID']}: the payload does not fit its digest")
    refers = page_of(fields["WARC-Refers-To"]) if "WARC-Refers-To" in fields else None
    return {"page_id": page_of(fields["WARC-Record-ID"]), "date": fields["WARC-Date"], "url": fields["WARC-Target-URI"], "bytes": length, "digest": digest, "type": kind, "refers": refers}


# ---- runs and their merge ------------------------------------------------

Key = tuple[str, str, int]


def line_key(line: str) -> Key:
    key, when, page, _ = line.split(" ", 3)
    return key, when, int(page)


class LoserTree:
    """k-way merge: each next item replays one path of log2(k) matches.

    Nodes 1..k-1 keep the loser of their match, node 0 the winner.
    """

    def __init__(self, runs: list[Iterator], key: Callable):
        self.runs, self.key, self.k = runs, key, len(runs)
        self.heads = [next(r, None) for r in runs]
        self.keys = [None if h is None else key(h) for h in self.heads]
        self.tree = [-1] * max(1, self.k)
        for i in range(self.k):
            self._play(i)

    def _beats(self, a: int, b: int) -> bool:
        """Does run a's head come before run b's? Empty runs come last, ties go to the earlier run."""
        x, y = self.keys[a], self.keys[b]
        if x is None or y is None:
            return y is None and (x is not None or a < b)
        return (x, a) < (y, b)

    def _play(self, i: int) -> None:
        node = (i + self.k) // 2
        while node > 0:
            other = self.tree[node]
            if other < 0:  # while building, the first to come waits here
                self.tree[node] = i
                return
            if self._beats(other, i):
                self.tree[node], i = i, other
            node //= 2
        self.tree[0] = i

    def __iter__(self) -> Iterator:
        while self.k:
            i = self.tree[0]
            if self.heads[i] is None:
                return
            yield self.heads[i]
            self.heads[i] = next(self.runs[i], None)
            self.keys[i] = None if self.heads[i] is None else self.key(self.heads[i])
            self._play(i)


def write_run(uri: str, lines: Iterable[str]) -> tuple[int, list[str]]:
    """Write sorted lines and their sparse index; (captures, the keys of every SPARSE-th from a place of the run's own on)."""
    fs, path = filesystem(uri)
    sparse, sample, at, n = [], [], 0, 0
    place = zlib.crc32(uri.encode()) % SPARSE
    with fs.open_output_stream(path) as f:
        buffer = []
        for line in lines:
            if n % SPARSE == 0:
                sparse.append([line.rsplit(" ", 1)[0], at])
                f.write(b"".join(buffer))
                buffer = []
            if n % SPARSE == place:
                sample.append(line.rsplit(" ", 1)[0])
            data = line.encode() + b"\n"
            buffer.append(data)
            at += len(data)
            n += 1
        f.write(b"".join(buffer))
    with fs.open_output_stream(path + ".idx") as f:
        f.write(json.dumps(sparse).encode())
    return n, sample


def run_lines(uri: str, first: Key | None, end: Key | None) -> Iterator[str]:
    """The lines of a run from key ``first`` up to, not including, ``end``."""
    fs, path = filesystem(uri)
    start = 0
    if first is not None:
        with fs.open_input_stream(path + ".idx") as f:
            sparse = json.loads(f.read())
        keys = [line_key(s[0] + " ") for s in sparse]
        start = sparse[max(0, bisect.bisect_left(keys, first) - 1)][1] if sparse else 0
    with fs.open_input_file(path) as f:
        f.seek(start)
        rest = b""
        while data := f.read(1 << 16):
            *lines, rest = (rest + data).split(b"\n")
            for raw in lines:
                line = raw.decode()
                key = line_key(line)
                if end is not None and key >= end:
                    return
                if first is None or key >= first:
                    yield line


# ---- Spark jobs ----------------------------------------------------------

PAGES = "page_id long, url string, html string"
ARCHIVES = "path string, records long"
RUNS = "path string, records long, keys array<string>"
CAPTURES = (
    "part int, seq long, url_key string, captured string, page_id long, payload_bytes long, payload_digest string, "
    "record_type string, refers_to long, archive string, offset long, length long"
)


def write_archives(pages: DataFrame, folder: str) -> DataFrame:
    """Write pages (page_id, url, html) as archives; the manifest of the files."""
    ship(pages.sparkSession)
    make_folder(folder)
    own = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
        F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"),
    )
    digests = own.where(F.octet_length("html") >= REVISIT_BYTES).select("page_id", F.sha2("html", 256).alias("digest"))
    digests = stored(digests, "warc-digests")
    first = digests.groupBy("digest").agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1 and first is not null")
    first = stored(first.select("digest", "first"), "warc-first")
    # only copies travel on, one row per page and payload, so nothing is hot below
    later = digests.join(first, "digest").where("page_id is null or page_id > first")
    later = stored(later.select(F.col("page_id").alias("of"), "digest", "first").distinct(), "warc-revisits")
    # the digest is recomputed only for pages that have a revisit row under their id
    match = F.col("page_id").eqNullSafe(F.col("of")) & (F.sha2("html", 256) == F.col("digest"))
    told = own.join(later, match, "left").select("page_id", "url", "html", "first")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, path = filesystem(folder)
        out, name, count, size, done = None, "", 0, 0, []
        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("page_id", "url", "html", "first")), strict=True):
                if out is None:
                    name, count, size = attempt_name("pages", ".warc.gz"), 0, 0
                    out = fs.open_output_stream(f"{path}/{name}")
                payload = row[2].encode()
                press = zlib.compressobj(5, zlib.DEFLATED, GZIP)
                out.write(press.compress(record_bytes(row[0], row[1], payload, row[3])) + press.flush())
                count, size = count + 1, size + len(payload)
                if size >= ARCHIVE_BYTES:
                    out.close()
                    out = None
                    done.append((name, count))
        if out is not None:
            out.close()
            done.append((name, count))
        if done:
            yield pa.RecordBatch.from_pydict({"path": [f"{folder}/{n}" for n, _ in done], "records": [c for _, c in done]})

    return stored(told.mapInArrow(write, ARCHIVES), "warc-archives")


def read_archives(archives: DataFrame, folder: str) -> DataFrame:
    """Parse archives into one sorted run each; the manifest of the runs."""
    ship(archives.sparkSession)
    make_folder(folder)

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for archive in batch.column("path").to_pylist():
                fs, path = filesystem(archive)
                lines = []
                with fs.open_input_stream(path) as f:
                    for offset, length, record in members(f):
                        c = parse(record)
                        page = NO_ID if c["page_id"] is None else c["page_id"]
                        when = "".join(x for x in c["date"] if x.isdigit())
                        rest = json.dumps([c["bytes"], c["digest"], c["type"], c["refers"], archive, offset, length], separators=(",", ":"))
                        key = url_key(c["url"])
                        lines.append(((key, when, page), f"{key} {when} {page} {rest}"))
                lines.sort()
                run = f"{folder}/{attempt_name('run', '.cdx')}"
                n, keys = write_run(run, (line for _, line in lines))
                yield pa.RecordBatch.from_pydict({"path": [run], "records": [n], "keys": pa.array([keys], pa.list_(pa.string()))})

    n = shuffle_partitions(archives.sparkSession)
    return stored(archives.repartition(n, "path").mapInArrow(index, RUNS), "warc-runs")


def key_ranges(runs: DataFrame, parts: int) -> list[Key | None]:
    """Bounds of ``parts`` key ranges that hold about as many captures each: None, the cuts in order, None.

    The sample is one key of SPARSE captures of every run, at a place that differs from run to run, so short runs count as well.
    """
    keys = runs.select(F.explode("keys").alias("key"))

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, at = TaskContext.get().partitionId(), 0
        for batch in batches:
            n = batch.num_rows
            yield pa.RecordBatch.from_pydict({"part": pa.array([part] * n, pa.int32()), "at": pa.array(range(at, at + n), pa.int64()), "key": batch.column("key")})
            at += n

    n = shuffle_partitions(runs.sparkSession)
    ranked = stored(keys.repartitionByRange(n, "key").sortWithinPartitions("key").mapInArrow(number, "part int, at long, key string"), "warc-keys")
    sizes = {r.part: r.n for r in ranked.groupBy("part").agg(F.count(F.lit(1)).alias("n")).collect()}
    total = sum(sizes.values())
    if not total:
        return [None, None]
    step, before = max(1, -(-total // parts)), 0
    bases = []
    for part in sorted(sizes):
        bases.append((part, before))
        before += sizes[part]
    rank = F.col("at") + F.col("before")
    ranked_all = ranked.join(F.broadcast(runs.sparkSession.createDataFrame(bases, "part int, before long")), "part")  # a row per partition
    cuts = sorted({line_key(r.key + " ") for r in ranked_all.where((rank > 0) & (rank % step == 0)).select("key").collect()})  # one per range
    dropped(ranked)
    return [None, *cuts, None]


def merged_range(paths: list[str], bounds: list[Key | None], part: int) -> Iterator[str]:
    """The lines of runs in one key range, in order."""
    return iter(LoserTree([run_lines(p, bounds[part], bounds[part + 1]) for p in paths], line_key))


def merge_pass(pieces: DataFrame, bounds: list[Key | None], folder: str) -> DataFrame:
    """Merge the runs of each (part, group) into one longer run of that key range: (part, path, records), a task each."""
    ship(pieces.sparkSession)
    shared = pieces.sparkSession.sparkContext.broadcast(bounds)  # one key per range

    def lengthen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, paths in zip(batch.column("part").to_pylist(), batch.column("paths").to_pylist(), strict=True):
                run = f"{folder}/{attempt_name(f'run-{part:06d}', '.cdx')}"
                n, _ = write_run(run, merged_range(sorted(paths), shared.value, part))
                yield pa.RecordBatch.from_pydict({"part": pa.array([part], pa.int32()), "path": [run], "records": [n]})

    grouped = pieces.groupBy("part", "group").agg(F.collect_list("path").alias("paths"))
    n = pieces.select("part", "group").distinct().count()
    return stored(grouped.repartition(max(1, n), "part", "group").mapInArrow(lengthen, "part int, path string, records long"), "warc-longer")


def merge_runs(runs: DataFrame, folder: str, fan_in: int = FAN_IN, parts: int | None = None) -> DataFrame:
    """All captures in global order, by loser-tree merges of the runs, every pass cut into key ranges."""
    spark = runs.sparkSession
    ship(spark)
    n = runs.count()
    bounds = key_ranges(runs, parts or shuffle_partitions(spark))
    pieces = runs.select(F.explode(F.sequence(F.lit(0), F.lit(len(bounds) - 2))).alias("part"), "path")
    while n > fan_in:
        n = -(-n // fan_in)
        before, pieces = pieces, merge_pass(pieces.withColumn("group", F.pmod(F.xxhash64("path"), F.lit(n))), bounds, folder).select("part", "path")
        dropped(before)
    shared = spark.sparkContext.broadcast(bounds)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, paths in zip(batch.column("part").to_pylist(), batch.column("paths").to_pylist(), strict=True):
                rows: list[tuple] = []
                for seq, line in enumerate(merged_range(sorted(paths), shared.value, part)):
                    key, when, page, rest = line.split(" ", 3)
                    page = None if int(page) == NO_ID else int(page)
                    rows.append((part, seq, key, when, page, *json.loads(rest)))
                    if len(rows) == 4096:
                        yield as_batch(rows)
                        rows = []
                if rows:
                    yield as_batch(rows)

    # one row per range, with the names of its runs; stored, so that ranges are one task each
    ranges = stored(pieces.groupBy("part").agg(F.collect_list("path").alias("paths")), "warc-ranges")
    return ranges.repartition(len(bounds) - 1, "part").mapInArrow(merge, CAPTURES)


def as_batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int32(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64()]
    names = [c.split()[0] for c in CAPTURES.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)


def captures(pages: DataFrame, folder: str | None = None) -> DataFrame:
    """Write pages as archives, read them back and merge their index."""
    folder = folder or new_folder(pages.sparkSession, "warc")
    runs = read_archives(write_archives(pages, folder), folder)
    return merge_runs(runs, folder)


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages through archives and the merged capture index."""
    return captures(read(spark, sf_dir, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url_key", "captured", "part", "seq"
    )

"""Operator 12: centroid clustering over subvector dictionaries, exact in integers.

Vectors of exactly 64 finite components become integers floor(1024 * x). Centroids start as the CLUSTERS vectors with the
least hash; each of ROUNDS rounds assigns every vector to the nearest centroid (ties: the smaller number) and
replaces every centroid that has vectors by their mean, rounded down.

1. Every task packs its vectors into stripes of up to STRIPE and encodes them without loss: dimensions are cut into
   blocks of equal length, and each block has a dictionary of its distinct subvectors and a code per vector. The block length of a
   stripe (1 to 64) is the cheapest by exact counts: dictionary entries whose distances must be computed
   plus codes to add up. Stripes are stored once.
2. Once per round, each dictionary entry's distance to the same block of every centroid is computed; a vector's
   distance is the sum over its codes. Distances are sums of integers, so they are exact and do not depend on the blocks.
3. The new centroids come from counts per (cluster, code), multiplied by the dictionary. Each task sends one
   row per cluster.

Scale. Vectors are read once and not shuffled; a round reads the stripes (their codes are 1 or 2 bytes) and sends CLUSTERS rows
of 65 numbers per task. Dictionaries belong to stripes, so nothing that grows with the data is broadcast or held
in one place, and a vector that a third of all rows share takes one dictionary entry per stripe. Only the
centroids (CLUSTERS x 64 numbers) come to the driver.

Edge cases. Null, short, long, partly null and non-finite vectors are not in the result. A null vec_id is clustered, and comes last as a
start. Repeated rows are vectors of their own. Fewer vectors than CLUSTERS make as many clusters. An empty table
gives no rows. Integers beyond 2**27 raise an error, because distances would not fit 64 bits. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keelson.llm.common import dropped, read, ship, stored

DIMENSIONS = 64
SCALE = 1024
CLUSTERS = 8
ROUNDS = 10
SEED = 3
STRIPE = 16_384  # vectors; codes fit 16 bits
LARGEST = 1 << 27


def integers(x: np.ndarray) -> np.ndarray:
    out = np.floor(SCALE * x.astype(np.float64))
    if out.size and np.abs(out).max() > LARGEST:
        raise ValueError(f"a component times {SCALE} is beyond {LARGEST}: squared distances would not fit 64 bits")
    return out.astype(np.int64)


def encoded(x: np.ndarray, clusters: int = CLUSTERS) -> tuple[int, list[np.ndarray], np.ndarray]:
    """(block length, dictionary per block, codes of shape (blocks, vectors)), the cheapest of all block lengths."""
    books, codes = [], []
    for j in range(x.shape[1]):
        values, code = np.unique(x[:, j], return_inverse=True)
        books.append(values[:, None])
        codes.append(code.astype(np.int64))
    best, length = None, 1
    while True:
        cost = clusters * (sum(map(len, books)) * length + len(codes) * len(x))
        if best is None or cost < best[0]:
            best = (cost, length, books, codes)
        if len(books) % 2:
            break
        # two blocks make one of twice the length: its entries are the pairs of codes that occur
        pairs = [np.unique(a * len(right) + b, return_inverse=True) for a, b, right in zip(codes[::2], codes[1::2], books[1::2], strict=True)]
        books = [np.hstack([left[p // len(right)], right[p % len(right)]]) for (p, _), left, right in zip(pairs, books[::2], books[1::2], strict=True)]
        codes = [c.astype(np.int64) for _, c in pairs]
        length *= 2
    _, length, books, codes = best
    return length, books, np.stack(codes).astype(np.uint16)


STRIPES = "length int, ids array<long>, sizes array<int>, entries array<int>, codes binary"


def _lists(values: np.ndarray, kind: pa.DataType) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), pa.array(values, kind))


def stripes(vectors: DataFrame) -> DataFrame:
    """The kept vectors (vec_id, embedding) as stored stripes."""
    ship(vectors.sparkSession)

    def pack(ids: pa.Array, x: np.ndarray) -> pa.RecordBatch:
        length, books, codes = encoded(x)
        entries = np.concatenate([b.ravel() for b in books])
        return pa.RecordBatch.from_pydict(
            {
                "length": pa.array([length], pa.int32()),
                "ids": pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids),
                "sizes": _lists(np.array([len(b) for b in books]), pa.int32()),
                "entries": _lists(entries, pa.int32()),
                "codes": pa.array([codes.tobytes()], pa.binary()),
            }
        )

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, parts, n = [], [], 0
        for batch in batches:
            x = integers(batch.column("embedding").flatten().to_numpy(zero_copy_only=False).reshape(-1, DIMENSIONS))
            for i in range(0, len(x), STRIPE):
                ids.append(batch.column("vec_id")[i : i + STRIPE])
                parts.append(x[i : i + STRIPE])
                n += len(parts[-1])
                if n >= STRIPE:
                    all_ids, whole = pa.concat_arrays(ids), np.concatenate(parts)
                    yield pack(all_ids[:STRIPE], whole[:STRIPE])
                    ids, parts, n = [all_ids[STRIPE:]], [whole[STRIPE:]], n - STRIPE
        if n:
            yield pack(pa.concat_arrays(ids), np.concatenate(parts))

    return stored(vectors.mapInArrow(scan, STRIPES), "centroid-stripes")


class Stripe:
    def __init__(self, row: dict):
        self.ids, self.length = row["ids"], row["length"]
        ends = np.cumsum([0, *row["sizes"]]) * self.length
        entries = np.array(row["entries"], np.int64)
        self.books = [entries[a:b].reshape(-1, self.length) for a, b in zip(ends[:-1], ends[1:], strict=True)]
        self.codes = np.frombuffer(row["codes"], np.uint16).reshape(len(self.books), -1)

    def nearest(self, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(cluster, squared distance) of each vector: the sum of its codes' distances."""
        total = np.zeros((self.codes.shape[1], len(centroids)), np.int64)
        for i, (book, code) in enumerate(zip(self.books, self.codes, strict=True)):
            block = centroids[:, i * self.length : (i + 1) * self.length]
            of_entry = np.stack([((book - c) ** 2).sum(axis=1) for c in block], axis=1)
            total += of_entry[code]
        cluster = total.argmin(axis=1)
        return cluster, total[np.arange(len(total)), cluster]

    def sums(self, cluster: np.ndarray, clusters: int) -> np.ndarray:
        """Per cluster the sum of its vectors: how often each entry occurs there, times the entry."""
        out = []
        for book, code in zip(self.books, self.codes, strict=True):
            times = np.bincount(cluster * len(book) + code, minlength=clusters * len(book)).reshape(clusters, -1)
            out.append(times @ book)
        return np.hstack(out)


def _stripes_of(batches: Iterator[pa.RecordBatch]) -> Iterator[Stripe]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield Stripe(batch.slice(i, 1).to_pylist()[0])


def next_centroids(packed: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """The centroids after one round."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = len(centroids)
        n, sums = np.zeros(k, np.int64), np.zeros((k, DIMENSIONS), np.int64)
        for stripe in _stripes_of(batches):
            cluster, _ = stripe.nearest(centroids)
            n += np.bincount(cluster, minlength=k)
            sums += stripe.sums(cluster, k)
        at = np.flatnonzero(n)
        if len(at):
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(at) + 1) * DIMENSIONS, pa.int32()), pa.array(sums[at].ravel()))
            yield pa.RecordBatch.from_pydict({"cluster": pa.array(at, pa.int32()), "n": pa.array(n[at]), "sums": lists})

    rows = packed.mapInArrow(scan, "cluster int, n long, sums array<long>")
    wide = lambda c: F.sum(c.cast("decimal(38,0)"))
    out = centroids.copy()
    for r in rows.groupBy("cluster").agg(wide(F.col("n")).alias("n"), *[wide(F.col("sums")[j]).alias(f"s{j}") for j in range(DIMENSIONS)]).collect():
        out[r.cluster] = [int(r[f"s{j}"]) // int(r.n) for j in range(DIMENSIONS)]
    return out


def assigned(packed: DataFrame, centroids: np.ndarray) -> DataFrame:
    """(vec_id, cluster, distance) of every vector."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for stripe in _stripes_of(batches):
            cluster, distance = stripe.nearest(centroids)
            yield pa.RecordBatch.from_pydict({"vec_id": pa.array(stripe.ids, pa.int64()), "cluster": pa.array(cluster, pa.int32()), "distance": pa.array(distance)})

    return stored(packed.mapInArrow(scan, "vec_id long, cluster int, distance long"), "centroid-assigned")


def usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, embedding) of the vectors with 64 finite components."""
    bad = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    own = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding")
    return own.where((F.size("embedding") == DIMENSIONS) & ~bad)


def starts(kept: DataFrame, clusters: int, seed: int) -> np.ndarray:
    hashed = kept.select(F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256).alias("h"), "embedding")
    rows = hashed.orderBy(F.asc_nulls_last("h"), "embedding").limit(clusters).collect()
    return integers(np.array([r.embedding for r in rows], np.float64).reshape(-1, DIMENSIONS))


def clustered(vectors: DataFrame, clusters: int = CLUSTERS, rounds: int = ROUNDS, seed: int = SEED) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256 of every usable vector."""
    kept = usable(vectors)
    centroids = starts(kept, clusters, seed)
    packed = stripes(kept)
    for _ in range(rounds if len(centroids) else 0):
        centroids = next_centroids(packed, centroids)
    rows = assigned(packed, centroids)
    dropped(packed)
    sums = {r.cluster: int(r.s) for r in rows.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()}
    hashes = [hashlib.sha256(",".join(map(str, c.tolist())).encode()).hexdigest() for c in centroids]
    of = lambda values: F.create_map(*[F.lit(x) for x in chain(*values)]) if values else F.lit(None)
    inertia = of([(k, s) for k, s in sums.items()])
    digest = of([(k, hashes[k]) for k in sums])
    cluster = F.col("cluster")
    return rows.select(
        "vec_id", "cluster", "distance",
        (inertia[cluster] if sums else inertia).cast("long").alias("cluster_inertia"),
        F.lit(sum(sums.values())).cast("long").alias("inertia"),
        (digest[cluster] if sums else digest).cast("string").alias("centroid_sha256"),
    )


def op12_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clusters of all embeddings."""
    return clustered(read(spark, sf_dir, "embeddings"))


def _sql() -> str:
    """One pair of tables per round: the assignment a and the next centroids c."""
    distance = "list_sum(list_transform(list_zip(e.v, c.v), lambda p: (p[1] - p[2]) * (p[1] - p[2])))"
    parts = [
        f"""e AS MATERIALIZED (
    SELECT vec_id, list_transform(embedding, lambda x: CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
    WHERE len(embedding) = {DIMENSIONS} AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
)""",
        f"""c0 AS MATERIALIZED (
    SELECT row_number() OVER (ORDER BY h) - 1 AS k, v FROM (SELECT sha256('{SEED}:' || CAST(vec_id AS VARCHAR)) AS h, v FROM e) ORDER BY h LIMIT {CLUSTERS}
)""",
    ]
    for i in range(ROUNDS + 1):
        parts.append(f"""a{i} AS MATERIALIZED (
    SELECT e.vec_id, any_value(e.v) AS v, arg_min(c.k, d * {CLUSTERS} + c.k) AS k, min(d) AS d
    FROM e, c{i} c, LATERAL (SELECT CAST({distance} AS BIGINT) AS d) GROUP BY e.vec_id
)""")
        if i < ROUNDS:
            parts.append(f"""c{i + 1} AS MATERIALIZED (
    SELECT c.k, coalesce(m.v, c.v) AS v FROM c{i} c LEFT JOIN (
        SELECT k, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY j) AS v FROM (
            SELECT k, j, sum(x) AS s, count(*) AS n FROM (SELECT k, unnest(v) AS x, unnest(range({DIMENSIONS})) AS j FROM a{i}) GROUP BY k, j
        ) GROUP BY k
    ) m USING (k)
)""")
    return "WITH " + ", ".join(parts) + f"""
SELECT a.vec_id, CAST(a.k AS INTEGER) AS cluster, a.d AS distance, CAST(sum(a.d) OVER (PARTITION BY a.k) AS BIGINT) AS cluster_inertia,
       CAST(sum(a.d) OVER () AS BIGINT) AS inertia, sha256(array_to_string(c.v, ',')) AS centroid_sha256
FROM a{ROUNDS} a JOIN c{ROUNDS} c USING (k)
"""


ORACLE_SQL = _sql()

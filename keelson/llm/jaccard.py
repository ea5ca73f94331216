"""Operator 2: n-gram Jaccard join, size-aware, heavy and light sets apart.

A document's set is its distinct 5-word shingles, as 64-bit hashes. Two sets link
when ``100 * intersection >= 80 * union``.

1. Documents with equal sets form a class; from here on classes are joined, each through its document of least doc_id.
2. Tokens of a set are ordered rare first: by how many classes have them among the first tokens in hash order (exact counts, of which the
   HOT most frequent are fed back), then by hash. If two sets link, their first ``n - ceil(0.8 n) + c``
   tokens share at least ``c``; only those travel. Sets under 4 tokens link with equal sets only.
3. Tokens that one class alone has are dropped; the rest form inverted lists.
4. Light sets are joined by enumerating the 2-token subsets of their shared tokens,
   heavy ones by scanning the inverted lists. The boundary is the size class at which the
   subsets of the sets below plus the list entries scanned for those above cost
   least, from exact counts over all sets. Light sets within 0.8 of the boundary stand in the lists
   as well, where heavy ones find them.
5. A key (subset or list) of up to DENSE members proposes all its pairs. A denser one proposes its pivot with each other member. Proposed
   pairs are ruled out by bit signatures that bound their difference, and the rest verified on whole sets.
6. Dense keys whose members now lie in several components are open: their members meet in blocks, where the signatures of all pairs of
   different components are compared. A block sends a spanning forest of the pairs that may link, never the pairs, so every such pair
   lies inside one group of classes. The groups are compared exactly, as in 7, and each block sends a spanning forest of the links it
   finds. After these no link between components is missing.
7. The number of links needs pairs of one component only. Components of two classes have one; larger ones are compared exactly in
   blocks, a bit per shared token, and each block sends one count per member, never a row per pair.

``joined`` stops after 6, for callers that need components only; ``counted`` is the query; ``links`` gives the pairs themselves.

Scale. The text is read three times: for class keys, for the tokens in their order, and once more for the sets of the
classes in proposed pairs. Tokens travel once in hash order (a fifth of them) and once in the fed-back order. Rows per key are at most
DENSE / 2 for each member, and a block sends fewer rows than it has members. Blocks have at most BLOCK members and, on average, BLOCK_TOKENS tokens. The table of frequent tokens has at most
HOT rows, whatever the input. All stored tables but the result are deleted before it is returned.

Edge cases. Null or wordless texts have an empty set: n_shingles 0, no link, their own
component. Rows with a null doc_id are returned with the component of their class, or null.
Repeated rows are in one class. Ties do not arise: components take the least doc_id. Other columns are
ignored. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from keelson.llm.common import Scratch, read, ship, shuffle_partitions, stored
from keelson.llm.components import components
from keelson.llm.words import Words, chunks, mix

WORDS_IN_SHINGLE = 5
NUMERATOR, DENOMINATOR = 4, 5  # the similarity, 0.8
SUBSET = 2
LEAST = 4  # smaller sets link with equal ones only
HOT = 1 << 20  # tokens whose counts are fed back, at most
FREQUENT = 3  # classes that make a token one of them
LEVELS = 4  # of counts, per doubling
DENSE = 32  # members up to which a key proposes all pairs
BLOCK = 1024  # members of a block
BLOCK_TOKENS = 1 << 21
SIZE_CLASSES = 8  # per doubling of the size, for the cost
LEAST_BITS = 2048  # of a signature; longer sets have at least 2 bits for a token
COLUMNS = 1 << 14  # shared tokens compared at a time
NO_ID = (1 << 63) - 1  # in place of a null doc_id where one document is chosen


def prefix_length(n: int, c: int) -> int:
    return min(n, n - -(-NUMERATOR * n // DENOMINATOR) + c)


def _signed(x: np.ndarray) -> np.ndarray:
    return x.astype(np.uint64, copy=False).view(np.int64)


def class_key(s: np.ndarray) -> int:
    """64 bits for a set, whatever the order; sets of other sizes differ."""
    total = int(mix(s ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64))
    return int(_signed(mix(np.array([total], np.uint64) + np.uint64(len(s))))[0])


def parity(s: np.ndarray) -> np.ndarray:
    """Per hash bucket whether it holds an odd number of tokens, as bits in 64-bit words.

    Every bucket in which two sets differ holds a token of only one of them, so the differing bits are at most the
    size of the symmetric difference. The buckets are a power of two; halves folded together are the signature of half the length.
    """
    bits = max(LEAST_BITS, 1 << (2 * len(s) - 1).bit_length()) if len(s) else LEAST_BITS
    counts = np.bincount((s & np.uint64(bits - 1)).astype(np.int64), minlength=bits)
    return np.packbits((counts & 1).astype(np.uint8)).view(np.int64)


def _array(parts: list[np.ndarray], kind: pa.DataType | None = None) -> pa.Array:
    ends = np.cumsum([0, *map(len, parts)])
    values = np.concatenate(parts) if parts else np.zeros(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values, kind or pa.int64()))


PROFILE = "rid long, doc_id long, n_shingles long, cls long, parity array<long>, head array<long>"


def profile(docs: DataFrame) -> DataFrame:
    """One row per document: size, class key, signature and the first tokens in hash order."""
    ship(docs.sparkSession)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, data, offsets in chunks(batch.column("text")):
                sets = Words(data, offsets, lower=True).shingle_sets(WORDS_IN_SHINGLE)
                yield pa.RecordBatch.from_pydict(
                    {
                        "rid": batch.column("rid").slice(i, j - i),
                        "doc_id": batch.column("doc_id").slice(i, j - i),
                        "n_shingles": pa.array([len(s) for s in sets], pa.int64()),
                        "cls": pa.array([class_key(s) if len(s) else None for s in sets], pa.int64()),
                        "parity": _array([parity(s) for s in sets]),
                        "head": _array([_signed(s[: prefix_length(len(s), 1)]) if len(s) >= LEAST else np.zeros(0, np.int64) for s in sets]),
                    }
                )

    return docs.mapInArrow(scan, PROFILE)


def frequent_tokens(counted: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Tokens, ascending, and their levels, from a stored table (token, level): the highest levels that make up HOT rows at most."""
    rows = sorted(((r.level, r.tokens) for r in counted.groupBy("level").agg(F.count(F.lit(1)).alias("tokens")).collect()), reverse=True)
    least, total = None, 0
    for level, tokens in rows:
        total += tokens
        if total > HOT:
            break
        least = level
    if least is None:
        return np.zeros(0, np.uint64), np.zeros(0, np.uint8)
    got = counted.where(F.col("level") >= least).toPandas()
    tokens = got["token"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(tokens)
    return tokens[order], got["level"].to_numpy(np.uint8)[order]


def prefixes(docs: DataFrame, hot: tuple[np.ndarray, np.ndarray]) -> DataFrame:
    """(rid, cls, n, tokens): the first tokens of every set of at least LEAST tokens, rare first.

    The order is by how frequent the token is, then by hash: a function of the token alone, so it is the same in all sets.
    """
    ship(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(hot)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, levels = shared.value
        for batch in batches:
            for i, j, data, offsets in chunks(batch.column("text")):
                rows, keys, sizes, heads = [], [], [], []
                sets = Words(data, offsets, lower=True).shingle_sets(WORDS_IN_SHINGLE)
                each = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
                level = np.zeros(len(each), np.uint8)
                if len(known) and len(each):
                    at = np.minimum(np.searchsorted(known, each), len(known) - 1)
                    level = np.where(known[at] == each, levels[at], 0)
                begin = 0
                for row, s in enumerate(sets):
                    own, begin = level[begin : begin + len(s)], begin + len(s)
                    if len(s) >= LEAST:
                        upto = prefix_length(len(s), SUBSET)
                        rows.append(row)
                        keys.append(class_key(s))
                        sizes.append(len(s))
                        heads.append(_signed(s[np.argsort(own, kind="stable")[:upto]] if own[:upto].any() else s[:upto]))
                if rows:
                    rid = batch.column("rid").slice(i, j - i).take(pa.array(rows))
                    yield pa.RecordBatch.from_pydict({"rid": rid, "cls": pa.array(keys, pa.int64()), "n": pa.array(sizes, pa.int32()), "tokens": _array(heads)})

    return docs.mapInArrow(scan, "rid long, cls long, n int, tokens array<long>")


def sets_of(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(cls, n, items) of the documents whose rid is in ``wanted``."""
    ship(docs.sparkSession)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, data, offsets in chunks(batch.column("text")):
                sets = Words(data, offsets, lower=True).shingle_sets(WORDS_IN_SHINGLE)
                yield pa.RecordBatch.from_pydict(
                    {
                        "cls": pa.array([class_key(s) if len(s) else None for s in sets], pa.int64()),
                        "n": pa.array([len(s) for s in sets], pa.int32()),
                        "items": _array([_signed(s) for s in sets]),
                    }
                )

    text = docs.join(wanted.select("rid"), "rid", "left_semi").select("text")
    return text.mapInArrow(scan, "cls long, n int, items array<long>")


def _similar_sizes(a: Column, b: Column) -> Column:
    return F.least(a, b) * DENOMINATOR >= F.greatest(a, b) * NUMERATOR


def boundary(shared: DataFrame) -> int:
    """The largest light size: the cheapest cut over size classes.

    Costs in rows: a light set enumerates the pairs of its shared tokens, a heavy one scans the
    lists of its own, or meets the pivot of a dense one. One row per size class comes to the driver, at most 8 per doubling.
    """
    scanned = F.when(F.col("listed") <= DENSE, F.col("listed")).otherwise(2)
    per_set = shared.groupBy("cls", "n").agg(F.count(F.lit(1)).alias("m"), F.sum(F.when(F.col("own"), scanned).otherwise(0)).alias("scan"))
    bins = per_set.groupBy(F.floor(F.log2("n") * SIZE_CLASSES).cast("int").alias("bin")).agg(
        F.max("n").alias("n"), F.sum(F.col("m") * (F.col("m") - 1) / 2).alias("light"), F.sum("scan").alias("heavy")
    )
    rows = sorted((r.n, float(r.light), float(r.heavy)) for r in bins.collect())
    costs = [(sum(r[1] for r in rows[:i]) + sum(r[2] for r in rows[i:]), i) for i in range(len(rows) + 1)]
    best = min(costs)[1]
    return rows[best - 1][0] if best else 0


@dataclass
class Classes:
    """docs: (rid, doc_id, text); documents: (rid, doc_id, n_shingles, cls); reps: (cls, rid, n, rows, parity);
    keys: (key, cls, n, heavy, scan, members), a row for each class in each key."""

    docs: DataFrame
    documents: DataFrame
    reps: DataFrame
    keys: DataFrame


def classes(docs: DataFrame, scratch: Scratch) -> Classes:
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    own = own.withColumn("rid", F.coalesce("doc_id", F.lit(NO_ID)))
    profiled = scratch.stored(profile(own), "join-profile")
    # one document stands for its class: the least doc_id, or a null one if there is no other
    chosen = profiled.where("cls is not null").groupBy("cls").agg(F.min("rid").alias("rid"), F.count(F.lit(1)).alias("rows"))
    reps = profiled.where("cls is not null").join(chosen, ["rid", "cls"]).dropDuplicates(["rid", "cls"])
    reps = scratch.stored(reps.select("cls", "rid", F.col("n_shingles").cast("int").alias("n"), "rows", "parity", "head"), "join-reps")
    documents = scratch.stored(profiled.select("rid", "doc_id", "n_shingles", "cls"), "join-documents")
    scratch.drop(profiled)

    heads = reps.select(F.explode("head").alias("token")).groupBy("token").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= FREQUENT)
    levels = scratch.stored(heads.select("token", F.floor(F.log2("n") * LEVELS).cast("int").alias("level")), "join-frequent")
    hot = frequent_tokens(levels)
    scratch.drop(levels)

    ordered = prefixes(own, hot).join(reps.select("rid", "cls"), ["rid", "cls"], "left_semi").dropDuplicates(["rid", "cls"])
    ordered = scratch.stored(ordered.select("cls", "n", "tokens"), "join-heads")
    listed = ordered.select(F.explode("tokens").alias("token")).groupBy("token").agg(F.count(F.lit(1)).cast("int").alias("listed")).where("listed > 1")
    listed = scratch.stored(listed, "join-listed")  # joins with stored tables on both sides are split by AQE where a key is hot
    one = F.col("n") - F.ceil(F.col("n") * NUMERATOR / F.lit(DENOMINATOR)) + 1
    tokens = ordered.select("cls", "n", F.posexplode("tokens").alias("pos", "token")).select("cls", "n", "token", (F.col("pos") < one).alias("own"))
    shared = scratch.stored(tokens.join(listed, "token"), "join-lists")
    scratch.drop(ordered, listed)
    upto = boundary(shared)

    light = shared.where(F.col("n") <= upto).groupBy("cls", "n").agg(F.sort_array(F.collect_set("token")).alias("t")).where("size(t) > 1")
    subsets = light.select(
        F.explode(
            F.flatten(F.transform("t", lambda x, i: F.transform(F.slice(F.col("t"), i + 2, F.size("t")), lambda y: F.xxhash64(x, y))))
        ).alias("key"),
        "cls", "n", F.lit(False).alias("heavy"), F.lit(False).alias("scan"),
    )
    scanned = shared.where(F.col("own") & (F.col("n") >= int(upto * NUMERATOR / DENOMINATOR)))
    lists = scanned.select(F.col("token").alias("key"), "cls", "n", (F.col("n") > upto).alias("heavy"), F.lit(True).alias("scan"))
    keys = scratch.stored(subsets.union(lists), "join-entries")
    members = scratch.stored(keys.groupBy("key").agg(F.count(F.lit(1)).alias("members")).where("members > 1"), "join-members")
    sized = scratch.stored(keys.join(members, "key"), "join-keys")
    scratch.drop(shared, keys, members)
    return Classes(own, documents, reps, sized)


def _differ(pa_: Column, pb: Column) -> Column:
    """The differing bits of two signatures, the longer one folded to the length of the shorter."""
    half = lambda p: (F.size(p) / 2).cast("int")
    fold = lambda p: F.zip_with(F.slice(p, F.lit(1), half(p)), F.slice(p, half(p) + 1, half(p)), lambda x, y: x.bitwiseXOR(y))
    a = F.when(F.size(pa_) > F.size(pb), fold(pa_)).otherwise(pa_)
    b = F.when(F.size(pb) > F.size(pa_), fold(pb)).otherwise(pb)
    bits = F.zip_with(a, b, lambda x, y: F.bit_count(x.bitwiseXOR(y)))
    return F.aggregate(bits, F.lit(0), lambda s, x: s + x)


class Verifier:
    """Verifies proposed pairs on whole sets, and keeps the sets it has read."""

    def __init__(self, c: Classes, scratch: Scratch):
        self.c, self.scratch, self.sets = c, scratch, []

    def all_sets(self) -> DataFrame:
        out = self.sets[0]
        for more in self.sets[1:]:
            out = out.union(more)
        return out

    def fetched(self, wanted: DataFrame) -> DataFrame:
        """All sets read so far, after those of the distinct ``cls`` in wanted."""
        c, scratch = self.c, self.scratch
        for known in self.sets:
            wanted = wanted.join(known.select("cls"), "cls", "left_anti")
        wanted = scratch.stored(wanted.join(c.reps.select("cls", "rid"), "cls"), "join-wanted")
        found = sets_of(c.docs, wanted).join(wanted.select("cls"), "cls", "left_semi").dropDuplicates(["cls"])
        self.sets.append(scratch.stored(found, "join-sets"))
        scratch.drop(wanted)
        return self.all_sets()

    def links(self, pairs: DataFrame) -> DataFrame:
        """The stored pairs (a, b) that link, with intersection and union."""
        c, scratch = self.c, self.scratch
        x, y = c.reps.selectExpr("cls as a", "n as na", "parity as pa"), c.reps.selectExpr("cls as b", "n as nb", "parity as pb")
        # 9 * (symmetric difference) <= n + m is the same condition; the signatures bound the difference from below
        near = pairs.join(x, "a").join(y, "b").where(_differ(F.col("pa"), F.col("pb")) * (NUMERATOR + DENOMINATOR) <= (F.col("na") + F.col("nb")) * (DENOMINATOR - NUMERATOR))
        near = scratch.stored(near.select("a", "b"), "join-near")
        sets = self.fetched(near.select(F.explode(F.array("a", "b")).alias("cls")).distinct())
        left = sets.select(F.col("cls").alias("a"), F.col("n").alias("na"), F.col("items").alias("ia"))
        right = sets.select(F.col("cls").alias("b"), F.col("n").alias("nb"), F.col("items").alias("ib"))
        both = near.join(left, "a").join(right, "b").withColumn("both", F.size(F.array_intersect("ia", "ib")))
        either = F.col("na") + F.col("nb") - F.col("both")
        linked = both.select("a", "b", "both", either.alias("either")).where(F.col("both") * DENOMINATOR >= F.col("either") * NUMERATOR)
        out = scratch.stored(linked.select("a", "b"), "join-links")
        scratch.drop(near)
        return out


def _proposed(keys: DataFrame, scratch: Scratch) -> DataFrame:
    """Distinct pairs (a, b): all of a small key, those with the pivot (the least hash) of a dense one."""
    small = keys.where(F.col("members") <= DENSE)
    x, y = small.alias("x"), small.alias("y")
    # light pairs meet in subsets, so lists skip them
    fits = F.expr("x.cls < y.cls and (not x.scan or x.heavy or y.heavy)") & _similar_sizes(F.col("x.n"), F.col("y.n"))
    pairs = x.join(y, (F.col("x.key") == F.col("y.key")) & fits).select(F.col("x.cls").alias("a"), F.col("y.cls").alias("b"))
    dense = keys.where(F.col("members") > DENSE)
    pivot = dense.groupBy("key").agg(F.min_by(F.struct("cls", "n"), F.xxhash64("cls")).alias("p"))
    pivot = scratch.stored(pivot.select("key", F.col("p.cls").alias("a"), F.col("p.n").alias("na")), "join-pivots")
    spokes = dense.join(pivot, "key").where((F.col("cls") != F.col("a")) & _similar_sizes(F.col("n"), F.col("na")))
    return pairs.union(spokes.select(F.least("a", "cls"), F.greatest("a", "cls"))).distinct()


def _blocked(rows: DataFrame, by: str, blocks: Column) -> DataFrame:
    """Rows of a group dealt to blocks by cls, and each block to its pairs with all blocks: columns lo, hi and block."""
    rows = rows.withColumn("blocks", blocks.cast("int")).withColumn("block", F.pmod(F.xxhash64("cls"), F.col("blocks")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    rows = rows.withColumns({"lo": F.least("block", "other"), "hi": F.greatest("block", "other")}).drop("blocks", "other")
    return rows.repartition(shuffle_partitions(rows.sparkSession), by, "lo", "hi").sortWithinPartitions(by, "lo", "hi")


def _groups(batches: Iterator[pa.RecordBatch], by: str) -> Iterator[pa.Table]:
    """The rows of each (by, lo, hi), from batches sorted by them."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        key = [batch.column(c).to_numpy(zero_copy_only=False) for c in (by, "lo", "hi")]
        edge = np.flatnonzero(np.any([k[1:] != k[:-1] for k in key], axis=0)) + 1
        for a, b in zip([0, *edge.tolist()], [*edge.tolist(), batch.num_rows], strict=True):
            if a == b:
                continue
            now = tuple(int(k[a]) for k in key)
            if now != last and held:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(a, b - a))
            last = now
    if held:
        yield pa.Table.from_batches(held)


def _numbers(table: pa.Table, name: str) -> np.ndarray:
    return table.column(name).to_numpy()


def _signatures(table: pa.Table) -> tuple[dict[int, np.ndarray], np.ndarray]:
    """(per length the signatures of the rows of that length, the length of each row's)."""
    column = table.column("parity").combine_chunks()
    lengths = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy().view(np.uint64)
    ends = np.cumsum(lengths)
    return {int(w): np.stack([flat[e - w : e] for e in ends[lengths == w]]) for w in np.unique(lengths)}, lengths


def _united(label: np.ndarray, i: int, others: np.ndarray) -> np.ndarray:
    """Gives i and the others one label; returns those of the others, one per label, that had another one than i."""
    labels, at = np.unique(label[others], return_index=True)
    fresh = labels != label[i]
    if fresh.any():
        label[np.isin(label, labels[fresh])] = label[i]
    return others[at[fresh]]


def _edges(forest: list[tuple[int, np.ndarray]], cls: np.ndarray) -> Iterator[pa.RecordBatch]:
    if forest:
        a = np.repeat([i for i, _ in forest], [len(x) for _, x in forest])
        yield pa.RecordBatch.from_pydict({"a": cls[a], "b": cls[np.concatenate([x for _, x in forest])]})


def _open_edges(keys: DataFrame, root: DataFrame, c: Classes, scratch: Scratch) -> DataFrame:
    """Edges (a, b) that connect all pairs in dense keys that lie in different components and that signatures do not rule out.

    A block sends a spanning forest of its pairs, so its rows are fewer than its members.
    """
    dense = keys.where(F.col("members") > DENSE).join(root, F.col("cls") == F.col("v"), "left").select("key", "cls", "n", "heavy", "scan", F.coalesce("root", "cls").alias("root"))
    dense = scratch.stored(dense, "join-placed")
    several = dense.groupBy("key").agg(F.min("root").alias("lo"), F.max("root").alias("hi"), F.count(F.lit(1)).alias("m")).where("lo != hi").select("key", "m")
    several = scratch.stored(several, "join-several")
    rows = dense.join(several, "key").join(c.reps.select("cls", "parity"), "cls")
    ship(rows.sparkSession)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _groups(batches, "key"):
            cls, n, root, heavy, scan, block = (_numbers(group, x) for x in ("cls", "n", "root", "heavy", "scan", "block"))
            lo, hi = int(group.column("lo")[0].as_py()), int(group.column("hi")[0].as_py())
            of_length, lengths = _signatures(group)
            place = np.zeros(len(cls), np.int64)
            for w in of_length:
                place[lengths == w] = np.arange((lengths == w).sum())
            label, out = np.arange(len(cls)), []
            first = np.flatnonzero(block == lo)
            for i in first.tolist():
                fits = (root != root[i]) & (label != label[i]) & (np.minimum(n, n[i]) * DENOMINATOR >= np.maximum(n, n[i]) * NUMERATOR) & (heavy | heavy[i] | ~scan)
                fits &= (block == hi) if lo != hi else (np.arange(len(cls)) > i)
                for w, all_of in of_length.items():
                    at = np.flatnonzero(fits & (lengths == w))
                    if not len(at):
                        continue
                    mine, theirs = of_length[int(lengths[i])][place[i]], all_of[place[at]]
                    while len(mine) > w:
                        mine = mine[: len(mine) // 2] ^ mine[len(mine) // 2 :]
                    while theirs.shape[1] > len(mine):
                        half = theirs.shape[1] // 2
                        theirs = theirs[:, :half] ^ theirs[:, half:]
                    differ = np.bitwise_count(theirs ^ mine).sum(axis=1, dtype=np.int64)
                    near = at[differ * (NUMERATOR + DENOMINATOR) <= (n[at].astype(np.int64) + n[i]) * (DENOMINATOR - NUMERATOR)]
                    fresh = _united(label, i, near)
                    if len(fresh):
                        out.append((i, fresh))
            yield from _edges(out, cls)

    out = scratch.stored(_blocked(rows, "key", F.ceil(F.col("m") / BLOCK)).mapInArrow(compare, "a long, b long"), "join-edges")
    scratch.drop(dense, several)
    return out


def _components(c: Classes, verify: Verifier, scratch: Scratch) -> DataFrame:
    """(v, root) of all classes that link."""
    proposed = scratch.stored(_proposed(c.keys, scratch), "join-pairs")
    found = verify.links(proposed)
    scratch.drop(proposed)
    root = scratch.own(components(found))
    edges = _open_edges(c.keys, root, c, scratch)
    if not edges.isEmpty():
        scratch.drop(root)
        near = scratch.own(components(edges))
        sets = verify.fetched(near.select(F.col("v").alias("cls")))
        more = _within(c, near, sets, _forest, "a long, b long", scratch, least=2)
        root = scratch.own(components(scratch.stored(found.union(more), "join-found")))
        scratch.drop(near)
    return root


def shared_tokens(items: list[np.ndarray], first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """How many tokens each set at ``first`` shares with each at ``second``: a bit per token that several sets have."""
    sizes = np.array([len(x) for x in items])
    tokens, column, times = np.unique(np.concatenate(items), return_inverse=True, return_counts=True)
    row = np.repeat(np.arange(len(items)), sizes)
    several = times[column] > 1
    row, column = row[several], (np.cumsum(times > 1) - 1)[column[several]]
    out = np.zeros((len(first), len(second)), np.int64)
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    for begin in range(0, int(column[-1]) + 1 if len(column) else 0, COLUMNS):
        a, b = np.searchsorted(column, [begin, begin + COLUMNS])
        width = -(-(int(column[b - 1]) - begin + 1) // 64) * 64
        dense = np.zeros((len(items), width), bool)
        dense[row[a:b], column[a:b] - begin] = True
        bits = np.packbits(dense, axis=1).view(np.uint64)
        theirs = bits[second]
        for i, r in enumerate(first.tolist()):
            out[i] += np.bitwise_count(theirs & bits[r]).sum(axis=1, dtype=np.int64)
    return out


def _within(c: Classes, placed: DataFrame, sets: DataFrame, emit: Callable, schema: str, scratch: Scratch, least: int = 3) -> DataFrame:
    """``emit`` over the blocks of every group of ``placed`` of three classes or more: cls, rows and n per member, and the matrix of links."""
    joined = sets.join(placed, F.col("cls") == F.col("v")).select("root", "cls", "n", "items").join(c.reps.select("cls", "rows"), "cls")
    size = joined.groupBy("root").agg(F.count(F.lit(1)).alias("m"), F.sum("n").alias("tokens")).where(F.col("m") >= least)
    rows = joined.join(scratch.stored(size, "join-sizes"), "root")
    ship(rows.sparkSession)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _groups(batches, "root"):
            cls, n, weight, block = (_numbers(group, x) for x in ("cls", "n", "rows", "block"))
            lo, hi = int(group.column("lo")[0].as_py()), int(group.column("hi")[0].as_py())
            column = group.column("items").combine_chunks()
            ends, flat = column.offsets.to_numpy(), column.values.to_numpy()
            items = [flat[a:b] for a, b in zip(ends[:-1], ends[1:], strict=True)]
            first, second = np.flatnonzero(block == lo), np.flatnonzero(block == hi)
            if not len(first) or not len(second):
                continue
            both = shared_tokens(items, first, second)
            either = n[first].astype(np.int64)[:, None] + n[second].astype(np.int64)[None, :] - both
            linked = both * DENOMINATOR >= either * NUMERATOR
            if lo == hi:
                np.fill_diagonal(linked, False)
            yield from emit(cls, weight, first, second, linked, both, either, lo == hi)

    blocks = F.greatest(F.ceil(F.col("m") / BLOCK), F.ceil(F.col("tokens") / BLOCK_TOKENS))
    return _blocked(rows, "root", blocks).mapInArrow(compare, schema)


def _counts(cls, weight, first, second, linked, both, either, same) -> Iterator[pa.RecordBatch]:
    yield pa.RecordBatch.from_pydict({"cls": cls[first], "linked": linked @ weight[second]})
    if not same:
        yield pa.RecordBatch.from_pydict({"cls": cls[second], "linked": linked.T @ weight[first]})


def _forest(cls, weight, first, second, linked, both, either, same) -> Iterator[pa.RecordBatch]:
    label = np.arange(len(cls))
    forest = [(i, _united(label, i, second[row])) for i, row in zip(first.tolist(), linked, strict=True)]
    yield from _edges(forest, cls)


def _pairs(cls, weight, first, second, linked, both, either, same) -> Iterator[pa.RecordBatch]:
    i, j = np.nonzero(np.triu(linked) if same else linked)
    yield pa.RecordBatch.from_pydict({"a": cls[first[i]], "b": cls[second[j]], "both": both[i, j], "either": either[i, j]})


def _placed(c: Classes, root: DataFrame, scratch: Scratch) -> DataFrame:
    """(cls, rows, root, component_id): the least doc_id of all classes of a component."""
    of = c.reps.join(root, F.col("cls") == F.col("v"), "left").select("cls", "rid", "rows", F.coalesce("root", "cls").alias("root"))
    of = scratch.stored(of, "join-of")
    least = of.groupBy("root").agg(F.min("rid").alias("least"), F.count(F.lit(1)).alias("classes"), F.sum("rows").alias("total"))
    least = scratch.stored(least, "join-least")
    out = scratch.stored(of.join(least, "root"), "join-components")
    scratch.drop(of, least)
    return out


def _result(c: Classes, placed: DataFrame, *more: str) -> DataFrame:
    """The documents with what their class has got; those without a class alone."""
    own = c.documents.where("cls is not null").join(placed, "cls").select("doc_id", "n_shingles", F.expr(f"nullif(least, {NO_ID}L)").alias("component_id"), *more)
    none = c.documents.where("cls is null").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"), *[F.lit(0).cast("long").alias(x) for x in more])
    return stored(own.union(none), "join-result")


def joined(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id for every row of docs (doc_id, text); stored."""
    with Scratch() as scratch:
        c = classes(docs, scratch)
        return _result(c, _placed(c, _components(c, Verifier(c, scratch), scratch), scratch))


def counted(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id and n_links, the number of other rows it links with, for every row of docs; stored."""
    with Scratch() as scratch:
        c = classes(docs, scratch)
        verify = Verifier(c, scratch)
        root = _components(c, verify, scratch)
        placed = _placed(c, root, scratch)
        counts = _within(c, root, verify.all_sets(), _counts, "cls long, linked long", scratch).groupBy("cls").agg(F.sum("linked").alias("linked"))
        # the rows of a class link with each other; two classes of a component link, or it would not be one
        alone = F.when(F.col("classes") <= 2, F.col("total") - F.col("rows")).otherwise(F.coalesce("linked", F.lit(0)))
        each = placed.join(counts, "cls", "left").select("cls", "least", (F.col("rows") - 1 + alone).alias("n_links"))
        return _result(c, scratch.stored(each, "join-counts"), "n_links")


def links(docs: DataFrame) -> DataFrame:
    """Every link between documents with different sets: a and b (least doc_ids of their classes), both, either; stored.

    Its rows are the links, so a group of m near copies has up to m * m / 2 of them.
    """
    with Scratch() as scratch:
        c = classes(docs, scratch)
        verify = Verifier(c, scratch)
        root = _components(c, verify, scratch)
        sets = verify.all_sets()
        found = _within(c, root, sets, _pairs, "a long, b long, both long, either long", scratch)
        size = root.groupBy("root").agg(F.count(F.lit(1)).alias("m"), F.min("v").alias("a"), F.max("v").alias("b")).where("m = 2")
        left, right = sets.selectExpr("cls as a", "n as na", "items as ia"), sets.selectExpr("cls as b", "n as nb", "items as ib")
        two = size.join(left, "a").join(right, "b").withColumn("both", F.size(F.array_intersect("ia", "ib")).cast("long"))
        found = found.union(two.select("a", "b", "both", (F.col("na") + F.col("nb") - F.col("both")).alias("either")))
        a, b = c.reps.selectExpr("cls as a", "rid as doc_a"), c.reps.selectExpr("cls as b", "rid as doc_b")
        ends = found.join(a, "a").join(b, "b").select(F.least("doc_a", "doc_b").alias("a"), F.greatest("doc_a", "doc_b").alias("b"), "both", "either")
        null = lambda x: F.expr(f"nullif({x}, {NO_ID}L)").alias(x)
        return stored(ends.select(null("a"), null("b"), "both", "either"), "join-found")


def one_of_each(docs: DataFrame) -> DataFrame:
    """The rows of docs whose doc_id is the least of its component; of repeated rows one."""
    found = joined(docs)
    with Scratch() as scratch:
        scratch.own(found)
        kept = found.where(F.col("doc_id").eqNullSafe(F.col("component_id"))).groupBy("doc_id").agg(F.count(F.lit(1)).alias("rows"))
        kept = stored(kept, "join-kept")
    stay = kept.select(F.col("doc_id").alias("kept_id"))
    rows = docs.join(stay, docs["doc_id"].eqNullSafe(stay["kept_id"]), "left_semi")
    # a doc_id that several rows share: rows with equal texts are one document
    return rows if kept.where("rows > 1").isEmpty() else rows.dropDuplicates(["doc_id", "text"])


def op2_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components and numbers of links of all documents under shingle similarity."""
    return counted(read(spark, sf_dir, "documents"))


ORACLE_SQL = r"""
WITH RECURSIVE w AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
    FROM documents
), s AS (
    SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 5 THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))
                                        WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS g
    FROM w
), n AS (
    SELECT w.doc_id, count(s.g) AS n FROM w LEFT JOIN s USING (doc_id) GROUP BY 1
), p AS (
    SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2
), l AS (
    SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 80 * (x.n + y.n - c)
), r AS (
    SELECT doc_id AS v, doc_id AS u FROM n UNION SELECT r.v, l.b FROM r JOIN l ON l.a = r.u
), d AS (
    SELECT a, count(*) AS links FROM l GROUP BY 1
)
SELECT n.doc_id, CAST(n.n AS BIGINT) AS n_shingles, CAST(min(r.u) AS BIGINT) AS component_id, CAST(coalesce(any_value(d.links), 0) AS BIGINT) AS n_links
FROM n JOIN r ON r.v = n.doc_id LEFT JOIN d ON d.a = n.doc_id GROUP BY n.doc_id, n.n
"""

"""Operator 11: how five filters interact, by the Hart-Mas-Colell potential.

Filters: A under 200 words; B distinct words under half of the words; C upper-case A-Z over 2% of the code points; D a character of
``#$%&*|``; E the text of a smaller doc_id. Words are maximal runs without white space, case-sensitive.

1. Every document gets a 5-bit mask of the filters it fails. A to D come from its text; E from the least doc_id of its
   SHA-256, so that texts are never compared in groups.
2. Documents are counted per part and mask: 32 cells. A coalition S of filters removes v(S), the cells whose mask meets S; the same sums of
   good and toxic documents give what each coalition loses.
3. The potential of the game v is P(empty) = 0 and P(S) = (v(S) + sum of P(S without i), i in S) / |S|, folded over the 32
   coalitions in ascending order. It is kept 120 times as large, which makes it a whole number at every step. A filter's
   Shapley count over the 120 orders is P(all) - P(all without it), the potential of the game from which it is removed.
4. A step of an order is a difference of two coalitions: what the filters before it remove, and what they remove with it.

Scale. Texts are read once and never shuffled. Shuffled are 32-byte hashes with the least doc_id, combined per task, so a text that a third of
all rows share is one row per task; rows of (doc_id, hash, mask) to meet their labels and first copies by doc_id; and
32 counts per part and task. The potential and the steps are column expressions over one row of 32 numbers per part.

Edge cases. Null text is empty; null source is the part "". A row with a null doc_id has no smaller one and fails E never; rows that repeat the
least doc_id do not fail E either. A document without label is neither good nor toxic; of several labels any 1 counts. An
empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import permutations

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from keelson.llm.common import read, ship, stored

FILTERS = "ABCDE"
LEAST_WORDS = 200
DISTINCT_PERCENT = 50
UPPER_PERCENT = 2
SYMBOLS = b"#$%&*|"
UPPER = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"
ALL = (1 << len(FILTERS)) - 1
SHARED = ALL ^ (1 << FILTERS.index("E"))  # the filters that see the text alone
ORDERS = 120


def own_failures(text: bytes, code_points: int) -> int:
    """The bits of A to D."""
    words = text.split()  # ASCII white space, the contract's
    upper = len(text) - len(text.translate(None, UPPER))
    failed = (
        len(words) < LEAST_WORDS,
        100 * len(set(words)) < DISTINCT_PERCENT * len(words),
        100 * upper > UPPER_PERCENT * code_points,
        len(text.translate(None, SYMBOLS)) < len(text),
    )
    return sum(bool(x) << i for i, x in enumerate(failed))


def masks(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, mask, good, toxic) for every row of docs (doc_id, text, source)."""
    ship(docs.sparkSession)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text = pc.fill_null(batch.column("text"), "")
            raw = text.cast(pa.binary()).to_pylist()
            own = [own_failures(t, n) for t, n in zip(raw, pc.utf8_length(text).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": batch.column("doc_id"),
                    "part": pc.fill_null(batch.column("part"), ""),
                    "own": pa.array(own, pa.int32()),
                    "hash": pa.array([hashlib.sha256(t).digest() for t in raw], pa.binary()),
                }
            )

    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.col("source").cast("string").alias("part"))
    rows = stored(own.mapInArrow(scan, "doc_id long, part string, own int, hash binary"), "audit-rows")
    first = rows.groupBy("hash").agg(F.min("doc_id").alias("doc_id")).withColumn("first", F.lit(True))
    one = lambda c: F.max(F.when(F.col(c) == 1, 1).otherwise(0)).alias(c)
    marked = labels.where("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(one("quality"), one("toxic"))
    late = F.col("doc_id").isNotNull() & F.col("first").isNull()
    joined = rows.join(first, ["doc_id", "hash"], "left").join(marked, "doc_id", "left")
    return joined.select(
        "part", (F.col("own") + F.when(late, ALL ^ SHARED).otherwise(0)).alias("mask"),
        F.coalesce("quality", F.lit(0)).alias("good"), F.coalesce("toxic", F.lit(0)).alias("toxic"),
    )


def coalitions(marked: DataFrame) -> DataFrame:
    """Per part: docs, and arrays v, good, toxic of what each of the 32 coalitions removes."""
    cells = marked.groupBy("part", "mask").agg(F.count(F.lit(1)).alias("n"), F.sum("good").alias("good"), F.sum("toxic").alias("toxic"))
    each = cells.withColumn("s", F.explode(F.sequence(F.lit(0), F.lit(ALL))))
    met = F.col("mask").bitwiseAND(F.col("s")) != 0
    sums = [F.sum(F.when(met, F.col(c)).otherwise(0)).alias(to) for c, to in (("n", "v"), ("good", "good"), ("toxic", "toxic"))]
    values = each.groupBy("part", "s").agg(*sums, F.sum("n").alias("docs"))
    # 32 rows per part, one for each coalition
    row = F.sort_array(F.collect_list(F.struct("s", "v", "good", "toxic")))
    return values.groupBy("part").agg(F.max("docs").alias("docs"), row.alias("x")).select("part", "docs", *[F.col(f"x.{c}").alias(c) for c in ("v", "good", "toxic")])


def potential(v: Column) -> Column:
    """The potentials of the 32 coalitions, times ORDERS."""

    def of(q: Column, s: Column) -> Column:
        total = ORDERS * F.element_at(v, s + 1)
        for i in range(len(FILTERS)):
            bit = F.lit(1 << i)
            total = total + F.when(s.bitwiseAND(bit) != 0, F.element_at(q, s.bitwiseXOR(bit) + 1)).otherwise(F.lit(0).cast("long"))
        return F.array_append(q, F.call_function("div", total, F.bit_count(s).cast("long")))

    return F.aggregate(F.sequence(F.lit(1), F.lit(ALL)), F.array(F.lit(0).cast("long")), of)


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per part, order of the filters and step."""
    games = coalitions(masks(docs, labels)).withColumn("q", potential(F.col("v")))
    orders = list(permutations(range(len(FILTERS))))
    names = F.array(*[F.lit("".join(FILTERS[i] for i in o)) for o in orders])
    before = F.array(*[F.lit(sum(1 << i for i in o[:step])) for o in orders for step in range(len(o))])
    bits = F.array(*[F.lit(1 << i) for o in orders for i in o])
    steps = games.withColumn("at", F.explode(F.sequence(F.lit(1), F.lit(len(orders) * len(FILTERS)))))
    steps = steps.withColumns({"before": F.element_at(before, F.col("at")), "bit": F.element_at(bits, F.col("at"))})
    of = lambda name, s: F.element_at(name, s + 1)
    after, without = F.col("before").bitwiseOR(F.col("bit")), F.lit(ALL).bitwiseXOR(F.col("bit"))
    more = lambda name: of(name, after) - of(name, F.col("before"))
    return steps.select(
        "part",
        F.element_at(names, F.floor((F.col("at") - 1) / len(FILTERS)).cast("int") + 1).alias("filter_order"),
        ((F.col("at") - 1) % len(FILTERS) + 1).cast("int").alias("step"),
        (F.col("docs") - of("v", after)).alias("kept"),
        more("v").alias("removed"),
        (of("v", F.col("bit")) - more("v")).alias("redundant"),
        (of("v", F.lit(ALL)) - of("v", without)).alias("unique_fails"),
        more("good").cast("long").alias("good_lost"),
        more("toxic").cast("long").alias("toxic_lost"),
        (of("q", F.lit(ALL)) - of("q", without)).alias("shapley"),
    )


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five filters over all documents, per source, order and step."""
    return audit(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


# Counts every order step by step, without coalitions or potentials.
ORACLE_SQL = r"""
WITH d AS (
    SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), l AS (
    SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic FROM labels GROUP BY doc_id
), f AS (
    SELECT part, concat(CASE WHEN len(w) < 200 THEN 'A' END, CASE WHEN 100 * len(list_distinct(w)) < 50 * len(w) THEN 'B' END,
                        CASE WHEN 100 * len(regexp_extract_all(t, '[A-Z]')) > 2 * length(t) THEN 'C' END,
                        CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' END, CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY t) THEN 'E' END) AS fails,
           coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic
    FROM d LEFT JOIN l USING (doc_id)
), h AS (
    SELECT part, fails, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM f GROUP BY ALL
), x AS (
    SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x
), o AS (
    SELECT a.x || b.x || c.x || d.x || e.x AS filter_order FROM x a, x b, x c, x d, x e
    WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5
), s AS (
    SELECT filter_order, step, substr(filter_order, step, 1) AS one, substr(filter_order, 1, step - 1) AS before FROM o, (SELECT unnest(range(1, 6)) AS step)
), r AS (
    SELECT part, filter_order, step, one,
           CAST(sum(n) FILTER (WHERE NOT regexp_matches(fails, '[' || before || one || ']')) AS BIGINT) AS kept,
           CAST(sum(n) FILTER (WHERE contains(fails, one) AND NOT gone) AS BIGINT) AS removed,
           CAST(sum(n) FILTER (WHERE contains(fails, one) AND gone) AS BIGINT) AS redundant,
           CAST(sum(n) FILTER (WHERE fails = one) AS BIGINT) AS unique_fails,
           CAST(sum(good) FILTER (WHERE contains(fails, one) AND NOT gone) AS BIGINT) AS good_lost,
           CAST(sum(toxic) FILTER (WHERE contains(fails, one) AND NOT gone) AS BIGINT) AS toxic_lost
    FROM (SELECT *, before <> '' AND regexp_matches(fails, '[' || before || '0]') AS gone FROM h, s) GROUP BY ALL
)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, coalesce(kept, 0) AS kept, coalesce(removed, 0) AS removed, coalesce(redundant, 0) AS redundant,
       coalesce(unique_fails, 0) AS unique_fails, coalesce(good_lost, 0) AS good_lost, coalesce(toxic_lost, 0) AS toxic_lost,
       CAST(sum(coalesce(removed, 0)) OVER (PARTITION BY part, one) AS BIGINT) AS shapley
FROM r
"""

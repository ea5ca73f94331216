"""Operator 5: mix sources to target weights by entropy balancing.

Every source ``s`` gets a token target ``T_s``; every document gets a rate,
the expected number of its copies. Among all rates in [0, cap] that meet
``sum(rate * size) = T_s`` the one nearest to 1 in relative entropy is an
exponential tilt cut off at the cap, ``rate = min(cap, exp(lambda_s * x))`` with
``x`` the size over the source's mean size. ``lambda_s`` solves the convex dual, one
dimension per source, by Newton steps kept inside a shrinking bracket.

Scale. The dual's sums depend on a document only through (source, size), so the
documents are counted once into that histogram (partial counts before the
shuffle; a hot source is spread over its sizes) and every Newton step is a small distributed
aggregation over it. Rounding needs no sort either: a document has one hash
number ``u``, gets ``floor(rate)`` copies, and one more where ``u - frac(rate)`` is
below the source's threshold; two histogram passes over all documents find the threshold
at which the taken words meet the target, and one document per source is turned to close the rest. No window or group ever holds a source's documents:
windows run over ranges of sources, and over at most 4,096 bins of a source. Ranks and fill-up levels of the sources are prefix sums over range
partitions. Sums of the dual are in fixed point, so a rerun gives the same rates whatever the order of its partitions; a dual
that Newton's steps do not solve is an error.

DataFrame functions only: no Python runs on executors.

Edge cases. Null text has size 0. Null sources form one source, ordered last.
Repeated rows are documents of their own. Documents of size 0 take 0 words. A
source of size 0 has target 0. An empty table gives an empty result. Other
columns of the input are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from keelson.llm.common import WORD, dropped, read, shuffle_partitions, stored

WEIGHTS = (5.0, 2.0, 1.0)
SHARE = 1.5  # words taken, over the words there are
CAP = 2.0  # copies of a document, and target over source size
BINS = 4096  # per rounding pass
MAX_STEPS = 80
TOLERANCE = 1e-9  # of the target


def sized_columns() -> list[Column]:
    words = F.regexp_count(F.col("text"), F.lit(WORD))
    return [F.col("doc_id"), F.col("source").cast("string").alias("source"), F.coalesce(words, F.lit(0)).cast("long").alias("size")]


def sized(docs: DataFrame) -> DataFrame:
    """doc_id, source and size in words."""
    return docs.select(*sized_columns())


def _exact(x: Column) -> Column:
    """Fixed-point, so that a sum does not depend on the order of its terms."""
    return x.cast("decimal(38,9)")


def sums_before(rows: DataFrame, order: list[Column], sums: dict[str, Column]) -> DataFrame:
    """Rows with, per name, the exact sum of a column over all rows that come earlier in the order.

    The rows are range-partitioned and summed inside each range; only one row per range passes through a single task.
    """
    ranges = stored(rows.repartitionByRange(shuffle_partitions(rows.sparkSession), *order).withColumn("range", F.spark_partition_id()), "mix-ranges")
    earlier = W.orderBy("range").rowsBetween(W.unboundedPreceding, -1)
    totals = ranges.groupBy("range").agg(*[F.sum(_exact(c)).alias(name) for name, c in sums.items()])
    bases = totals.select(F.col("range").alias("of"), *[F.coalesce(F.sum(name).over(earlier), F.lit(0)).alias(f"{name}_base") for name in sums])
    inside = W.partitionBy("range").orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    own = ranges.select("*", *[F.coalesce(F.sum(_exact(c)).over(inside), F.lit(0)).alias(f"{name}_own") for name, c in sums.items()])
    found = own.join(F.broadcast(bases), F.col("range") == F.col("of"))  # a row for each range
    out = stored(found.select(*rows.columns, *[(F.col(f"{name}_own") + F.col(f"{name}_base")).cast("double").alias(name) for name in sums]), "mix-sums")
    dropped(ranges)
    return out


def targets(per_source: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, cap: float = CAP) -> DataFrame:
    """Add k (rank of the source) and target to (source, source_size).

    Filling up: with sources by limit over weight, those before the first
    source whose share of the rest fits its limit get their limit, the others
    the rest by weight. Two numbers come to the driver.
    """
    ranked = sums_before(per_source, [F.col("source").asc_nulls_last()], {"rank": F.lit(1)})
    ranked = ranked.select("source", "source_size", (F.col("rank") + 1).cast("int").alias("k"))
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.pmod(F.col("k") - 1, F.lit(len(weights))) + 1).cast("int"))
    ranked = ranked.withColumn("weight", weight).withColumn("limit", F.col("source_size") * F.lit(cap)).withColumn("ratio", F.col("limit") / F.col("weight"))
    whole = ranked.agg(F.sum("source_size").alias("words"), F.sum(_exact(F.col("weight"))).cast("double").alias("weight")).first()
    filled = sums_before(ranked, [F.col("ratio"), F.col("k")], {"limits": F.col("limit"), "weights": F.col("weight")})
    level = (F.lit(float(whole.words or 0) * share) - F.col("limits")) / (F.lit(float(whole.weight or 1)) - F.col("weights"))
    fits = filled.withColumn("level", level).where(F.col("level") <= F.col("ratio")).agg(F.min(F.struct("ratio", "k", "level")).alias("m")).first()
    target = F.col("limit") if fits.m is None else F.least("limit", F.lit(fits.m.level) * F.col("weight"))
    return filled.select("source", "k", "source_size", target.alias("target"))


def _rate(lam: Column, x: Column, cap: float) -> Column:
    """min(cap, exp(lam * x)) without overflow; a null lam means the cap."""
    return F.when(lam.isNull(), F.lit(cap)).otherwise(F.least(F.lit(cap), F.exp(F.least(lam * x, F.lit(50.0)))))


def solve(hist: DataFrame, goals: DataFrame, cap: float = CAP) -> DataFrame:
    """lambda per source: hist is (k, size, n), goals (k, source_size, target).

    lam is null where every document is at the cap.
    """
    spark = hist.sparkSession
    shape = hist.where("size > 0").groupBy("k").agg(F.min("size").alias("least"), F.sum("n").alias("docs"))
    state = (
        goals.join(shape, "k")
        .withColumn("mean", F.col("source_size") / F.col("docs"))
        .withColumn("x0", F.col("least") / F.col("mean"))
        .withColumn("full", F.col("target") >= F.col("source_size") * F.lit(cap) * (1 - 1e-12))
        .withColumn("hi", F.log(F.lit(cap)) / F.col("x0"))
        .withColumn("lo", F.least(F.lit(0.0), F.log(F.col("target") / F.col("source_size")) / F.col("x0")))
        .select("k", "target", "mean", "full", "lo", "hi", F.lit(0.0).alias("lam"), F.col("full").alias("done"))
    )
    state = stored(state, "mix-state")
    for _ in range(MAX_STEPS):
        if state.where("not done").isEmpty():
            break
        x = F.col("size") / F.col("mean")
        tilt = _rate(F.col("lam"), x, cap)
        mass = F.col("n") * F.col("size")
        sums = (
            hist.where("size > 0")
            .join(state.where("not done"), "k")
            .groupBy("k")
            .agg(
                F.sum(_exact(mass * tilt)).cast("double").alias("got"),
                F.sum(_exact(F.when(tilt < cap, mass * x * tilt).otherwise(0.0))).cast("double").alias("slope"),
            )
        )
        gap = F.col("got") - F.col("target")
        lo = F.when(gap < 0, F.col("lam")).otherwise(F.col("lo"))
        hi = F.when(gap >= 0, F.col("lam")).otherwise(F.col("hi"))
        newton = F.col("lam") - gap / F.nullif(F.col("slope"), F.lit(0.0))
        inside = newton.isNotNull() & (newton > lo) & (newton < hi)
        near = (F.abs(gap) <= F.col("target") * TOLERANCE) | ((hi - lo) <= F.lit(1e-13) * (F.abs(hi) + F.abs(lo)))
        stepped = (
            state.join(sums, "k", "left")
            .select(
                "k", "target", "mean", "full",
                F.when(F.col("done"), F.col("lo")).otherwise(lo).alias("lo"),
                F.when(F.col("done"), F.col("hi")).otherwise(hi).alias("hi"),
                F.when(F.col("done") | near, F.col("lam")).when(inside, newton).otherwise((lo + hi) / 2).alias("lam"),
                (F.col("done") | near).alias("done"),
            )
        )
        before, state = state, stored(stepped, "mix-state")
        dropped(before)
    else:
        if not state.where("not done").isEmpty():
            raise RuntimeError(f"the dual of some source is not solved after {MAX_STEPS} Newton steps")
    return state.select("k", "mean", "target", F.when(~F.col("full"), F.col("lam")).alias("lam"))


def _threshold(bins: DataFrame, before: str, goal: str) -> DataFrame:
    """Per source the bin in which the running sum reaches the goal.

    bins: k, bin, words, the sum ``before`` the first bin, and ``goal``. Adds ``below``,
    the sum before the chosen bin. Sources that never reach it get the last bin.
    """
    order = W.partitionBy("k").orderBy("bin")
    run = F.sum("words").over(order) + F.col(before)
    last = F.col("bin") == F.max("bin").over(W.partitionBy("k"))
    return (
        bins.withColumn("run", run)
        .withColumn("last", last)
        .where((F.col("run") >= F.col(goal)) | F.col("last"))
        .groupBy("k")
        .agg(F.min_by(F.struct("bin", (F.col("run") - F.col("words")).alias("below"), "words"), "bin").alias("at"))
        .select("k", "at.bin", "at.below", "at.words")
    )


def _rated(sized_docs: DataFrame, of_source: DataFrame, cap: float) -> DataFrame:
    """Documents (doc_id, source, size, ...) with their rate and place in the rounding order.

    of_source: source, k, source_size, target, mean, lam. A document at the cap, or without
    words, takes no extra copy: ``open`` is false.
    """
    same = F.col("d.source").eqNullSafe(F.col("s.source"))
    rate = F.when(F.col("size") > 0, _rate(F.col("lam"), F.col("size") / F.col("mean"), cap)).otherwise(F.lit(1.0))
    u = F.pmod(F.xxhash64(F.col("doc_id"), F.col("size"), F.lit(5)), F.lit(1 << 40)) / F.lit(float(1 << 40))
    place = (F.col("u") - F.col("rate") + F.floor("rate") + 1) / 2 * BINS
    return (
        sized_docs.alias("d")
        .join(of_source.alias("s"), same, "left")
        .drop(F.col("s.source"))
        .withColumn("rate", rate)
        .withColumn("u", u)
        .withColumn("place", F.least(place, F.lit(BINS - 1e-6)))
        .withColumn("bin", F.floor("place"))
        .withColumn("fine", F.floor((F.col("place") - F.col("bin")) * BINS))
        .withColumn("open", (F.floor("rate") + 1 <= F.lit(cap)) & (F.col("size") > 0))
        .withColumn("base", F.floor("rate"))
    )


def solve_mix(sized_docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, cap: float = CAP) -> DataFrame:
    """One stored row per source: target, tilt and rounding threshold, for documents (doc_id, source, size)."""
    per_source = sized_docs.groupBy("source").agg(F.sum("size").alias("source_size"))
    goals = stored(targets(per_source, weights, share, cap), "mix-targets")
    same = F.col("d.source").eqNullSafe(F.col("g.source"))
    by_size = sized_docs.groupBy("source", "size").agg(F.count(F.lit(1)).alias("n"))
    hist = stored(by_size.alias("d").join(goals.select("source", "k").alias("g"), same).select("k", "size", "n"), "mix-hist")
    lam = solve(hist, goals.select("k", "source_size", "target"), cap)
    of_source = stored(goals.join(lam.select("k", "mean", "lam"), "k", "left"), "mix-lambda")

    rated = _rated(sized_docs, of_source, cap)
    fixed = rated.groupBy("k", "target").agg(F.sum(F.col("base") * F.col("size")).alias("base_words"))
    coarse = rated.where("open").groupBy("k", "bin").agg(F.sum("size").alias("words")).join(fixed, "k")
    first = _threshold(coarse, "base_words", "target").select("k", F.col("bin").alias("bin1"), F.col("below").alias("below1"))
    first = stored(first.join(goals.select("k", "target"), "k"), "mix-coarse")
    fine = rated.where("open").drop("target").join(first, "k").where("bin = bin1")
    fine = fine.groupBy("k", "fine", "below1", "target").agg(F.sum("size").alias("words")).withColumnRenamed("fine", "bin")
    second = _threshold(fine, "below1", "target").join(first, "k")
    # the bin in which the goal falls goes in whole if that ends nearer to it
    keep = (F.col("target") - F.col("below")) >= F.col("words") / 2
    cut = second.select("k", "bin1", (F.col("bin") + keep.cast("int")).alias("bin2"))
    cut = stored(of_source.join(cut, "k", "left"), "mix-cut")

    # what is left of the gap goes to one document per source, rounded the other way, whose size fits it best
    rounded = _rounded(sized_docs, cut, cap)
    got = rounded.groupBy("k", "target").agg(F.sum(F.col("copies") * F.col("size")).alias("got"))
    gap = stored(got.select("k", (F.col("target") - F.col("got")).alias("gap")), "mix-gap")
    off = F.abs(F.col("size") - F.abs("gap"))
    turns = ((F.col("gap") > 0) & (F.col("copies") < F.col("rate"))) | ((F.col("gap") < 0) & (F.col("copies") > F.col("rate")))
    fits = rounded.join(gap, "k").where(turns & (off < F.abs("gap"))).groupBy("k", "gap")
    fits = fits.agg(F.min(F.struct(off.alias("off"), "doc_id", "size")).alias("m"))
    fits = fits.select("k", F.col("m.doc_id").alias("turn_id"), F.col("m.size").alias("turn_size"), F.signum("gap").cast("long").alias("turn"))
    out = stored(cut.join(fits, "k", "left"), "mix-turn")
    dropped(goals, hist, of_source, first, cut, gap)
    return out


def _rounded(sized_docs: DataFrame, of_source: DataFrame, cap: float) -> DataFrame:
    """Rated documents with the copies that the thresholds of their source give."""
    extra = F.col("open") & ((F.col("bin") < F.col("bin1")) | ((F.col("bin") == F.col("bin1")) & (F.col("fine") < F.col("bin2"))))
    return _rated(sized_docs, of_source, cap).withColumn("copies", F.col("base") + F.coalesce(extra, F.lit(False)).cast("long"))


def with_copies(sized_docs: DataFrame, of_source: DataFrame, cap: float = CAP) -> DataFrame:
    """Documents with the columns of their source, rate and copies."""
    turned = F.col("doc_id").eqNullSafe(F.col("turn_id")) & (F.col("size") == F.col("turn_size"))
    return _rounded(sized_docs, of_source, cap).withColumn("copies", F.col("copies") + F.when(turned, F.col("turn")).otherwise(F.lit(0)))


def mix(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, cap: float = CAP) -> DataFrame:
    """doc_id, source, size, source_size, target, rate, copies, taken for every row of docs."""
    named = stored(sized(docs), "mix-sizes")
    rated = with_copies(named, solve_mix(named, weights, share, cap), cap)
    return rated.select("doc_id", "source", "size", "source_size", "target", "rate", "copies", (F.col("copies") * F.col("size")).alias("taken"))


def mixed_documents(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, cap: float = CAP) -> DataFrame:
    """The rows of docs, each as many times as the mix has copies of it."""
    named = stored(sized(docs), "mix-sizes")
    of_source = solve_mix(named, weights, share, cap)
    whole = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("whole"), *sized_columns())
    rated = with_copies(whole, of_source, cap).where("copies > 0")
    return rated.select("whole", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy")).select("whole.*")


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mix of all documents, with the production weights."""
    return mix(read(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken", "source", "copies")

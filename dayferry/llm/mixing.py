"""Mixing sources to target weights by entropy balancing.

Every document gets a rate, near 1 in the sense of relative entropy, such that the rates times the
sizes of a source add up to the source's target. The dual of that problem is convex with one
variable for each source; its solution tilts rates exponentially by the size of the document:
``rate = min(cap, exp(lambda * size / mean size))``. Newton steps, each one aggregate over the
sizes of all documents, find lambda; a bracket keeps them safe. Rates are then rounded to copies.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dayferry.frames import written
from dayferry.llm.text import packed, unpacked, word_count

WEIGHTS = (5, 2, 1)
SHARE = 1.5
CAP = 2
BUCKET_ROWS = 20_000  # rows of one source and size that one sort may hold
MAX_STEPS = 60
TOLERANCE = 1e-7


def _join(left: DataFrame, right: DataFrame, names: Sequence[str], how: str = "inner") -> DataFrame:
    """A join on names that may be null on both sides; the names of the left side stay."""
    right = right.withColumnsRenamed({n: f"__right_{n}" for n in names})
    cond = F.lit(True)
    for n in names:
        cond &= F.col(n).eqNullSafe(F.col(f"__right_{n}"))
    return left.join(right, cond, how).drop(*[f"__right_{n}" for n in names])


def source_targets(sizes: DataFrame, weights: Sequence[float], share: float, cap: float) -> DataFrame:
    """One row per source: its size and its target.

    ``sizes`` has source, size and n (documents of that size). Sources take the weights in turn, by
    code point, null last. Targets share ``share`` of the total by weight and stop at ``cap`` times
    the source's size; the excess goes to the others by weight. With sources in order of size over
    weight, those that stop are a prefix, so prefix sums give the level at which the rest share.
    The windows see one row per source.
    """
    sources = sizes.groupBy("source").agg(
        F.sum(F.col("size") * F.col("n")).alias("source_size"),
        F.sum(F.when(F.col("size") > 0, F.col("n")).otherwise(0)).alias("sized"),
        F.min(F.when(F.col("size") > 0, F.col("size"))).alias("least"),
    )
    by_name = Window.orderBy(F.asc_nulls_last("source"))
    by_ratio = Window.orderBy("ratio", "position")
    everything = Window.partitionBy()
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    turn = F.pmod(F.col("position"), F.lit(len(weights)))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (turn + 1).cast("int"))
    level = (F.col("pool") - F.col("stopped")) / (F.col("all_weights") - F.col("stopped_weights"))
    return (
        sources.withColumn("position", F.row_number().over(by_name) - 1)
        .withColumn("weight", weight)
        .withColumn("most", F.col("source_size") * F.lit(float(cap)))
        .withColumn("ratio", F.col("most") / F.col("weight"))
        .withColumn("pool", F.sum("source_size").over(everything) * F.lit(float(share)))
        .withColumn("all_weights", F.sum("weight").over(everything))
        .withColumn("stopped", F.coalesce(F.sum("most").over(before), F.lit(0.0)))
        .withColumn("stopped_weights", F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
        # The first source that does not stop sets the level of all that follow.
        .withColumn("own", level)
        .withColumn("level", F.min_by("own", F.when(F.col("ratio") > F.col("own"), F.struct("ratio", "position"))).over(everything))
        .withColumn(
            "target",
            F.when(F.col("level").isNull(), F.col("most")).otherwise(
                F.least(F.col("most"), F.col("weight") * F.col("level"))
            ),
        )
        .select("source", "source_size", "sized", "least", "target")
    )


def _rate(lam: Column, size: Column, mean: Column, cap: float) -> Column:
    return F.least(F.lit(float(cap)), F.exp(F.least(lam * size / mean, F.lit(50.0))))


def solve_dual(sizes: DataFrame, targets: DataFrame, cap: float) -> DataFrame:
    """The targets with ``lam`` and ``mean``; one aggregate over the sizes for each Newton step.

    A source without words, or with no target, keeps lambda 0; one whose target is ``cap`` times its
    size gets the end of its bracket, where every rate is the cap.
    """
    mean = F.col("source_size") / F.col("sized")
    least = F.col("least") / mean
    wanted = F.log(F.col("target") / F.col("source_size"))
    full = F.col("target") >= F.col("source_size") * float(cap) * (1 - 1e-12)
    state = targets.where(F.col("sized") > 0).select(
        "source", "source_size", "target", mean.alias("mean"),
        F.least(wanted / least, F.lit(0.0)).alias("lo"),
        (F.lit(math.log(cap)) / least).alias("hi"),
        F.when(full, F.lit(math.log(cap)) / least)
        .otherwise(F.greatest(wanted, F.lit(-4.0))).alias("lam"),
        full.alias("done"),
    )
    state = written(state, "mixing-dual")
    for steps in range(MAX_STEPS + 1):
        if state.where(~F.col("done")).isEmpty():
            break
        if steps == MAX_STEPS:
            raise RuntimeError(f"targets are not met after {MAX_STEPS} Newton steps")
        # The sources are far fewer than the rows of ``sizes``; the planner broadcasts them if small.
        at = _join(sizes, state, ["source"]).where(~F.col("done"))
        rate = _rate(F.col("lam"), F.col("size"), F.col("mean"), cap)
        words = F.col("n") * F.col("size")
        slope = F.when(rate < float(cap), words * rate * F.col("size") / F.col("mean")).otherwise(0.0)
        sums = at.select("source", (words * rate).alias("words"), slope.alias("slope")).groupBy("source").agg(
            F.sum("words").alias("words"), F.sum("slope").alias("slope")
        )
        gap = F.col("words") - F.col("target")
        lo = F.when(gap < 0, F.col("lam")).otherwise(F.col("lo"))
        hi = F.when(gap > 0, F.col("lam")).otherwise(F.col("hi"))
        newton = F.col("lam") - F.try_divide(gap, F.col("slope"))
        inside = newton.isNotNull() & (newton > lo) & (newton < hi)
        near = F.abs(gap) <= F.col("target") * TOLERANCE
        step = F.when(near, F.col("lam")).when(inside, newton).otherwise((lo + hi) / 2)
        moved = _join(state, sums, ["source"], "left")
        stay = F.col("words").isNull()
        state = written(
            moved.select(
                "source", "source_size", "target", "mean",
                F.when(stay, F.col("lo")).otherwise(lo).alias("lo"),
                F.when(stay, F.col("hi")).otherwise(hi).alias("hi"),
                F.when(stay, F.col("lam")).otherwise(step).alias("lam"),
                (stay | near).alias("done"),
            ),
            "mixing-dual",
        )
    return state.select("source", "mean", F.round("lam", 9).alias("lam"), "target", "source_size")


def copy_rules(sizes: DataFrame, dual: DataFrame, hashes: DataFrame, cap: float) -> DataFrame:
    """For each source, size and bucket of ids: the copies all get, and up to which hash one more.

    The fractions of the rates are summed along the sizes of a source; whenever the sum passes the
    next half, one more document of that size gets a copy. So the words taken differ from the
    target by about the largest document at most. Which documents it is follows from the hash of
    their ids: documents of one source and size are split into buckets of bounded rows, each
    bucket gives its part, and the part's largest hash is the rule.
    """
    known = _join(sizes, dual, ["source"], "left")
    full = F.col("target") >= F.col("source_size") * float(cap) * (1 - 1e-12)
    rate = F.when(full, F.lit(float(cap))).otherwise(_rate(F.col("lam"), F.col("size"), F.col("mean"), cap))
    exact = F.when(F.col("size") > 0, F.round(rate, 6)).otherwise(1.0).cast("decimal(12,6)")
    along = Window.partitionBy("source").orderBy("size")
    rated = (
        known.select("source", "size", "n", "buckets", exact.alias("rate"))
        .withColumn("base", F.floor("rate").cast("bigint"))
        .withColumn("due", F.floor(F.sum(F.col("n") * (F.col("rate") - F.col("base"))).over(along) + F.lit(0.5)))
        .withColumn("more", F.col("due") - F.coalesce(F.lag("due").over(along), F.lit(0)))
        .select("source", "size", "n", "base", "more")
    )
    ranked = Window.partitionBy("source", "size", "bucket").orderBy("hash")
    parts = hashes.groupBy("source", "size", "bucket").agg(F.count(F.lit(1)).alias("part"))
    over_parts = Window.partitionBy("source", "size").orderBy("bucket")
    shared = (
        _join(parts, rated, ["source", "size"])
        .select("source", "size", "bucket", "part", "n", "base", "more")
        .withColumn("so_far", F.floor(F.col("more") * F.sum("part").over(over_parts) / F.col("n")))
        .withColumn("gets", F.col("so_far") - F.coalesce(F.lag("so_far").over(over_parts), F.lit(0)))
    )
    order = hashes.withColumn("rank", F.row_number().over(ranked))
    last = (
        _join(order, shared, ["source", "size", "bucket"])
        .where(F.col("rank") == F.col("gets"))
        .select("source", "size", "bucket", F.col("hash").alias("upto"))
    )
    return _join(shared, last, ["source", "size", "bucket"], "left").select(
        "source", "size", "bucket", "base", "upto"
    )


def mix(
    docs: DataFrame,
    id_column: str = "doc_id",
    source_column: str = "source",
    size: Column | None = None,
    weights: Sequence[float] = WEIGHTS,
    share: float = SHARE,
    cap: float = CAP,
) -> DataFrame:
    """All columns of ``docs`` with ``size``, ``source_size``, ``target`` and ``copies``.

    ``size`` is a column of ``docs`` or an expression over them; by default the words of ``text``.
    A null text has size 0; a null source is a source of its own, the last one; null ids are mixed
    like other ids, and rows that repeat an id in one source and size get the same number of
    copies. A document of size 0 keeps one copy. An empty table stays empty. Other columns pass
    through, but for those that have the name of an added one.
    """
    size = word_count(F.col("text")) if size is None else size
    rows = docs.select(
        packed(docs),
        F.col(source_column).alias("__source"),
        size.cast("bigint").alias("__size"),
        F.xxhash64(F.col(id_column)).alias("__hash"),
    )
    narrow = written(
        rows.select(F.col("__source").alias("source"), F.col("__size").alias("size"), F.col("__hash").alias("hash")),
        "mixing-sizes",
    )
    sizes = narrow.groupBy("source", "size").agg(F.count(F.lit(1)).alias("n"))
    sizes = written(sizes.withColumn("buckets", F.ceil(F.col("n") / BUCKET_ROWS).cast("bigint")), "mixing-histogram")
    targets = written(source_targets(sizes, weights, share, cap), "mixing-targets")
    dual = solve_dual(sizes, targets, cap)
    crowded = sizes.where(F.col("buckets") > 1)
    split = _join(narrow, crowded, ["source", "size"], "left").select(
        "source", "size", "hash", _bucket(F.col("hash"), F.col("buckets")).alias("bucket")
    )
    rules = copy_rules(sizes, dual, split, cap)
    rules = rules.groupBy("source", "size").agg(F.collect_list(F.struct("bucket", "base", "upto")).alias("rules"))
    found = _join(sizes, rules, ["source", "size"])
    found = _join(found, targets, ["source"]).select(
        "source", "size", "buckets", "rules", "source_size", "target"
    )
    joined = rows.join(
        written(found, "mixing-rules"), F.col("__source").eqNullSafe(F.col("source")) & (F.col("__size") == F.col("size"))
    )
    bucket = _bucket(F.col("__hash"), F.col("buckets"))
    rule = F.filter("rules", lambda r: r["bucket"] == bucket)[0]
    more = F.coalesce(F.col("__hash") <= rule["upto"], F.lit(False)).cast("bigint")
    return unpacked(
        joined,
        docs,
        size=F.col("__size"),
        source_size=F.col("source_size"),
        target=F.col("target"),
        copies=rule["base"] + more,
    )


def _bucket(hashed: Column, buckets: Column) -> Column:
    return F.coalesce(F.pmod(F.xxhash64(F.lit(1), hashed), buckets), F.lit(0).cast("bigint"))


def op4_entropy_mixing(spark, sf_dir):
    """What the mix takes of every document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    sized = docs.select("doc_id", "source", word_count(F.col("text")).alias("size"))
    return mix(written(sized, "mixing-input"), size=F.col("size")).select(
        "doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "copies"
    )

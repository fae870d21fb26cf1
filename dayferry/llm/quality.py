"""Quality rules: a hashed n-gram log-likelihood ratio between trusted texts and the raw corpus.

Words and pairs of neighbouring words are hashed into a fixed number of buckets. Two multinomials
over the buckets, one of the trusted documents and one of all documents, give every document a
log-likelihood ratio per n-gram. A document stays if it passes the base rules and its ratio
reaches a fixed threshold; nothing is drawn at random.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dayferry.frames import written
from dayferry.llm.text import WORD, let, packed, unpacked, word_array

BUCKETS = 32_768
BROADCAST_IDS = 500_000  # trusted ids that are broadcast at most, about 32 bytes each; more are joined by a shuffle
PRIOR = 65_536.0  # n-grams of the raw corpus that smooth the trusted counts
THRESHOLD = -0.05  # nats per n-gram
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
SYMBOLS = r"[#*$%&|<>]"


def _word_hashes(words: Column) -> Column:
    return F.transform(words, lambda w: F.xxhash64(w))


def _buckets(hashes: Column, buckets: int) -> Column:
    """Buckets of all words and of all neighbours; the last word's neighbour is the end of the text."""
    after = F.slice(hashes, F.lit(2), F.greatest(F.size(hashes) - 1, F.lit(0)))
    pairs = F.zip_with(hashes, after, lambda a, b: F.pmod(F.xxhash64(a, F.lit(2), b), F.lit(buckets)).cast("int"))
    return F.concat(F.transform(hashes, lambda h: F.pmod(h, F.lit(buckets)).cast("int")), pairs)


def bucket_weights(
    docs: DataFrame, trusted: DataFrame, id_column: str, text_column: str, buckets: int, broadcast_ids: int
) -> list[float]:
    """The log ratio of each bucket, rounded: as many numbers as buckets, whatever the size of the corpus.

    The raw counts cover all documents, the trusted ones all trusted documents. Up to ``broadcast_ids`` ids
    are broadcast, and no text is shuffled; with more the texts are dealt by id once, without a sort, and
    the adaptive planner splits an id of many rows. Each task sums its own buckets before the shuffle.
    """
    ids = trusted.select(F.col(id_column).alias("__id")).where(F.col("__id").isNotNull()).distinct()
    marks = written(ids, "quality-trusted").withColumn("__trusted", F.lit(1))
    marks = F.broadcast(marks) if marks.count() <= broadcast_ids else marks.hint("shuffle_hash")
    texts = docs.select(F.col(id_column).alias("__id"), F.col(text_column).alias("__text"))
    known = texts.join(marks, "__id", "left")
    grams = known.select(
        "__trusted", F.explode(_buckets(_word_hashes(word_array(F.col("__text"))), buckets)).alias("bucket")
    )
    counts = grams.groupBy("bucket").agg(F.count(F.lit(1)).alias("raw"), F.count("__trusted").alias("good"))
    found = {r["bucket"]: (r["raw"], r["good"]) for r in counts.collect()}  # at most one row per bucket
    all_raw = sum(raw for raw, _ in found.values())
    all_good = sum(good for _, good in found.values())
    if not all_good:
        return [0.0] * buckets
    weights = []
    for b in range(buckets):
        raw, good = found.get(b, (0, 0))
        p = (raw + 0.5) / (all_raw + 0.5 * buckets)
        weights.append(round(math.log((good + PRIOR * p) / (all_good + PRIOR) / p), 4))
    return weights


FEW = 16  # repeated windows that are looked up one by one


def _repeated_words(hashes: Column) -> Column:
    """Words in three-word windows that occur twice or more, all occurrences counted.

    Windows are compared by hash. Equal hashes are neighbours once sorted. If only a few windows
    repeat, their places are found by looking each window up among them; else the windows are
    sorted with their places, so that a text of nothing but repeats takes no quadratic time.
    """

    def covered(starts: Column) -> Column:
        # Of one parameter each: a second one of a lambda is the place in the array.
        second, third = F.transform(starts, lambda p: p + 1), F.transform(starts, lambda p: p + 2)
        return F.size(F.array_distinct(F.concat(starts, second, third)))

    def by_lookup(windows: Column, again: Column) -> Column:
        places = F.transform(windows, lambda h, i: F.when(F.array_contains(again, h), i))
        return let(F.filter(places, lambda p: p.isNotNull()), covered)

    def by_sort(windows: Column) -> Column:
        def starts(s: Column) -> Column:
            twice = F.transform(
                s, lambda x, k: F.when((x["h"] == F.get(s, k - 1)["h"]) | (x["h"] == F.get(s, k + 1)["h"]), x["i"])
            )
            return F.filter(twice, lambda p: p.isNotNull())

        placed = F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i")))
        return let(let(F.sort_array(placed), starts), covered)

    def count(windows: Column) -> Column:
        def again(s: Column) -> Column:
            return F.array_distinct(F.filter(s, lambda h, k: h == F.get(s, k + 1)))

        return let(
            let(F.sort_array(windows), again),
            lambda d: F.when(F.size(d) == 0, F.lit(0))
            .when(F.size(d) <= FEW, by_lookup(windows, d))
            .otherwise(by_sort(windows)),
        )

    windows = F.transform(
        F.sequence(F.lit(0), F.size(hashes) - 3),
        lambda i: F.xxhash64(F.get(hashes, i), F.get(hashes, i + 1), F.get(hashes, i + 2)),
    )
    return F.when(F.size(hashes) < 3, F.lit(0)).otherwise(let(windows, count))


def judge(
    docs: DataFrame,
    trusted: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    buckets: int = BUCKETS,
    threshold: float = THRESHOLD,
    broadcast_ids: int = BROADCAST_IDS,
) -> DataFrame:
    """All columns of ``docs`` with the counts of the base rules, ``quality_score`` and ``kept``.

    ``trusted`` has the ids of trusted documents; repeated ids count once, null ids match nothing.
    Without trusted documents every ratio is 0 and only the base rules decide. A null text counts
    as an empty one, and a text without words scores 0 and fails the base rules. Rows that repeat are
    judged alike, an empty table stays empty. Whole texts are read, of any length; each row is
    judged where it lies. Other columns pass through, but for those that have an added name.
    """
    weights = bucket_weights(docs, trusted, id_column, text_column, buckets, broadcast_ids)
    table = F.split(F.lit(",".join(map(str, weights))), ",").cast("array<double>")  # folded to a literal
    text = F.coalesce(F.col(text_column), F.lit(""))
    rows = docs.select(packed(docs), text.alias("__text"), word_array(text).alias("__words"))
    rows = rows.select("__row", "__text", "__words", _word_hashes(F.col("__words")).alias("__hashes"))
    lines = F.filter(F.split("__text", "\n"), lambda line: line.rlike(WORD))
    total = F.aggregate(
        _buckets(F.col("__hashes"), buckets), F.lit(0.0), lambda acc, b: acc + F.coalesce(F.get(table, b), F.lit(0.0))
    )
    n = F.size("__words")
    counted = rows.select(
        "__row",
        n.cast("bigint").alias("n_words"),
        F.length(F.array_join("__words", "")).cast("bigint").alias("word_chars"),
        F.regexp_count("__text", F.lit(SYMBOLS)).cast("bigint").alias("n_symbols"),
        let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("bigint").alias("n_dup_lines"),
        _repeated_words(F.col("__hashes")).cast("bigint").alias("n_repeat_words"),
        F.round(F.when(n > 0, total / (2 * n)).otherwise(0.0), 6).alias("score"),
    )
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    # The row's number, always 0 or more, keeps a caller's filter on the verdict above the counts: pushed
    # below, it would repeat them inside each other.
    here = F.monotonically_increasing_id() >= 0
    return unpacked(
        counted,
        docs,
        n_words=F.col("n_words"),
        word_chars=F.col("word_chars"),
        n_symbols=F.col("n_symbols"),
        n_dup_lines=F.col("n_dup_lines"),
        n_repeat_words=F.col("n_repeat_words"),
        base_failed=failed,
        kept=~failed & (F.col("score") >= threshold) & here,
        quality_score=F.col("score"),
    )


def trusted_ids(labels: DataFrame) -> DataFrame:
    return labels.where(F.col("quality") == 1).select("doc_id")


def op2_llr_quality(spark, sf_dir):
    """Base counts and the verdict on every document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return judge(docs, trusted_ids(labels)).drop("text")

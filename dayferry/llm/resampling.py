"""Resampling documents towards a target distribution, by hashed n-grams of deduplicated lines.

A feature is a run of 1 to n words, hashed to a bucket. Buckets are counted over all documents and over all
target texts, and a document's weight is the mean gain of its features. Line feeds separate words, so texts
are cut into lines there, and equal lines become one: Spark groups the lines of a corpus, the features of each
different line are worked out once and count as often as the line occurs. Runs that cross lines lie in no
line; they are counted per document and added.

A document is scored where it lies, with the bucket gains at hand, and the lines that a slice of
documents repeats are worked out once too. A join of documents with their lines would gather all documents
with a common line. Scores are whole numbers, so the places of the best ones follow from a histogram of
scores, and only documents of equal score are put in order together.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dayferry.frames import small_frame, written
from dayferry.llm.text import ROW, packed, unpacked
from dayferry.llm.tokens import in_slices

BUCKETS = 10_000
LONGEST_RUN = 1
SEED = 2024
LEAST_WORDS = 20
PERCENT = 10

#: Capitals A to Z become small; bytes that are no part of a word become line feeds or spaces.
_PLAIN = bytes(
    c + 32 if 0x41 <= c <= 0x5A else c if c >= 0x80 or 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A else 10 if c == 10 else 32
    for c in range(256)
)


def _joined(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The plain bytes of binary values, each with a line feed after it, and where each starts and the last ends."""
    data = b"".join([x.translate(_PLAIN) + b"\n" for x in pc.fill_null(column, b"").to_pylist()])
    sizes = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64) + 1
    return np.frombuffer(data, np.uint8), np.concatenate([[0], np.cumsum(sizes)])


def _spans(data: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the runs of marked bytes start and end."""
    edges = np.flatnonzero(np.diff(np.concatenate([[False], inside, [False]]).view(np.int8)))
    return edges[::2], edges[1::2]


def _values(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.DictionaryArray:
    """The bytes of spans in order, each different value once with the places it is found at."""
    offsets = np.empty(2 * len(starts) + 1, np.int32)
    offsets[0:-1:2], offsets[1::2], offsets[-1] = starts, ends, ends[-1] if len(ends) else 0
    both = pa.Array.from_buffers(pa.binary(), 2 * len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(data)])
    return both.take(pa.array(np.arange(0, 2 * len(starts), 2))).dictionary_encode()


class Words:
    """The words of a slice of texts, in order: which they are, and the text and line of each."""

    def __init__(self, texts: pa.Array):
        data, bounds = _joined(texts)
        starts, ends = _spans(data, data > 32)
        self.coded = _values(data, starts, ends)
        self.codes = self.coded.indices.to_numpy().astype(np.int64)
        self.text = np.searchsorted(bounds, starts, "right") - 1
        feeds = np.flatnonzero(data == 10)
        self.line = np.searchsorted(feeds, starts)  # of all lines of the slice
        self.texts = len(texts)

    def runs(self, longest: int, buckets: int, crossing: bool | None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """The text and the bucket of every run of words: inside lines, crossing them, or of both kinds (None)."""
        whole = self.coded.dictionary
        for size in range(1, longest + 1):
            first = np.arange(len(self.codes) - size + 1)
            if not len(first):
                return
            last = first + size - 1
            chosen = self.text[first] == self.text[last]
            if crossing is not None:
                chosen &= (self.line[first] != self.line[last]) == crossing
            first = first[chosen]
            if size == 1:
                codes, values = self.codes[first], whole
            else:
                parts = [whole.take(pa.array(self.codes[first + k])) for k in range(size)]
                coded = pc.binary_join_element_wise(*parts, b" ").dictionary_encode()
                codes, values = coded.indices.to_numpy(), coded.dictionary
            hashed = np.array([zlib.crc32(v) % buckets for v in values.to_pylist()], np.int64)
            yield self.text[first], hashed[codes] if len(hashed) else np.zeros(0, np.int64)


def _bucket_counts(rows: DataFrame, longest: int, buckets: int, crossing: bool | None) -> DataFrame:
    """bucket and n, summed in each task, of texts (first column) that count as often as the second column says."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for part in in_slices(batches, 8192):
            times = part.column(1).to_numpy()
            for text, bucket in Words(part.column(0)).runs(longest, buckets, crossing):
                np.add.at(total, bucket, times[text])
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], names=["bucket", "n"])

    return rows.mapInArrow(run, "bucket bigint, n bigint")


def distinct_lines(texts: DataFrame, text_column: str) -> DataFrame:
    """line and occurrences of every different line of the texts that can hold a word; tasks combine theirs first."""
    lines = texts.select(F.explode(F.split(F.col(text_column).cast("string"), "\n")).alias("line"))
    return lines.where(F.col("line") != "").groupBy("line").agg(F.count(F.lit(1)).alias("occurrences"))


def count_buckets(texts: DataFrame, text_column: str = "text", longest: int = LONGEST_RUN, buckets: int = BUCKETS) -> np.ndarray:
    """How many features of all texts are in each bucket."""
    lines = distinct_lines(texts, text_column).select(F.col("line").cast("binary"), "occurrences")
    found = _bucket_counts(lines, longest, buckets, False)
    if longest > 1:
        whole = texts.select(F.col(text_column).cast("binary"), F.lit(1).cast("bigint"))
        found = found.unionByName(_bucket_counts(whole, longest, buckets, True))
    sums = found.groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()  # one row per bucket at most
    counts = np.zeros(buckets, np.int64)
    counts[sums["bucket"].to_numpy()] = sums["n"].to_numpy()
    return counts


def bucket_gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """How much likelier a bucket's features are in the target, in thousandths of a nat, rounded down."""
    k, all_corpus, all_target = len(corpus), int(corpus.sum()), int(target.sum())
    return np.array([
        math.floor(1000 * math.log((t + 1.0) * (all_corpus + k) / ((s + 1.0) * (all_target + k))))
        for s, t in zip(corpus.tolist(), target.tolist())
    ], np.int64)


def _scored(docs: DataFrame, gains: np.ndarray, longest: int) -> DataFrame:
    """The packed rows with their number of features and of words and their weight."""
    shared = docs.sparkSession.sparkContext.broadcast(gains)  # one number per bucket

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gain = shared.value
        for part in in_slices(batches):
            texts = pc.fill_null(part.column(1), b"")
            lists = pc.split_pattern(texts, b"\n")
            owner = np.repeat(np.arange(part.num_rows), np.diff(lists.offsets.to_numpy()))
            coded = lists.flatten().dictionary_encode()
            lines = Words(coded.dictionary)
            features, sums, words = (np.zeros(len(coded.dictionary), np.int64) for _ in range(3))
            np.add.at(words, lines.text, 1)
            for line, bucket in lines.runs(longest, len(gain), False):
                np.add.at(features, line, 1)
                np.add.at(sums, line, gain[bucket])
            out = [np.zeros(part.num_rows, np.int64) for _ in range(3)]
            at = coded.indices.to_numpy()
            for to, of in zip(out, (features, sums, words)):
                np.add.at(to, owner, of[at])
            if longest > 1:
                for text, bucket in Words(texts).runs(longest, len(gain), True):
                    np.add.at(out[0], text, 1)
                    np.add.at(out[1], text, gain[bucket])
            weight = np.where(out[0] > 0, out[1] // np.maximum(out[0], 1), 0)
            columns = [part.column(0), *map(pa.array, (out[0], weight, out[2]))]
            yield pa.RecordBatch.from_arrays(columns, names=["row", "n_features", "weight", "n_words"])

    longs = [T.StructField(n, T.LongType()) for n in ("n_features", "weight", "n_words")]
    return docs.mapInArrow(run, T.StructType([T.StructField("row", docs.schema[0].dataType), *longs]))


def noise(doc_id: Column, seed: int = SEED) -> Column:
    """A Gumbel number in thousandths, from a hash of the id; a null id draws as an empty one."""
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    drawn = F.conv(F.substring(F.sha2(key.cast("binary"), 256), 1, 8), 16, 10).cast("bigint")
    return F.floor(-1000 * F.ln(-F.ln((drawn + 0.5) / 4294967296.0))).cast("bigint")


def ranked(scored: DataFrame, eligible: Column, percent: int) -> DataFrame:
    """``scored`` (score, id and others) with rank: 1, 2, 3... for the best ``percent`` of the eligible rows, else null.

    Ties go to the smaller id, null ids last. Scores are whole numbers of a bounded range, so the histogram that
    comes to the driver is bounded, and no score has more than some 0.04 % of the rows, as the noise spreads them.
    """
    counts = scored.where(eligible).groupBy("score").agg(F.count(F.lit(1)).alias("n")).toArrow()
    order = np.argsort(-counts["score"].to_numpy(), kind="stable")
    scores, n = counts["score"].to_numpy()[order], counts["n"].to_numpy()[order]
    wanted = percent * int(n.sum()) // 100
    before = np.cumsum(n) - n
    drawn = before < wanted
    places = [{"of": int(s), "before": int(b)} for s, b in zip(scores[drawn], before[drawn])]
    schema = T.StructType([T.StructField(c, T.LongType(), False) for c in ("of", "before")])
    best = F.broadcast(small_frame(scored.sparkSession, places, schema))  # a row per score
    out = scored.join(best, (F.col("score") == F.col("of")) & eligible, "left")
    inside, rest = out.where(F.col("of").isNotNull()), out.where(F.col("of").isNull())
    ties = Window.partitionBy("of").orderBy(F.col("id").asc_nulls_last(), "weight", "n_features")
    rank = F.col("before") + F.row_number().over(ties)
    inside = inside.withColumn("rank", F.when(rank <= wanted, rank).cast("bigint"))
    rest = rest.withColumn("rank", F.lit(None).cast("bigint"))
    return inside.unionByName(rest).drop("of", "before")


def resample(
    docs: DataFrame,
    targets: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    target_text: str = "text",
    longest: int = LONGEST_RUN,
    buckets: int = BUCKETS,
    seed: int = SEED,
    least_words: int = LEAST_WORDS,
    percent: int = PERCENT,
    columns: list[str] | None = None,
) -> DataFrame:
    """The columns of ``docs`` (or those named) with n_features, weight, score and rank, all long.

    ``weight`` is the mean gain of the document's features, rounded down, 0 if it has none; ``score`` adds Gumbel
    noise from a hash of its id, so that the ``percent`` of documents with the highest scores, among those
    of ``least_words`` words, are a draw by weight without repeats. ``rank`` tells the drawn ones. Ids are whole
    numbers; ties go to the smaller, null ids draw as an empty one and come last. A null text has no words.
    Rows that repeat are documents each, also in the counts. Without target texts all targets count 0. An
    empty table stays empty. Added columns replace those of their name; others pass through.
    """
    gains = bucket_gains(
        count_buckets(docs, text_column, longest, buckets), count_buckets(targets, target_text, longest, buckets)
    )
    kept = docs.select(*[docs[f"`{c}`"] for c in columns]) if columns else docs
    rows = docs.select(
        F.struct(F.col(id_column).cast("bigint").alias("id"), packed(kept)).alias("row"), F.col(text_column).cast("binary")
    )
    scored = _scored(rows, gains, longest)
    scored = scored.select(
        F.col("row.id").alias("id"), F.col(f"row.{ROW}").alias(ROW), "n_features", "weight", "n_words",
        (F.col("weight") + noise(F.col("row.id"), seed)).alias("score"),
    )
    out = ranked(written(scored, "resampling-scored"), F.col("n_words") >= least_words, percent)
    return unpacked(out, kept, **{c: F.col(c) for c in ("n_features", "weight", "score", "rank")})


def op13_segment_resampling(spark, sf_dir):
    """Weight, score and rank of every document, towards the benchmark's texts."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    targets = spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("text")
    return resample(docs, targets, columns=["doc_id"])


OP13_SQL = r"""
WITH polynomial AS (
  SELECT list_transform(range(256), lambda i: list_reduce(range(8), lambda c, k:
    CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i)) AS codes
), d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
  FROM documents
), b AS (
  SELECT unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                   '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS word
  FROM benchmark
), s AS (
  SELECT word, count(*) AS n FROM (SELECT unnest(words) AS word FROM d) GROUP BY word
), t AS (
  SELECT word, count(*) AS n FROM b GROUP BY word
), hashed AS (
  SELECT word, xor(list_reduce(list_transform(range(1, CAST(length(hex(encode(word))) AS BIGINT), 2),
                                 lambda i: CAST('0x' || hex(encode(word))[i:i + 1] AS BIGINT)),
                               lambda c, x: xor(codes[(xor(c, x) & 255) + 1], c >> 8), 4294967295), 4294967295) % 10000 AS bucket
  FROM (SELECT word FROM s UNION SELECT word FROM t), polynomial
), gains AS (
  SELECT bucket, CAST(floor(1000 * ln((coalesce(sum(t.n), 0) + 1) * CAST((SELECT sum(n) FROM s) + 10000 AS DOUBLE)
                     / ((coalesce(sum(s.n), 0) + 1) * CAST((SELECT coalesce(sum(n), 0) FROM t) + 10000 AS DOUBLE)))) AS BIGINT) AS gain
  FROM hashed LEFT JOIN s USING (word) LEFT JOIN t USING (word) GROUP BY bucket
), features AS (
  SELECT doc_id, row, unnest(words) AS word FROM (SELECT *, row_number() OVER () AS row FROM d)
), weights AS (
  SELECT row, count(*) AS n_features, CAST(floor(sum(gain) / count(*)) AS BIGINT) AS weight
  FROM features JOIN hashed USING (word) JOIN gains USING (bucket) GROUP BY row
), scored AS (
  SELECT doc_id, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
         coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln(
           (CAST('0x' || sha256('2024:' || coalesce(CAST(doc_id AS VARCHAR), ''))[1:8] AS BIGINT) + 0.5) / 4294967296.0))) AS BIGINT) AS score
  FROM (SELECT doc_id, row_number() OVER () AS row FROM d) LEFT JOIN weights USING (row)
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id NULLS LAST, weight, n_features) AS place,
         count(*) OVER (PARTITION BY n_features >= 20) AS all_of
  FROM scored
)
SELECT doc_id, n_features, weight, score, CASE WHEN n_features >= 20 AND place <= all_of * 10 // 100 THEN place END AS rank
FROM placed
"""

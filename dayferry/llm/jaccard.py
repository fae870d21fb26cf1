"""Join of similar texts along chosen paths.

Texts are sets of five-word shingles. A run splits all sets by a token that each set samples: the
smallest of its shingles under the run's hash, so sets that share much sample the same one. A
bucket that is still large is split again by the next sampled token, down to a bounded depth; the
tokens along the way are the path. Buckets of one path are compared by brute force on whole
sets. A pair at the least similarity takes the same path in a run with a known probability, and
runs are repeated until the target recall.

Equal texts are joined first, by a digest, and take part once. A pair that meets in several
buckets is counted in the first. A bucket that can't be split, as thousands of near copies, is cut into
blocks that are compared two by two in tasks of their own; no pair becomes a row.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dayferry.frames import written
from dayferry.llm.shingles import WORDS, shingles
from dayferry.llm.text import packed, unpacked
from dayferry.llm.tokens import in_slices
from dayferry.llm.workers import leaves_nothing

SIMILARITY = 0.8
RECALL = 0.99999
DEPTH = 3
BUCKET = 256  # sets that are compared without splitting them further
BLOCK = 768  # sets in a block of a bucket that can't be split
BROADCAST_ROWS = 200_000  # digests and ids that a task may hold to pick texts; beyond, they are joined by a shuffle
DENSE = 16  # texts that must share a shingle for it to be counted by matrices
MAX_ROUNDS = 40


def runs_needed(similarity: float, recall: float, depth: int) -> int:
    """Runs after which a pair of this similarity has met with the probability ``recall``, whatever the depth."""
    return math.ceil(math.log(1 - recall) / math.log(1 - similarity**depth))


def _sketches(rows: DataFrame, tokens: int, words: int) -> DataFrame:
    """digest, id and the sampled tokens of each row."""
    rng = np.random.default_rng(6)
    factors = rng.integers(1 << 62, 1 << 63, tokens, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    shifts = rng.integers(0, 1 << 63, tokens, dtype=np.uint64)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        leaves_nothing()
        for part in in_slices(batches):
            found, starts = shingles(part.column(0), words)
            full = np.diff(starts) > 0
            out = np.zeros((part.num_rows, tokens), np.int64)
            if full.any():
                at = starts[:-1][full]
                for k in range(tokens):
                    least = np.minimum.reduceat(found * factors[k] + shifts[k], at)
                    out[full, k] = least.view(np.int64)
            lists = pa.ListArray.from_arrays(
                pa.array(np.arange(0, tokens * part.num_rows + 1, tokens), pa.int32()), pa.array(out.reshape(-1))
            )
            whole = pa.RecordBatch.from_arrays([part.column(1), part.column(2), lists], names=["digest", "id", "tokens"])
            yield whole.filter(pa.array(full))
        leaves_nothing()

    schema = rows.select("digest", "id", F.array().cast("array<bigint>").alias("tokens")).schema
    return rows.select("text", "digest", "id").mapInArrow(run, schema)


def _buckets(sets: DataFrame, runs: int, depth: int, most: int) -> DataFrame:
    """bucket, digest and n: the buckets of two sets or more, those too large split along their paths."""
    steps = F.transform(
        F.sequence(F.lit(0), F.lit(runs - 1)),
        lambda r: F.struct(
            F.xxhash64(r, F.get("tokens", r * depth)).alias("bucket"),
            F.slice("tokens", r * depth + 2, depth - 1).alias("rest"),
        ),
    )
    level = sets.select("digest", F.explode(steps).alias("s")).select("digest", "s.*")
    leaves = []
    for at in range(depth):
        sizes = level.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)
        known = written(level.join(sizes, "bucket"), "jaccard-level")
        if at == depth - 1:
            leaves.append(known.select("bucket", "digest"))
        else:
            leaves.append(known.where(F.col("n") <= most).select("bucket", "digest"))
            level = known.where(F.col("n") > most).select(
                "digest", F.xxhash64("bucket", F.get("rest", F.lit(at))).alias("bucket"), "rest"
            )
    found = leaves[0]
    for other in leaves[1:]:
        found = found.unionByName(other)
    # Buckets of the same members need one comparison.
    members = found.groupBy("bucket").agg(
        F.count(F.lit(1)).alias("n"),
        F.bit_xor(F.xxhash64(F.lit(1), "digest")).alias("x"),
        F.bit_xor(F.xxhash64(F.lit(2), "digest")).alias("y"),
    )
    once = members.groupBy("n", "x", "y").agg(F.min("bucket").alias("bucket")).select("bucket", "n")
    return found.join(once, "bucket")


def _pick_texts(rows: DataFrame, wanted: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The rows of the wanted digests that have their least id; the text isn't shuffled if few are wanted."""
    wanted = wanted.select(F.col("digest").alias("w_digest"), F.col("least_id").alias("w_id"))
    few = wanted.count() <= BROADCAST_ROWS
    wanted = F.broadcast(wanted) if few else wanted
    same = (F.col("digest") == F.col("w_digest")) & F.col("id").eqNullSafe(F.col("w_id"))
    return rows.join(wanted, same).select(*columns)


def _sets(rows: DataFrame, words: int) -> DataFrame:
    """digest and the sorted different shingles, as bytes."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in in_slices(batches, 512):
            found, starts = shingles(part.column(0), words)
            sets = [np.unique(found[a:b]).tobytes() for a, b in zip(starts[:-1], starts[1:])]
            yield pa.RecordBatch.from_arrays([part.column(1), pa.array(sets, pa.binary())], names=["digest", "shingles"])
        leaves_nothing()

    return rows.select("text", "digest").mapInArrow(run, "digest binary, shingles binary")


def shared_counts(sets: Sequence[np.ndarray]) -> np.ndarray:
    """How many elements each two sets share. Rare elements add to their pairs, common ones go by matrix products."""
    g = len(sets)
    sizes = np.array([len(s) for s in sets])
    owner = np.repeat(np.arange(g), sizes)
    values = np.concatenate(sets) if g else np.zeros(0, np.uint64)
    order = np.argsort(values, kind="stable")
    values, owner = values[order], owner[order]
    first = np.flatnonzero(np.concatenate([[True], values[1:] != values[:-1]])) if len(values) else np.zeros(0, np.int64)
    often = np.diff(np.concatenate([first, [len(values)]]))
    out = np.zeros(g * g, np.float32)
    for f in range(2, DENSE + 1):
        at = first[often == f]
        if len(at):
            members = owner[at[:, None] + np.arange(f)]
            a, b = np.triu_indices(f, 1)
            for some in np.array_split(members, max(1, members.size * f // 4_000_000)):
                out += np.bincount((some[:, a] * g + some[:, b]).reshape(-1), minlength=g * g)
    out = out.reshape(g, g)
    out = out + out.T
    common = np.flatnonzero(often > DENSE)
    for i in range(0, len(common), 2048):
        some = common[i : i + 2048]
        lengths = often[some]
        at = np.repeat(first[some] - (np.cumsum(lengths) - lengths), lengths) + np.arange(lengths.sum())
        x = np.zeros((g, len(some)), np.float32)
        x[owner[at], np.repeat(np.arange(len(some)), lengths)] = 1
        out += x @ x.T
    out[np.arange(g), np.arange(g)] = sizes
    return out


def _components(links: np.ndarray) -> np.ndarray:
    """For each row the least row that it is linked to over any way."""
    labels = np.arange(len(links))
    while True:
        least = np.minimum(labels, np.where(links, labels[None, :], len(links)).min(1))
        least = least[least]
        if (least == labels).all():
            return labels
        labels = least


def _compare(similarity: float):
    """Compares the sets of a bucket, or of two of its blocks; returns each linked set's number of links and a root."""
    percent = round(similarity * 100)

    def compared(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        bucket, low, high = int(key[0]), int(key[1]), int(key[2])
        rows = rows.sort_values("digest").reset_index(drop=True)
        sets = [np.frombuffer(x, np.uint64) for x in rows["shingles"]]
        sizes = np.array([len(s) for s in sets], np.float64)
        inter = shared_counts(sets).astype(np.float64)
        links = 100 * inter >= percent * (sizes[:, None] + sizes[None, :] - inter)
        np.fill_diagonal(links, False)
        if low != high:
            block = rows["block"].to_numpy()
            links &= block[:, None] != block[None, :]
        # A pair that shares an earlier bucket was counted there.
        earlier: dict[int, list[int]] = {}
        for i, found in enumerate(rows["buckets"]):
            for b in found:
                if b < bucket:
                    earlier.setdefault(b, []).append(i)
        for members in earlier.values():
            if len(members) > 1:
                links[np.ix_(members, members)] = False
        n = links.sum(1)
        linked = n > 0
        roots = _components(links)
        digests = rows["digest"].to_numpy()
        return pd.DataFrame({"digest": digests[linked], "root": digests[roots[linked]], "links": n[linked].astype(np.int64)})

    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        out = compared(key, rows)
        if len(rows) > BUCKET:  # the matrices of such a bucket are some megabytes each
            leaves_nothing()
        return out

    return run


def _roots(edges: DataFrame) -> DataFrame:
    """node and root of every node of the edges (a, b): the least node it is connected to.

    Large and small stars in turn, each two aggregates and a join, until nothing changes; every round is
    written, and only a count and a checksum come to the driver.
    """

    def mark(e: DataFrame) -> tuple:
        return tuple(e.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first())

    def smaller(e: DataFrame) -> DataFrame:
        return e.where(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()

    edges = written(smaller(edges), "jaccard-stars")
    seen = mark(edges)
    for _ in range(MAX_ROUNDS):
        if not seen[0]:
            break
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = both.join(least, "a").where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = smaller(large)
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        edges = written(smaller(small.unionByName(least.select("a", F.col("m").alias("b")))), "jaccard-stars")
        now = mark(edges)
        if now == seen:
            break
        seen = now
    else:
        raise RuntimeError(f"classes still change after {MAX_ROUNDS} rounds")
    return edges.select(F.col("a").alias("digest"), F.col("b").alias("root"))


def find_classes(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    similarity: float = SIMILARITY,
    recall: float = RECALL,
    depth: int = DEPTH,
    words: int = WORDS,
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """The columns of ``docs`` (or those named) with class_id, n_links, n_copies, text_digest and keeper.

    Two texts are linked if their sets of shingles have a Jaccard similarity of ``similarity`` or more; a
    class is what is connected by links. ``class_id`` is the least id of the class (null if it has none),
    ``n_links`` the number of other different texts that a text is linked to, ``n_copies`` the rows with the
    very same text. ``keeper`` marks the rows that have the least id of their class, with the text that
    has it; rows that repeat as a whole are all marked. A text of fewer words than a shingle is one shingle.
    Texts without a word, null ones too, are classes of their own row each. Other columns pass
    through, but for those that have an added name. An empty table stays empty.
    """
    runs = runs_needed(similarity, recall, depth)
    text = F.coalesce(F.col(text_column), F.lit(""))
    digest = F.unhex(F.md5(text.cast("binary")))
    rows = docs.select(text.cast("binary").alias("text"), digest.alias("digest"), F.col(id_column).alias("id"))
    sketches = _sketches(rows, runs * depth, words)
    texts = written(
        sketches.groupBy("digest").agg(
            F.min("id").alias("least_id"), F.count(F.lit(1)).alias("copies"), F.any_value("tokens").alias("tokens")
        ),
        "jaccard-texts",
    )
    buckets = written(_buckets(texts, runs, depth, BUCKET), "jaccard-buckets")
    own = buckets.groupBy("digest").agg(F.sort_array(F.collect_list("bucket")).alias("buckets"))  # a few for each run
    wanted = own.join(texts.select("digest", "least_id"), "digest")
    wanted = written(wanted, "jaccard-wanted")
    sets = _sets(_pick_texts(rows, wanted, ["text", "digest"]), words)
    sets = sets.groupBy("digest").agg(F.any_value("shingles").alias("shingles")).join(wanted.select("digest", "buckets"), "digest")
    blocks = F.ceil(F.col("n") / BLOCK).cast("int")
    block = F.pmod(F.xxhash64(F.lit(3), "digest"), F.col("blocks")).cast("int")
    placed = buckets.withColumn("blocks", blocks).withColumn("block", block)
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    placed = placed.select("bucket", "digest", "block", other.alias("other")).select(
        "bucket", "digest", "block", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high")
    )
    compared = (
        placed.join(sets, "digest")
        .groupBy("bucket", "low", "high")
        .applyInPandas(_compare(similarity), "digest binary, root binary, links bigint")
    )
    links = written(compared, "jaccard-links")
    counts = links.groupBy("digest").agg(F.sum("links").alias("links"))
    roots = _roots(links.select(F.col("digest").alias("a"), F.col("root").alias("b")))
    known = texts.select("digest", "least_id", "copies").join(counts, "digest", "left").join(roots, "digest", "left")
    known = known.withColumn("root", F.coalesce("root", "digest"))
    ids = known.groupBy(F.col("root").alias("of")).agg(
        F.min("least_id").alias("class_id"), F.min_by("digest", F.struct(F.col("least_id").isNull(), "least_id", "digest")).alias("keeps")
    )
    classes = known.join(ids, F.col("root") == F.col("of")).select(
        F.col("digest").alias("c_digest"), "least_id", "copies", "links", "class_id", "keeps"
    )
    kept = docs.select(*[docs[f"`{c}`"] for c in columns]) if columns else docs
    out = docs.select(packed(kept), digest.alias("__digest"), F.col(id_column).alias("__id"))
    joined = out.join(written(classes, "jaccard-classes"), F.col("__digest") == F.col("c_digest"), "left")
    single = F.col("c_digest").isNull()  # no words
    return unpacked(
        joined,
        kept,
        class_id=F.when(single, F.col("__id")).otherwise(F.col("class_id")),
        n_links=F.coalesce(F.col("links"), F.lit(0).cast("bigint")),
        n_copies=F.coalesce(F.col("copies"), F.lit(1).cast("bigint")),
        text_digest=F.col("__digest"),
        keeper=single | ((F.col("__digest") == F.col("keeps")) & F.col("__id").eqNullSafe(F.col("least_id"))),
    )


def one_of_each_class(docs: DataFrame, **settings) -> DataFrame:
    """The rows of ``docs`` that keep their class, one of those that repeat as a whole."""
    found = find_classes(docs, **settings)
    # Rows of one text lie together after the join with their classes, so this needs no other shuffle.
    once = found.where("keeper").dropDuplicates(["class_id", "text_digest"])
    return once.select(*[once[f"`{c}`"] for c in docs.columns])


def op6_chosen_path_join(spark, sf_dir):
    """The class of every document, and how many other texts it is linked to."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return find_classes(docs, columns=["doc_id"]).select("doc_id", "class_id", "n_links", "n_copies")

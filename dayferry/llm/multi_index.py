"""Nearest neighbours by an inverted multi-index.

The two halves of all vectors are quantised apart, each by its own centroids, fitted on a bounded
sample. The index holds every vector under its pair of centroids. A query walks through the pairs in
order of the sum of its halves' distances to them, off a heap, until the pairs hold a given share of all
vectors, and reranks their entries by the exact distance.

Entries are dealt by the first centroid, and a centroid with many entries over several tasks. A query
goes to each of them with the pairs it has chosen there and takes its nearest from each; only
these meet. Many queries are dealt into blocks by hash, and each block meets entries of its own, so
neither side of a group grows with the table.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dayferry.frames import written
from dayferry.llm.tokens import in_slices

CENTROIDS = 64  # of each half; their square is the number of pairs
SAMPLE = 16_384  # vectors that the centroids are fitted on at most, those whose ids have the smallest hashes
STEPS = 12
SHARE = 0.5  # of all vectors that a query reranks
LEAST = 1_000  # vectors that a query reranks at least, if there are so many
NEAREST = 10
TASK_ENTRIES = 20_000
QUERY_BLOCK = 16_384  # queries that meet a task's entries at once, on average


def usable(vectors: DataFrame, id_column: str, vector_column: str) -> DataFrame:
    """id and vector, as doubles, of the rows that take part."""
    vector = F.col(vector_column).cast("array<double>")
    rows = vectors.select(F.col(id_column).alias("id"), vector.alias("vector"))
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = rows.where(F.col("id").isNotNull() & F.col("vector").isNotNull() & F.coalesce(finite, F.lit(False)))
    return rows.where(F.exists("vector", lambda x: x != 0))


def fit_centroids(sample: np.ndarray, k: int, steps: int = STEPS) -> np.ndarray:
    """Lloyd's steps from points that the sample spreads; empty centroids stay where they are."""
    if not sample.shape[1]:  # a half without numbers, of vectors of one
        return np.zeros((1, 0))
    rng = np.random.default_rng(3)
    distinct = np.unique(sample, axis=0)
    centroids = distinct[rng.choice(len(distinct), min(k, len(distinct)), replace=False)]
    for _ in range(steps):
        at = nearest_centroid(sample, centroids)
        counts = np.bincount(at, minlength=len(centroids))
        sums = np.zeros_like(centroids)
        np.add.at(sums, at, sample)
        full = counts > 0
        centroids[full] = sums[full] / counts[full, None]
    return centroids


def half_distances(points: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    return (points**2).sum(1)[:, None] - 2 * points @ centroids.T + (centroids**2).sum(1)


def nearest_centroid(points: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    return half_distances(points, centroids).argmin(1)


def walk(first: np.ndarray, second: np.ndarray, sizes: np.ndarray, wanted: int) -> list[tuple[int, int]]:
    """Pairs in order of the sum of their distances until they hold ``wanted`` entries. Empty pairs are passed over."""
    a, b = np.argsort(first, kind="stable"), np.argsort(second, kind="stable")
    heap = [(first[a[0]] + second[b[0]], 0, 0)]
    out, found = [], 0
    while heap and found < wanted:
        _, i, j = heapq.heappop(heap)
        size = sizes[a[i], b[j]]
        if size:
            out.append((int(a[i]), int(b[j])))
            found += int(size)
        # Each pair is pushed once: along the second half from any, along the first from a row's start.
        if j + 1 < len(b):
            heapq.heappush(heap, (first[a[i]] + second[b[j + 1]], i, j + 1))
        if j == 0 and i + 1 < len(a):
            heapq.heappush(heap, (first[a[i + 1]] + second[b[0]], i + 1, 0))
    return out


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _nearest(n: int):
    """The nearest of one task's entries for every query that comes to it."""

    def run(entries: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(entries) and len(queries):
            ids = entries["id"].to_numpy()
            points = np.frombuffer(b"".join(entries["vector"]), np.float64).reshape(len(ids), -1)
            by_second: dict[int, np.ndarray] = {c: np.asarray(x) for c, x in entries.groupby("second").indices.items()}
            for query, vector, seconds in zip(queries["query"], queries["vector"], queries["seconds"]):
                at = [by_second[c] for c in seconds if c in by_second]
                if not at:
                    continue
                at = np.concatenate(at)
                at = at[ids[at] != query]
                if not len(at):
                    continue
                gaps = points[at] - np.frombuffer(vector, np.float64)
                distances = np.sqrt((gaps * gaps).sum(1))
                if len(at) > n:
                    near = distances <= np.partition(distances, n - 1)[n - 1]
                    at, distances = at[near], distances[near]
                best = np.lexsort((ids[at], distances))[:n]
                out += [(query, ids[at[i]], distances[i]) for i in best]
        return pd.DataFrame(out, columns=["query", "id", "score"]).astype({"query": "int64", "id": "int64", "score": "float64"})

    return run


def search(
    vectors: DataFrame,
    queries: Column,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    nearest: int = NEAREST,
    centroids: int = CENTROIDS,
    share: float = SHARE,
    least: int = LEAST,
    sample: int = SAMPLE,
    query_block: int = QUERY_BLOCK,
) -> DataFrame:
    """query_id, rank, the neighbour's id, and score, the Euclidean distance, for each row that is a query.

    ``queries`` is a condition on the ids; all rows are candidates, but a query's own id. Vectors that are null,
    zero, or hold null or non-finite numbers take no part, nor do rows without an id or vectors of
    another length than most; ids are whole numbers. Ties go to the smaller id; rows that repeat
    are candidates each. An empty table, or one without queries, gives no rows. Other columns take no part.
    """
    known = written(usable(vectors, id_column, vector_column), "multi-index-vectors")
    lengths = known.groupBy(F.size("vector").alias("length")).agg(F.count(F.lit(1)).alias("n"))
    length = lengths.orderBy(F.desc("n"), "length").limit(1).collect()
    length = length[0]["length"] if length else 2
    known = known.where(F.size("vector") == length).select(F.col("id").cast("bigint").alias("id"), "vector")
    drawn = known.orderBy(F.xxhash64("id"), "id").limit(sample).toArrow()["vector"].combine_chunks()  # bounded by ``sample``
    points = _matrix(drawn) if len(drawn) else np.zeros((1, length))
    half = length // 2
    codebooks = fit_centroids(points[:, :half].copy(), centroids), fit_centroids(points[:, half:].copy(), centroids)

    def place(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in in_slices(batches):
            x = _matrix(part.column(1))
            first, second = nearest_centroid(x[:, :half], codebooks[0]), nearest_centroid(x[:, half:], codebooks[1])
            data = pa.array([row.tobytes() for row in np.ascontiguousarray(x)], pa.binary())
            columns = [part.column(0), pa.array(first.astype(np.int32)), pa.array(second.astype(np.int32)), data]
            yield pa.RecordBatch.from_arrays(columns, names=["id", "first", "second", "vector"])

    entries = written(known.mapInArrow(place, "id bigint, first int, second int, vector binary"), "multi-index")
    counted = entries.groupBy("first", "second").agg(F.count(F.lit(1)).alias("n")).collect()  # one row per pair at most
    sizes = np.zeros((len(codebooks[0]), len(codebooks[1])), np.int64)
    for r in counted:
        sizes[r["first"], r["second"]] = r["n"]
    wanted = max(math.ceil(share * sizes.sum()), least)
    tasks = np.maximum(1, -(-sizes.sum(1) // TASK_ENTRIES))

    def choose(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in in_slices(batches, 256):
            rows = []
            for query, data in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                x = np.frombuffer(data, np.float64)[None, :]
                distances = half_distances(x[:, :half], codebooks[0])[0], half_distances(x[:, half:], codebooks[1])[0]
                chosen: dict[int, list[int]] = {}
                for a, b in walk(*distances, sizes, wanted):
                    chosen.setdefault(a, []).append(b)
                rows += [(query, data, a, t, b) for a, b in chosen.items() for t in range(tasks[a])]
            if rows:
                kinds = [pa.int64(), pa.binary(), pa.int32(), pa.int32(), pa.list_(pa.int32())]
                names = ["query", "vector", "first", "task", "seconds"]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=names)

    asked = entries.where(queries).select(F.col("id").alias("query"), "vector").distinct()
    blocks = max(1, -(-asked.count() // query_block))
    routed = asked.mapInArrow(choose, "query bigint, vector binary, first int, task int, seconds array<int>")
    routed = routed.withColumn("block", F.pmod(F.xxhash64("query", "vector"), F.lit(blocks)).cast("int"))
    numbers = F.element_at(F.array(*[F.lit(int(t)) for t in tasks]), F.col("first") + 1)
    dealt = entries.withColumn("task", F.pmod(F.xxhash64("id"), numbers).cast("int"))
    dealt = dealt.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    found = (
        dealt.groupBy("first", "task", "block")
        .cogroup(routed.groupBy("first", "task", "block"))
        .applyInPandas(_nearest(nearest), "query bigint, id bigint, score double")
    )
    # The rank is limited in every task before the shuffle.
    order = Window.partitionBy("query").orderBy("score", "id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= nearest)
    return ranked.select(F.col("query").alias("query_id"), "rank", F.col("id").alias(id_column), "score")


def op3_multi_index_search(spark, sf_dir):
    """The nearest neighbours found for every hundredth vector."""
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding")
    return search(vectors, F.col("id") % 100 == 0)

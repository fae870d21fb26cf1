"""Pairs of near-equal vectors by a dual traversal of cover trees.

Vectors are put on the unit sphere, where a cosine of at least the threshold is a distance of at most t.
Nodes have a centre and a covering radius, the largest distance of what they hold to the centre. If the centres of
two nodes lie further apart than t and both radii, no pair between them is a link; if they lie nearer than t less
both radii, all are. Else the children of both are looked at. So pairs are exact, and groups of copies are
linked as a whole, without looking at their pairs.

Equal vectors become one point with a number of copies. The upper nodes come from a bounded sample: balls, of
at most half the threshold, around directions where many vectors lie, and cells around points far apart.
A ball's members are all linked; besides, only points near its border can link with them. Cells whose
bounds allow links meet block by block; a block holds a bounded number of points and a cover tree of them,
nested levels with halving radii, and a task traverses the trees of two blocks. Each point is
written once; the blocks that meet are joined by their names. On vectors without any structure in many
dimensions no bound can separate cells, and the blocks meet all others.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dayferry.frames import small_frame, written
from dayferry.llm.jaccard import _roots
from dayferry.llm.text import ROW, packed, unpacked
from dayferry.llm.tokens import in_slices

THRESHOLD = 0.9
BLOCK = 8192  # points of a block, on average at most
SAMPLE = 2048  # points that the upper nodes are chosen from
CELLS = 1024  # of vectors of one length, at most
BALLS = 64
LEAST_BALL = 16  # sampled points
#: Of a block's levels below the root; the last level holds all points. Two nodes of radius 1 could never be told apart.
RADII = (0.5, 0.25, 0.125)
MARGIN = 1e-7  # of distances, for rounding
_MATRIX = 1 << 21  # distances worked out at once


def _takes_part(vector: Column) -> Column:
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def _bytes(vectors: pa.Array, kind: str) -> list[bytes]:
    flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(kind) + np.zeros(1, kind)  # no negative zeros
    ends = np.cumsum(np.diff(vectors.offsets.to_numpy())).tolist()
    return [flat[a:b].tobytes() for a, b in zip([0, *ends], ends)]


def _digest(data: bytes) -> bytes:
    return hashlib.blake2b(data, digest_size=16).digest()


def unit_rows(data: list[bytes], kind: str) -> np.ndarray:
    """Vectors of one length on the unit sphere, in double precision."""
    x = np.frombuffer(b"".join(data), kind).reshape(len(data), -1).astype(np.float64)
    x /= np.abs(x).max(1, keepdims=True)  # no square overflows or vanishes
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def distances(cosines: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(2 - 2 * cosines, 0))


def reach(threshold: float) -> float:
    """The largest distance of linked points."""
    return math.sqrt(2 - 2 * threshold)


class Upper:
    """The upper nodes for vectors of one length: balls first, then cells."""

    def __init__(self, sample: np.ndarray, points: int, threshold: float, block: int, cells: int):
        t = reach(threshold)
        self.reach, self.radius = t, t / 2 * (1 - 1e-6)
        near = 1 - self.radius**2 / 2
        least = max(LEAST_BALL, math.ceil(2 * block * len(sample) / points))
        balls, rest = [], sample
        while len(rest) and len(balls) < BALLS:
            close = rest @ rest.T >= near
            best = int(close.sum(1).argmax())
            centre = rest[close[best]].mean(0)
            centre /= np.sqrt((centre * centre).sum())
            inside = rest @ centre >= near
            if inside.sum() < least:
                break
            balls.append(centre)
            rest = rest[~inside]
        self.balls = np.array(balls).reshape(-1, sample.shape[1])
        rest = rest if len(rest) else sample[:1]
        chosen, gap = [0], np.full(len(rest), np.inf)
        for _ in range(min(cells, math.ceil(points / block)) - 1):
            gap = np.minimum(gap, distances(rest @ rest[chosen[-1]]))
            if gap.max() <= MARGIN:
                break
            chosen.append(int(gap.argmax()))
        self.cells = rest[chosen]

    def place(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The node of each point, its distance to the centre, and the balls (a matrix of marks) it may have links in."""
        cosines = x @ self.cells.T
        node = cosines.argmax(1)
        gap = distances(cosines[np.arange(len(x)), node])
        node = node + len(self.balls)
        border = np.zeros((len(x), len(self.balls)), bool)
        if len(self.balls):
            gaps = distances(x @ self.balls.T)
            ball = gaps.argmin(1)
            inside = gaps[np.arange(len(x)), ball] <= self.radius
            node[inside], gap[inside] = ball[inside], gaps[inside, ball[inside]]
            # Two balls meet once: the members of the later one are at the border of the earlier.
            border = (gaps <= self.reach + self.radius + MARGIN) & (np.arange(len(self.balls)) < node[:, None])
        return node, gap, border


def cover_levels(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each point the first level it is a node of, its ancestors' places and, where it is a node, its covering radii.

    Level 0 is the first point; every further one has the nodes before and others, so that nodes are further apart
    than its radius and each point lies within it; the last level has all points.
    """
    n, depth = len(x), len(RADII) + 1
    level = np.full(n, depth, np.int32)
    level[0] = 0
    ancestors, radii = np.zeros((n, depth), np.int32), np.zeros((n, depth))
    for k, r in enumerate(RADII, 1):
        near = 1 - r * r / 2
        left = np.flatnonzero(level == depth)
        left = left[_most(x, left, np.flatnonzero(level < k))[0] < near]
        while len(left):
            some, left = left[:512], left[512:]
            close = x[some] @ x[some].T >= near
            alive = np.ones(len(some), bool)
            for i in range(len(some)):
                if alive[i]:
                    alive[i + 1 :] &= ~close[i, i + 1 :]
            new = some[alive]
            level[new] = k
            left = left[_most(x, left, new)[0] < near]
    # Each node's parent is the nearest node of the level above; points follow their parents up.
    for k in range(depth, 0, -1):
        nodes, above = np.flatnonzero(level <= k), np.flatnonzero(level < k)
        parent = np.arange(n, dtype=np.int32)
        new = nodes[level[nodes] == k]
        parent[new] = above[_most(x, new, above)[1]]
        ancestors[:, k - 1] = parent[ancestors[:, k] if k < depth else np.arange(n)]
    for k in range(depth):
        others = np.flatnonzero(ancestors[:, k] != np.arange(n))
        above = ancestors[others, k]
        np.maximum.at(radii[:, k], above, distances(np.einsum("ij,ij->i", x[others], x[above])))
    return level, ancestors, radii


def _most(x: np.ndarray, rows: np.ndarray, of: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The largest cosine of each of the rows to others, and the place of that one among them."""
    best, at = np.empty(len(rows)), np.empty(len(rows), np.int64)
    step = max(1, _MATRIX // max(len(of), 1))
    for i in range(0, len(rows), step):
        cosines = x[rows[i : i + step]] @ x[of].T
        at[i : i + step] = cosines.argmax(1)
        best[i : i + step] = cosines.max(1)
    return best, at


class Tree:
    """A block's points and levels, as a task gets them."""

    def __init__(self, rows: pd.DataFrame, kind: str):
        rows = rows.sort_values("place")
        self.digests = rows["digest"].to_numpy()
        self.x = unit_rows(list(rows["vector"]), kind)
        self.copies = rows["copies"].to_numpy().astype(np.float64)
        self.level = rows["level"].to_numpy()
        self.ancestors = np.frombuffer(b"".join(rows["ancestors"]), np.int32).reshape(len(rows), -1)
        self.radii = np.frombuffer(b"".join(rows["radii"]), np.float64).reshape(len(rows), -1)
        self.depth = self.ancestors.shape[1]
        self.counts, self.whole = np.zeros(len(rows)), np.zeros((len(rows), self.depth))
        self.weights = [np.bincount(self.ancestors[:, k], self.copies, len(rows)) for k in range(self.depth)]
        self._below: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def children(self, k: int, nodes: np.ndarray) -> np.ndarray:
        """The nodes of level k+1 below nodes of level k."""
        if k not in self._below:
            lower = np.flatnonzero(self.level <= k + 1)
            order = np.argsort(self.ancestors[lower, k], kind="stable")
            ends = np.cumsum(np.bincount(self.ancestors[lower, k], minlength=len(self.x)))
            self._below[k] = lower[order], ends
        lower, ends = self._below[k]
        starts = np.where(nodes > 0, ends[nodes - 1], 0)
        sizes = ends[nodes] - starts
        at = np.repeat(starts - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())
        return lower[at]

    def totals(self) -> np.ndarray:
        """Copies that each point is linked to, by itself and by nodes that were linked as a whole."""
        return self.counts + sum(self.whole[self.ancestors[:, k], k] for k in range(self.depth))


def _unite(labels: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Give linked points one label, the least."""
    while len(a):
        x, y = labels[a], labels[b]
        differ = x != y
        if not differ.any():
            return
        a, b, x, y = a[differ], b[differ], x[differ], y[differ]
        least = np.minimum(x, y)
        np.minimum.at(labels, x, least)
        np.minimum.at(labels, y, least)
        while True:
            up = labels[labels]
            if (up == labels).all():
                break
            labels[:] = up


def _near(
    one: Tree, other: Tree, level: int, rows: np.ndarray, columns: np.ndarray, t: float
) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Pairs of nodes that a bound does not rule out, and their cosines: nodes with about the same radius have one bound."""
    leaves = level == one.depth
    radius_a = np.zeros(len(rows)) if leaves else one.radii[rows, level]
    radius_b = np.zeros(len(columns)) if leaves else other.radii[columns, level]
    for low, high in ((-1, 0), (0, 0.25), (0.25, 3)):
        chosen = columns[(radius_b > low) & (radius_b <= high)]
        if not len(chosen):
            continue
        furthest = t + radius_a + radius_b[(radius_b > low) & (radius_b <= high)].max() + MARGIN
        least = np.where(furthest < 2, 1 - furthest * furthest / 2, -2)
        step = max(1, _MATRIX // len(chosen))
        for i in range(0, len(rows), step):
            some = rows[i : i + step]
            cosines = one.x[some] @ other.x[chosen].T
            r, c = np.nonzero(cosines >= least[i : i + step, None])
            yield some[r], chosen[c], cosines[r, c]


def traverse(one: Tree, other: Tree, threshold: float) -> np.ndarray:
    """Counts the links between two trees, or within one given twice; returns labels of one's and the other's points."""
    t, offset = reach(threshold), len(one.x)
    labels = np.arange(offset + len(other.x))
    a, b = np.zeros(1, np.int64), np.zeros(1, np.int64)
    for k in range(-1, one.depth):
        found_a, found_b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        order = np.argsort(a, kind="stable")
        a, b = a[order], b[order]
        firsts = np.flatnonzero(np.diff(a, prepend=-1))
        for at, end in zip(firsts, [*firsts[1:], len(a)]):
            rows, columns = (a[at : at + 1], b[at:end]) if k < 0 else (one.children(k, a[at : at + 1]), other.children(k, b[at:end]))
            for r, c, cosines in _near(one, other, k + 1, rows, columns, t):
                if k + 1 == one.depth:
                    linked = cosines >= threshold
                    r, c = r[linked], c[linked]
                    np.add.at(one.counts, r, other.copies[c])
                    np.add.at(other.counts, c, one.copies[r])
                    _unite(labels, r, offset + c)
                    continue
                gap, radii = distances(cosines), one.radii[r, k + 1] + other.radii[c, k + 1]
                whole = gap + radii <= t - MARGIN
                np.add.at(one.whole[:, k + 1], r[whole], other.weights[k + 1][c[whole]])
                np.add.at(other.whole[:, k + 1], c[whole], one.weights[k + 1][r[whole]])
                _unite(labels, r[whole], offset + c[whole])
                further = (gap - radii <= t + MARGIN) & ~whole
                found_a.append(r[further])
                found_b.append(c[further])
        a, b = np.concatenate(found_a), np.concatenate(found_b)
    for tree, first in ((one, 0), (other, offset)):
        for k in range(tree.depth):
            under = np.flatnonzero(tree.whole[tree.ancestors[:, k], k] > 0)
            _unite(labels, first + under, first + tree.ancestors[under, k])
    return labels


_POINT = "digest binary, copies bigint, vector binary"


def _grown(kind: str):
    """A block's points with their places in its cover tree."""

    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("digest").reset_index(drop=True)
        level, ancestors, radii = cover_levels(unit_rows(list(rows["vector"]), kind))
        return rows.assign(
            place=np.arange(len(rows), dtype=np.int32), level=level,
            ancestors=[x.tobytes() for x in ancestors], radii=[x.tobytes() for x in radii],
        )[["block", "digest", "copies", "vector", "place", "level", "ancestors", "radii"]]

    return run


def _linked(threshold: float, kind: str):
    """The links between two blocks: for each point with any, the copies it is linked to and a root."""

    def run(key: tuple, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        one = Tree(left, kind)
        same = not len(right)
        other = Tree(left, kind) if same else Tree(right, kind)
        labels = traverse(one, other, threshold)
        if same:  # each point stands on both sides
            n = len(one.x)
            _unite(labels, np.arange(n), n + np.arange(n))
            digests, totals, labels = one.digests, one.totals(), labels[:n]
        else:
            digests, totals = np.concatenate([one.digests, other.digests]), np.concatenate([one.totals(), other.totals()])
        some = totals > 0
        return pd.DataFrame({"digest": digests[some], "root": digests[labels[some]], "n": totals[some].astype(np.int64)})

    return run


def find_links(
    vectors: DataFrame,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    threshold: float = THRESHOLD,
    block: int = BLOCK,
    sample: int = SAMPLE,
    cells: int = CELLS,
    columns: list[str] | None = None,
) -> DataFrame:
    """The columns of ``vectors`` (or those named) with n_links, component_id and kept.

    Two vectors of one length are linked if their cosine, in double precision, is ``threshold`` (over 0) or more.
    ``n_links`` is the number of other rows that a row is linked to, ``component_id`` the least id that it
    reaches over links, ``kept`` whether that is its own. Vectors that are null, empty, zero, or hold null or
    non-finite numbers link with nothing, nor do rows without an id (component null, kept). Rows that
    repeat are vectors each, so they link; rows of one id are all kept if it is the least. Ids are
    whole numbers. Added columns replace those of their name; others pass through. An empty table stays empty.
    """
    if not 0 < threshold <= 1:
        raise ValueError("the threshold is a cosine over 0")
    spark = vectors.sparkSession
    single = isinstance(vectors.schema[vector_column].dataType.elementType, T.FloatType)
    kind, cast = ("<f4", "array<float>") if single else ("<f8", "array<double>")
    kept = vectors.select(*[vectors[f"`{c}`"] for c in columns]) if columns else vectors
    rows = vectors.select(packed(kept), F.col(id_column).cast("bigint").alias("id"), F.col(vector_column).cast(cast).alias("vector"))
    takes = F.col("id").isNotNull() & _takes_part(F.col("vector"))
    taken = rows.where(takes)

    def keyed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in in_slices(batches):
            data = _bytes(part.column(1), kind)
            columns = [part.column(0), pa.array(map(_digest, data), pa.binary()), pa.array(data, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["id", "digest", "vector"])

    found = taken.select("id", "vector").mapInArrow(keyed, "id bigint, digest binary, vector binary")
    points = found.groupBy("digest").agg(
        F.min("id").alias("least_id"), F.count(F.lit(1)).alias("copies"), F.any_value("vector").alias("vector")
    )
    points = written(points, "cover-points")
    lengths = points.groupBy(F.length("vector").alias("size")).agg(F.count(F.lit(1)).alias("n")).orderBy("size").collect()
    uppers, first = {}, {}
    for r in lengths:  # one row per length of vectors
        drawn = points.where(F.length("vector") == r["size"]).orderBy(F.xxhash64("digest")).limit(sample).select("vector").toArrow()
        uppers[r["size"]] = Upper(unit_rows(drawn["vector"].to_pylist(), kind), r["n"], threshold, block, cells)
        first[r["size"]] = sum(len(u.balls) + len(u.cells) for s, u in uppers.items() if s < r["size"])
    shared = spark.sparkContext.broadcast((uppers, first))  # bounded by sample, balls and cells

    def placed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, firsts = shared.value
        for part in in_slices(batches, 1024):
            data = part.column(2).to_pylist()
            sizes = np.array([len(x) for x in data])
            node, gap = np.zeros(len(data), np.int64), np.zeros(len(data))
            border: list[list[int]] = [[] for _ in data]
            for size in np.unique(sizes):
                at = np.flatnonzero(sizes == size)
                nodes, gaps, marks = known[size].place(unit_rows([data[i] for i in at], kind))
                node[at], gap[at] = nodes + firsts[size], gaps
                for i, ball in zip(*np.nonzero(marks)):
                    border[at[i]].append(int(ball) + firsts[size])
            columns = [*part.columns, pa.array(node), pa.array(gap), pa.array(border, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, names=["digest", "copies", "vector", "node", "gap", "border"])

    homes = points.select("digest", "copies", "vector").mapInArrow(placed, f"{_POINT}, node bigint, gap double, border array<bigint>")
    homes = written(homes, "cover-homes")
    held = homes.groupBy("node").agg(
        F.count(F.lit(1)).alias("n"), F.max("gap").alias("radius"), F.sum("copies").alias("copies"), F.min("digest").alias("least")
    )
    nodes = {r["node"]: r for r in held.collect()}  # balls and cells at most
    borders = homes.select(F.explode("border").alias("ball")).groupBy("ball").agg(F.count(F.lit(1)).alias("n")).collect()
    borders = {r["ball"]: r["n"] for r in borders}
    # Names of blocks: a node's own points are 2 * node, the points at a ball's border 2 * ball + 1.
    parts: dict[int, int] = {2 * ball + 1: n for ball, n in borders.items()}
    meetings: list[tuple[int, int]] = [(2 * ball, 2 * ball + 1) for ball in borders if ball in nodes]
    balls: list[dict] = []
    for size, upper in uppers.items():
        here = np.arange(len(upper.balls) + len(upper.cells)) + first[size]
        balls += [
            {"of": int(i), "whole": nodes[i]["copies"], "least": nodes[i]["least"]} for i in here[: len(upper.balls)] if i in nodes
        ]
        full = [int(i) for i in here[len(upper.balls) :] if i in nodes]
        parts.update({2 * int(i): nodes[i]["n"] for i in here if i in nodes})
        if full:
            centres = upper.cells[np.array(full) - first[size] - len(upper.balls)]
            radii = np.array([nodes[i]["radius"] for i in full])
            near = distances(centres @ centres.T) - radii[:, None] - radii[None, :] <= upper.reach + MARGIN
            meetings += [(2 * full[i], 2 * full[j]) for i, j in zip(*np.nonzero(np.triu(near)))]
    parts = {name: -(-n // block) for name, n in parts.items()}
    ball_rows = T.StructType.fromDDL("of bigint, whole bigint, least string")
    ball_rows = small_frame(spark, [{**b, "least": bytes(b["least"]).hex()} for b in balls], ball_rows)
    members = homes.join(F.broadcast(ball_rows), F.col("node") == F.col("of"))  # a row per ball
    inside = members.select("digest", F.unhex("least").alias("root"), F.col("whole").alias("n"))

    numbers = small_frame(
        spark, [{"name": k, "parts": n} for k, n in parts.items()], T.StructType.fromDDL("name bigint, parts bigint")
    )
    meet = small_frame(spark, [{"low": a, "high": b} for a, b in meetings], T.StructType.fromDDL("low bigint, high bigint"))
    used = meet.select(F.col("low").alias("name")).unionByName(meet.select(F.col("high").alias("name"))).distinct()
    numbers = F.broadcast(numbers.join(used, "name", "left_semi"))  # a row per ball, border and cell
    own = homes.select("digest", "copies", "vector", (2 * F.col("node")).alias("name"))
    near = homes.select("digest", "copies", "vector", F.explode(F.transform("border", lambda b: 2 * b + 1)).alias("name"))
    part = F.pmod(F.xxhash64(F.lit(1), "digest"), F.col("parts"))
    named = own.unionByName(near).join(numbers, "name").withColumn("block", F.struct("name", part.alias("part")))
    blocks = (
        named.select("block", "digest", "copies", "vector")
        .groupBy("block")
        .applyInPandas(
            _grown(kind), f"block struct<name: bigint, part: bigint>, {_POINT}, place int, level int, ancestors binary, radii binary"
        )
    )
    blocks = written(blocks, "cover-blocks")
    low = meet.join(numbers.select(F.col("name").alias("low"), F.col("parts").alias("low_parts")), "low")
    both = low.join(numbers.select(F.col("name").alias("high"), F.col("parts").alias("high_parts")), "high")
    both = both.withColumn("p", F.explode(F.sequence(F.lit(0), F.col("low_parts") - 1)))
    both = both.withColumn("q", F.explode(F.sequence(F.lit(0), F.col("high_parts") - 1)))
    both = both.where((F.col("low") != F.col("high")) | (F.col("p") <= F.col("q")))
    both = both.select(
        F.struct(F.col("low").alias("name"), F.col("p").alias("part")).alias("one"),
        F.struct(F.col("high").alias("name"), F.col("q").alias("part")).alias("other"),
    )
    left = both.join(blocks, F.col("one") == F.col("block")).drop("block")
    right = both.where(F.col("one") != F.col("other")).join(blocks, F.col("other") == F.col("block")).drop("block")
    right = right.toDF(*right.columns)  # names of its own, as both sides come from the same tables
    pairs = left.groupBy("one", "other").cogroup(right.groupBy("one", "other"))
    between = pairs.applyInPandas(_linked(threshold, kind), "digest binary, root binary, n bigint")
    links = written(inside.unionByName(between), "cover-links")

    counts = links.groupBy("digest").agg(F.sum("n").alias("n"))
    roots = _roots(links.select(F.col("digest").alias("a"), F.col("root").alias("b")))
    known = points.select("digest", "least_id").join(counts, "digest").join(roots, "digest", "left")
    known = written(known.withColumn("root", F.coalesce("root", "digest")), "cover-known")
    least = known.groupBy(F.col("root").alias("of")).agg(F.min("least_id").alias("component"))
    known = known.join(least, F.col("root") == F.col("of")).select(F.col("digest").alias("key"), "n", "component")

    def rekeyed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in in_slices(batches):
            digests = pa.array(map(_digest, _bytes(part.column(2), kind)), pa.binary())
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), digests], names=[ROW, "id", "digest"])

    # The digests of all rows are worked out again, which costs less than writing them.
    schema = T.StructType([*rows.schema.fields[:2], T.StructField("digest", T.BinaryType())])
    linked = taken.mapInArrow(rekeyed, schema).join(known, F.col("digest") == F.col("key"))
    linked = linked.select(ROW, "id", (F.col("n") - 1).alias("n"), "component")
    alone = rows.where(~takes).select(ROW, "id", F.lit(0).cast("bigint").alias("n"), F.col("id").alias("component"))
    own = F.col("id").eqNullSafe(F.col("component"))
    return unpacked(linked.unionByName(alone), kept, n_links=F.col("n"), component_id=F.col("component"), kept=own)


def op11_cover_tree_links(spark, sf_dir):
    """Links, component and keeper of every vector."""
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding")
    return find_links(vectors, columns=["vec_id"])


OP11_SQL = r"""
WITH RECURSIVE v AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(CAST(embedding AS DOUBLE[]), lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(CAST(embedding AS DOUBLE[]), lambda x: x <> 0)) > 0
), links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= 0.9
), reached(vec_id, other) AS (
  SELECT vec_id, vec_id FROM embeddings UNION SELECT r.vec_id, l.b FROM reached r JOIN links l ON l.a = r.other
), least AS (SELECT vec_id, min(other) AS component_id FROM reached GROUP BY vec_id)
SELECT e.vec_id, (SELECT count(*) FROM links WHERE a = e.vec_id) AS n_links, component_id, e.vec_id = component_id AS kept
FROM embeddings e JOIN least USING (vec_id)
"""

import math

import numpy as np
import pandas as pd
import pytest

from dayferry.llm import cover_tree
from dayferry.llm.cover_tree import RADII, Tree, Upper, cover_levels, distances, find_links, traverse

from .helpers import empty


def unit(x):
    return x / np.linalg.norm(x, axis=1)[:, None]


def groups(rng, sizes, dims, noise):
    """Points around some directions; with noise up to their share of the threshold's angle they link, in part."""
    return unit(np.concatenate([unit(rng.normal(size=(1, dims))) + s * rng.normal(size=(n, dims)) / math.sqrt(dims) for n, s in zip(sizes, noise)]))


def as_tree(x):
    level, ancestors, radii = cover_levels(x)
    n = len(x)
    return Tree(pd.DataFrame({
        "digest": [i.to_bytes(4, "big") for i in range(n)], "copies": 1 + np.arange(n) % 3, "vector": [r.tobytes() for r in x],
        "place": np.arange(n), "level": level, "ancestors": [a.tobytes() for a in ancestors], "radii": [r.tobytes() for r in radii],
    }), "<f8")


def shapes():
    rng = np.random.default_rng(4)
    yield unit(rng.normal(size=(300, 16)))
    yield groups(rng, [150, 100, 1, 60], 8, [0.02, 0.3, 0, 0.6])
    yield groups(rng, [400], 24, [0.45])
    yield unit(rng.normal(size=(200, 2)))
    yield np.repeat(unit(rng.normal(size=(3, 5))), 40, 0)
    yield np.array([[1.0], [-1.0]])


@pytest.mark.parametrize("x", list(shapes()))
def test_levels_nest_cover_and_separate(x):
    level, ancestors, radii = cover_levels(x)
    gaps = distances(x @ x.T)
    for k in range(len(RADII) + 1):
        nodes = np.flatnonzero(level <= k)
        assert set(ancestors[:, k]) <= set(nodes) and (ancestors[nodes, k] == nodes).all()
        if k:
            assert gaps[:, nodes].min(1).max() <= RADII[k - 1] + 1e-6  # each point is near a node
            apart = gaps[np.ix_(nodes, nodes)] + 9 * np.eye(len(nodes))
            assert apart.min() >= RADII[k - 1] - 1e-6
        for a in nodes:
            assert abs(radii[a, k] - gaps[a, ancestors[:, k] == a].max()) < 1e-7
    for k in range(1, len(RADII) + 1):  # ancestors lie on one way up
        assert (ancestors[ancestors[:, k], k - 1] == ancestors[:, k - 1]).all()


@pytest.mark.parametrize("threshold", [0.5, 0.9, 0.99])
@pytest.mark.parametrize("x", list(shapes()))
def test_traversal_matches_brute_force(x, threshold):
    cut = max(len(x) // 3, 1)
    for a, b in ((x, x), (x[:cut], x[cut:])):
        one, other = as_tree(a), as_tree(b)
        linked = a @ b.T >= threshold
        labels = traverse(one, other, threshold)
        assert one.totals().tolist() == (linked @ other.copies).tolist()
        assert other.totals().tolist() == (one.copies @ linked).tolist()
        adjacent = np.zeros((len(a) + len(b),) * 2, bool)
        adjacent[: len(a), len(a) :] = linked
        assert labels.tolist() == components(adjacent | adjacent.T).tolist()


def components(adjacent):
    labels = np.arange(len(adjacent))
    while True:
        least = np.minimum(labels, np.where(adjacent, labels[None, :], len(labels)).min(1))
        if (least == labels).all():
            return labels
        labels = least


def test_close_groups_are_linked_without_their_pairs(monkeypatch):
    rng = np.random.default_rng(1)
    tree = as_tree(groups(rng, [2000], 16, [0.05]))
    looked = []
    near = cover_tree._near
    monkeypatch.setattr(cover_tree, "_near", lambda *a: (looked.append(len(f[0])) or f for f in near(*a)))
    traverse(tree, as_tree(tree.x), 0.9)
    assert tree.totals().min() == tree.copies.sum() and sum(looked) < 100


def test_balls_hold_half_the_threshold_and_borders_reach_all_links():
    rng = np.random.default_rng(2)
    x = groups(rng, [400, 300, 200], 12, [0.1, 0.25, 0.7])
    upper = Upper(x[::3], len(x) * 10, 0.9, 100, 8)
    assert 0 < len(upper.balls) and len(upper.cells) == 8
    node, gap, border = upper.place(x)
    linked = x @ x.T >= 0.9
    for ball in range(len(upper.balls)):
        inside = node == ball
        assert linked[np.ix_(inside, inside)].all() and (gap[inside] <= upper.radius).all()
        others = linked[inside].any(0) & ~inside & (node > ball)
        assert border[others, ball].all()


def by_hand(rows, threshold):
    ok = [
        i is not None and v is not None and len(v) > 0 and all(x is not None and math.isfinite(x) for x in v) and any(x != 0 for x in v)
        for i, v in rows
    ]
    unit_of = [np.array(v) / np.abs(v).max() / np.linalg.norm(np.array(v) / np.abs(v).max()) if o else None for (_, v), o in zip(rows, ok)]
    n = len(rows)
    adjacent = np.zeros((n, n), bool)
    for a in range(n):
        for b in range(n):
            if a != b and ok[a] and ok[b] and len(unit_of[a]) == len(unit_of[b]):
                adjacent[a, b] = unit_of[a] @ unit_of[b] >= threshold
    labels = components(adjacent)
    out = []
    for a, (i, _) in enumerate(rows):
        least = min((rows[b][0] for b in np.flatnonzero(labels == labels[a])), default=None) if ok[a] else i
        out.append((i, int(adjacent[a].sum()), least, i == least))
    return sorted(map(str, out))


def odd_vectors(single):
    rng = np.random.default_rng(7)
    x = groups(rng, [40, 60, 30, 25], 8, [0.05, 0.35, 0.5, 2.0])
    x = x.astype(np.float32).astype(float) if single else x * rng.uniform(0.1, 9, (len(x), 1))
    rows = [(int(i), v.tolist()) for i, v in zip(rng.permutation(len(x)) * 7 + 1, x)]
    rows += [(2000 + i, rows[5][1]) for i in range(30)]  # equal ones
    rows += [rows[3], rows[3], (rows[3][0], rows[90][1]), (-4, rows[100][1])]
    rows += [(3000, None), (3001, []), (3002, [0.0] * 8), (3003, [float("nan")] + [1.0] * 7), (3004, [1.0, None]), (3005, [float("inf")] * 8)]
    rows += [(None, rows[0][1]), (3006, [1.0, 2.0]), (3007, [2.0, 4.0]), (3008, [-1.0, -2.0]), (3009, [3.0]), (3010, [-0.0, 1.0]), (3011, [0.0, 1.0])]
    big = 1e30 if single else 1e300
    return rows + [(3012, [big, big, 0.0]), (3013, [1 / big, 1 / big, 0.0]), (3014, [1.0, 0.0, 0.0])]


@pytest.mark.parametrize("single", [True, False])
@pytest.mark.parametrize("settings", [{}, {"block": 16, "sample": 64, "cells": 5}, {"block": 9, "sample": 200, "threshold": 0.97}])
def test_matches_brute_force(spark, monkeypatch, single, settings):
    monkeypatch.setattr(cover_tree, "LEAST_BALL", 8)
    rows = odd_vectors(single)
    kind = "array<float>" if single else "array<double>"
    docs = spark.createDataFrame([r + (1, "x") for r in rows], f"vec_id bigint, embedding {kind}, N_links int, digest string")
    made = find_links(docs, **settings)
    assert made.columns == ["vec_id", "embedding", "digest", "n_links", "component_id", "kept"]
    found = sorted(str((r["vec_id"], r["n_links"], r["component_id"], r["kept"])) for r in made.collect())
    assert found == by_hand(rows, settings.get("threshold", 0.9))


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, None), (2, [0.0])], "vec_id bigint, embedding array<float>")
    assert find_links(empty(docs)).count() == 0
    assert sorted(map(tuple, find_links(docs, columns=["vec_id"]).collect())) == [(1, 0, 1, True), (2, 0, 2, True)]

import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from dayferry.llm import jaccard
from dayferry.llm.jaccard import find_classes, one_of_each_class, runs_needed, shared_counts
from tests.llm.helpers import empty, odd_docs, words


def brute(rows, similarity=0.8):
    """class and links of every (id, text) by comparing all shingle sets."""
    sets, ids = {}, defaultdict(list)
    for i, x in rows:
        x = x or ""
        w = x.encode().split()
        if w:
            sets[x] = frozenset(tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4)))
            ids[x].append(i)
    by = defaultdict(list)
    for x, s in sets.items():
        for g in s:
            by[g].append(x)
    shared = Counter()
    for found in by.values():
        for a in range(len(found)):
            for b in range(a):
                shared[found[b], found[a]] += 1
    root = {x: x for x in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    links = Counter()
    for (a, b), n in shared.items():
        if n >= similarity * (len(sets[a]) + len(sets[b]) - n) - 1e-9:
            links[a] += 1
            links[b] += 1
            root[find(a)] = find(b)
    least = defaultdict(list)
    for x in sets:
        least[find(x)] += [i for i in ids[x] if i is not None]
    return [
        (i, min(least[find(x or "")], default=None), links[x or ""], len(ids[x or ""])) if (x or "").split() and x.encode().split()
        else (i, i, 0, 1)
        for i, x in rows
    ]


def near(rng, base, changes):
    out = list(base)
    for _ in range(changes):
        out[rng.randrange(len(out))] = rng.choice("xyz") + str(rng.random())
    return out


def corpus(rng, groups=40, lone=150):
    passage = words(rng, 60)
    texts = []
    for _ in range(groups):
        base = words(rng, rng.randint(5, 300))
        texts += [" ".join(near(rng, base, rng.randint(0, max(1, len(base) // 60)))) for _ in range(rng.randint(2, 6))]
    texts += [" ".join(words(rng, rng.randint(1, 200)) + passage * (k % 2)) for k in range(lone)]
    texts += texts[:30]
    return texts


@pytest.mark.parametrize("bucket, block", [(256, 768), (2, 768), (2, 3)])
def test_classes_and_links_against_brute_force(spark, monkeypatch, bucket, block):
    monkeypatch.setattr(jaccard, "BUCKET", bucket)
    monkeypatch.setattr(jaccard, "BLOCK", block)
    texts = corpus(random.Random(8))
    rows = list(enumerate(texts))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = sorted((r["doc_id"], r["class_id"], r["n_links"], r["n_copies"]) for r in find_classes(docs).collect())
    assert found == sorted(brute(rows))


def test_a_large_group_of_near_copies(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "BLOCK", 64)
    rng = random.Random(4)
    base = words(rng, 150)
    rows = [(i, " ".join(near(rng, base, 1 + i % 2))) for i in range(500)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = find_classes(docs).collect()
    expected = {r[0]: r for r in brute(rows)}
    assert {r["class_id"] for r in found} == {0}
    # Many of these pairs are just similar enough, and their bucket is split as far as buckets are.
    counts = [(r["n_links"], expected[r["doc_id"]][2]) for r in found]
    assert all(n <= all_ for n, all_ in counts)
    assert sum(n for n, _ in counts) >= 0.9999 * sum(n for _, n in counts)


def test_odd_rows(spark):
    docs = odd_docs(spark)
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    found = find_classes(docs).collect()
    key = lambda t: tuple((x is None, x or 0) for x in t)
    assert sorted(((r["doc_id"], r["class_id"], r["n_links"], r["n_copies"]) for r in found), key=key) == sorted(brute(rows), key=key)
    assert {"size", "score", "__row", "hash", "digest"} <= set(found[0].asDict())
    kept = one_of_each_class(docs)
    assert kept.columns == docs.columns
    wordy = [r for r in kept.collect() if (r["text"] or "").encode().split()]
    assert len(wordy) == len({c for i, c, *_ in brute(rows) if any(t and t.encode().split() for j, t in rows if j == i)})
    assert find_classes(empty(docs)).count() == 0 and one_of_each_class(empty(docs)).count() == 0


def test_one_of_each_class_stays(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    expected = {c for _, c, *_ in brute(rows)}
    assert sorted(r["doc_id"] for r in one_of_each_class(docs).collect()) == sorted(expected)


def test_shared_counts():
    rng = np.random.default_rng(0)
    sets = [np.unique(rng.integers(0, 60, rng.integers(0, 50)).astype(np.uint64)) for _ in range(70)]
    expected = [[len(np.intersect1d(a, b)) for b in sets] for a in sets]
    assert shared_counts(sets).tolist() == expected


def test_runs():
    assert runs_needed(0.8, 0.9995, 3) == 11 and runs_needed(0.8, 0.99999, 3) == 17 and runs_needed(0.5, 0.9, 1) == 4


def test_classes_that_still_change_are_no_result(spark, monkeypatch):
    path = spark.createDataFrame([(bytes([i]), bytes([i + 1])) for i in range(30)], "a binary, b binary")
    assert {bytes(r["root"]) for r in jaccard._roots(path).collect()} == {bytes([0])}
    monkeypatch.setattr(jaccard, "MAX_ROUNDS", 1)
    with pytest.raises(RuntimeError):
        jaccard._roots(path)

import math
import random
import re
from collections import Counter, defaultdict

import pytest
import xxhash
from pyspark.sql import functions as F

from dayferry.llm import mixing
from dayferry.llm.mixing import mix
from dayferry.llm.quality import PRIOR, _buckets, _word_hashes, bucket_weights, judge, op2_llr_quality, trusted_ids
from dayferry.llm.text import word_array
from tests.llm.helpers import empty, odd_docs, text

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def base_counts(x):
    x = x or ""
    words = WORD.findall(x)
    lines, seen, dup = x.split("\n"), set(), 0
    for line in lines:
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    places = defaultdict(list)
    for i in range(len(words) - 2):
        places[tuple(words[i : i + 3])].append(i)
    repeated = {p + k for found in places.values() if len(found) > 1 for p in found for k in range(3)}
    n = len(words)
    failed = n < 50 or 100 * len(repeated) > 50 * n
    return n, sum(map(len, words)), sum(c in "#*$%&|<>" for c in x), dup, len(repeated), failed


def h64(data: bytes, seed: int = 42) -> int:
    n = xxhash.xxh64_intdigest(data, seed=seed)
    return n - (1 << 64) if n >> 63 else n


def grams(x, buckets):
    """The buckets of a text by Spark's xxhash64: each value is hashed with the hash before as its seed."""
    hashes = [h64(w.encode()) for w in WORD.findall(x or "")]
    for h in hashes:
        yield h % buckets
    for a, b in zip(hashes, [*hashes[1:], None]):
        s = xxhash.xxh64_intdigest((a % (1 << 64)).to_bytes(8, "little"), seed=42)
        s = xxhash.xxh64_intdigest((2).to_bytes(4, "little"), seed=s)
        if b is not None:
            s = xxhash.xxh64_intdigest((b % (1 << 64)).to_bytes(8, "little"), seed=s)
        yield (s - (1 << 64) if s >> 63 else s) % buckets


def test_quality_against_brute_force(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    labels = {r["doc_id"] for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect() if r["quality"] == 1}
    buckets, prior = 32_768, 65_536.0
    raw, good = Counter(), Counter()
    found = {}
    for d in docs:
        found[d["doc_id"]] = list(grams(d["text"], buckets))
        raw.update(found[d["doc_id"]])
        if d["doc_id"] in labels:
            good.update(found[d["doc_id"]])
    n_raw, n_good = sum(raw.values()), sum(good.values())

    def weight(b):
        p = (raw[b] + 0.5) / (n_raw + 0.5 * buckets)
        return round(math.log((good[b] + prior * p) / (n_good + prior) / p), 4)

    weights = [weight(b) for b in range(buckets)]
    rows = {r["doc_id"]: r for r in op2_llr_quality(spark, sf_dir).collect()}
    assert len(rows) == len(docs)
    for d in docs:
        r = rows[d["doc_id"]]
        expected = base_counts(d["text"])
        names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
        assert tuple(r[c] for c in names) == expected
        score = sum(weights[b] for b in found[d["doc_id"]]) / max(1, len(found[d["doc_id"]]))
        assert abs(r["quality_score"] - score) < 2e-6
        if abs(score + 0.05) > 1e-5:
            assert r["kept"] == (not expected[-1] and score >= -0.05)


@pytest.mark.parametrize("x", ["a b c a b c", "a " * 300, "x y\nx y\n\nx y \n", "a b a b a b a", " ".join(map(str, range(400))) * 2,
                               " ".join(f"{i} {i + 1} {i + 2}" for i in range(60)) * 2, "é\x0bé\x1cx # <|>", "a b"])
def test_base_counts_of_odd_texts(spark, x):
    docs = spark.createDataFrame([(1, x)], "doc_id bigint, text string")
    r = judge(docs, docs.select("doc_id")).first()
    assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == base_counts(x)


def test_quality_of_odd_rows(spark):
    docs = odd_docs(spark)
    none = docs.select("doc_id").limit(0)
    rows = judge(docs, none).collect()
    assert len(rows) == docs.count()
    assert {"text", "size", "__row", "hash", "kept"} <= set(rows[0].asDict())
    for r in rows:
        assert r["quality_score"] == 0 and r["kept"] == (not r["base_failed"])
        assert r["n_words"] == base_counts(r["text"])[0]
    assert judge(empty(docs), none).count() == 0
    assert judge(docs, docs.select("doc_id")).where("kept").count() <= len(rows)


def test_trusted_texts_count_whole_however_many(spark):
    rng = random.Random(8)
    docs = [(i if i % 7 else None, text(rng, rng.randint(0, 60))) for i in range(120)] + [(5, "ba be"), (5, "ba be"), (6, None)]
    docs = spark.createDataFrame(docs, "doc_id bigint, text string")
    ids = [None, 5, 5, 6, *range(30, 90, 2), 999]
    trusted = spark.createDataFrame([(i,) for i in ids], "doc_id bigint")
    hashed = docs.select("doc_id", _buckets(_word_hashes(word_array(F.col("text"))), 64).alias("grams")).collect()
    raw, good = Counter(), Counter()
    for r in hashed:
        raw.update(r["grams"] or [])
        good.update((r["grams"] or []) if r["doc_id"] in set(ids) - {None} else [])
    all_raw, all_good = sum(raw.values()), sum(good.values())
    p = [(raw[b] + 0.5) / (all_raw + 32) for b in range(64)]
    expected = [round(math.log((good[b] + PRIOR * p[b]) / (all_good + PRIOR) / p[b]), 4) for b in range(64)]
    for broadcast_ids in (0, 1000):  # by a shuffle and by a broadcast
        assert bucket_weights(docs, trusted, "doc_id", "text", 64, broadcast_ids) == expected


def test_good_and_bad_documents_part(spark, sf_dir):
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    rows = op2_llr_quality(spark, sf_dir).join(labels, "doc_id").where("not base_failed")
    kept = {r["quality"]: r["share"] for r in rows.groupBy("quality").agg(F.avg(F.col("kept").cast("int")).alias("share")).collect()}
    assert kept[1] > 0.99 and kept[0] < 0.05
    assert trusted_ids(labels).count() == labels.where("quality = 1").count()


def targets_of(sizes, weights=(5, 2, 1), share=1.5, cap=2.0):
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    out, left, open_ = {}, share * sum(sizes.values()), set(names)
    while open_:
        total = sum(w[s] for s in open_)
        over = {s for s in open_ if left * w[s] / total > cap * sizes[s]}
        if not over:
            out |= {s: left * w[s] / total for s in open_}
            break
        for s in over:
            out[s] = cap * sizes[s]
        left -= sum(out[s] for s in over)
        open_ -= over
    return out


def _check_mix(rows, slack):
    sizes, taken, largest = Counter(), Counter(), Counter()
    for r in rows:
        sizes[r["source"]] += r["size"]
        taken[r["source"]] += r["copies"] * r["size"]
        largest[r["source"]] = max(largest[r["source"]], r["size"])
        assert 0 <= r["copies"] <= 2
    expected = targets_of(sizes)
    for r in rows:
        assert r["source_size"] == sizes[r["source"]]
        assert r["target"] == pytest.approx(expected[r["source"]], rel=1e-9)
    for s in sizes:
        assert abs(taken[s] - expected[s]) <= slack * largest[s] + 1


def test_mixture_meets_its_targets(spark, sf_dir, monkeypatch):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "source")
    rows = mix(docs).collect()
    assert len(rows) == docs.count()
    _check_mix(rows, 2)
    again = {r["doc_id"]: r["copies"] for r in mix(docs.repartition(5)).collect()}
    assert again == {r["doc_id"]: r["copies"] for r in rows}


def test_crowded_sizes_are_split(spark, monkeypatch):
    monkeypatch.setattr(mixing, "BUCKET_ROWS", 50)
    docs = spark.range(3000).selectExpr("id AS doc_id", "repeat('w ', 5 + cast(id % 2 AS int)) AS text", "if(id % 4 = 0, 'b', 'a') AS source")
    _check_mix(mix(docs).collect(), 2)


def test_mixture_of_odd_rows(spark):
    rows = mix(odd_docs(spark)).collect()
    assert len(rows) == odd_docs(spark).count()
    assert {"score", "__row", "hash", "copies"} <= set(rows[0].asDict())
    sizes = Counter()
    for r in rows:
        assert r["size"] == len(WORD.findall(r["text"] or ""))
        sizes[r["source"]] += r["size"]
    for r in rows:
        assert r["target"] == pytest.approx(targets_of(sizes)[r["source"]], rel=1e-9)
    assert mix(empty(odd_docs(spark))).count() == 0
    nothing = spark.createDataFrame([(1, None, "a"), (2, " ", None)], "doc_id bigint, text string, source string")
    assert [r["copies"] for r in mix(nothing).collect()] == [1, 1]


def test_targets_at_random(spark):
    rng = random.Random(2)
    for _ in range(3):
        rows = [(i, text(rng, rng.randint(0, 30)), rng.choice(["a", "é", "B", "z", None])) for i in range(120)]
        rows += [(1000 + i, text(rng, 40), "solo") for i in range(rng.randint(1, 200))]
        _check_mix(mix(spark.createDataFrame(rows, "doc_id bigint, text string, source string")).collect(), 2)


def test_targets_that_are_not_met_are_no_result(spark, sf_dir, monkeypatch):
    monkeypatch.setattr(mixing, "MAX_STEPS", 1)
    with pytest.raises(RuntimeError):
        mix(spark.read.parquet(f"{sf_dir}/documents.parquet"))

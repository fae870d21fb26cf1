import hashlib
import math
import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from dayferry.llm.resampling import bucket_gains, count_buckets, distinct_lines, resample

from .helpers import empty, odd_docs, text

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def features(t, longest, buckets):
    words = WORD.findall((t or "").translate(LOWER))
    runs = [" ".join(words[i : i + n]) for n in range(1, longest + 1) for i in range(len(words) - n + 1)]
    return len(words), [zlib.crc32(r.encode()) % buckets for r in runs]


def by_hand(docs, targets, longest, buckets, least, percent, seed=2024):
    s, t = (Counter(b for x in texts for b in features(x, longest, buckets)[1]) for texts in ([d[1] for d in docs], targets))
    all_s, all_t = sum(s.values()), sum(t.values())
    gain = {b: math.floor(1000 * math.log((t[b] + 1.0) * (all_s + buckets) / ((s[b] + 1.0) * (all_t + buckets)))) for b in range(buckets)}
    rows = []
    for i, x in docs:
        n_words, found = features(x, longest, buckets)
        weight = sum(gain[b] for b in found) // len(found) if found else 0
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append([i, len(found), weight, score, None, n_words >= least])
    rows.sort(key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[2], r[1]))
    can = [r for r in rows if r[5]]
    for place, r in enumerate(can[: percent * len(can) // 100]):
        r[4] = place + 1
    return sorted(str(tuple(r[:5])) for r in rows)


def lined(rng, n):
    common = [text(rng, rng.randint(1, 6)) for _ in range(5)]
    return "\n".join(rng.choice(common) if rng.random() < 0.5 else text(rng, rng.randint(0, 9)) for _ in range(n))


def odd_lines(spark):
    rng = random.Random(8)
    rows = [(i, lined(rng, rng.randint(1, 12))) for i in range(60)]
    rows += [(100, None), (101, ""), (102, "\n\n \n"), (None, lined(rng, 9)), (None, None), (103, lined(rng, 900)), rows[3], rows[3], (3, "same id")]
    rows += [(104, "A\x00b Éa É　x\r\ny's 4\x7f5 \x85 ñ\n\nA b"), (105, "same line\n" * 300), (-5, "same line\n" * 300)]
    return spark.createDataFrame([r + (1, "x", "y") for r in rows], "doc_id bigint, text string, RANK int, bucket string, row string")


@pytest.mark.parametrize("longest", [1, 2, 3])
@pytest.mark.parametrize("make", [odd_lines, odd_docs])
def test_matches_brute_force(spark, make, longest):
    docs = make(spark)
    targets = spark.createDataFrame([("Ba be\nbi bo ba",), (None,), ("",), ("ba be bi",), ("ba be bi",)], "text string")
    made = resample(docs, targets, longest=longest, buckets=97, least_words=5, percent=40)
    found = sorted(str(tuple(r)) for r in made.select("doc_id", "n_features", "weight", "score", "rank").collect())
    pairs = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    assert found == by_hand(pairs, [r[0] for r in targets.collect()], longest, 97, 5, 40)


def test_other_columns_stay_and_added_ones_replace(spark):
    docs = odd_lines(spark)
    made = resample(docs, docs)
    assert made.columns == ["doc_id", "text", "bucket", "row", "n_features", "weight", "score", "rank"]
    assert sorted(map(str, made.select("doc_id", "text").collect())) == sorted(map(str, docs.select("doc_id", "text").collect()))
    assert resample(docs, docs, columns=["doc_id"]).columns == ["doc_id", "n_features", "weight", "score", "rank"]


def test_empty_tables(spark):
    docs, none = odd_lines(spark), empty(odd_lines(spark))
    assert resample(none, docs).count() == 0
    made = resample(docs, none, buckets=50, least_words=1)
    assert made.count() == docs.count() and made.where("rank is not null").count() > 0
    assert resample(docs, docs, least_words=10**6).where("rank is not null").count() == 0


def test_draw_of_all_and_none(spark):
    docs = odd_lines(spark)
    able = resample(docs, docs, least_words=1, percent=100)
    ranks = sorted(r["rank"] for r in able.collect() if r["rank"])
    assert ranks == list(range(1, len(ranks) + 1)) and len(ranks) == able.where("n_features > 0").count()
    assert resample(docs, docs, percent=0).where("rank is not null").count() == 0


def test_lines_are_counted_once_times_their_occurrences(spark):
    docs = spark.createDataFrame([("a b\nc\na b",), ("a b",), ("c\n\n",), (None,)], "text string")
    assert sorted(map(tuple, distinct_lines(docs, "text").collect())) == [("a b", 3), ("c", 2)]
    whole, buckets = count_buckets(docs, longest=2, buckets=1000), 1000
    runs = Counter(zlib.crc32(r) % buckets for r in [b"a"] * 3 + [b"b"] * 3 + [b"c"] * 2 + [b"a b"] * 3 + [b"b c", b"c a"])
    assert {b: n for b, n in enumerate(whole.tolist()) if n} == dict(runs)


def test_gains_favour_the_target():
    import numpy as np

    gains = bucket_gains(np.array([100, 100, 0]), np.array([0, 90, 50]))
    assert gains[0] < 0 < gains[1] < gains[2]


def test_resampling_moves_documents_to_the_target(spark):
    rng = random.Random(3)
    like, unlike = ["aa bb cc dd ee"] * 3, ["vv ww xx yy zz"] * 3
    rows = [(i, " ".join(rng.choice((like if i % 2 else unlike)[0].split()) for _ in range(30))) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    made = resample(docs, spark.createDataFrame([("aa bb cc dd ee " * 50,)], "text string"))
    drawn = [r["doc_id"] for r in made.where(F.col("rank").isNotNull()).collect()]
    assert len(drawn) == 40 and sum(i % 2 for i in drawn) >= 30

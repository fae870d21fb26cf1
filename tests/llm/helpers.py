"""Small tables with every odd case: null ids, texts and sources, repeated rows, empty and long texts, clashing names."""

import random

SYLLABLES = "ba be bi bo da de di do ka ke ki ko la le li lo ma me mi mo na ne ni no ra re ri ro sa se si so".split()


def words(rng, n):
    return ["".join(rng.choice(SYLLABLES) for _ in range(rng.randint(1, 4))) for _ in range(n)]


def text(rng, n):
    return " ".join(words(rng, n))


def odd_docs(spark, rng=None, n=40):
    rng = rng or random.Random(5)
    rows = [(i, text(rng, rng.randint(1, 120)), f"s{i % 3}") for i in range(n)]
    rows += [(100, None, "s0"), (101, "", None), (102, " \t\n", "s1"), (None, text(rng, 60), "s1"), (None, None, None)]
    rows += [(103, text(rng, 4000), "s2"), rows[0], rows[0], (104, "Ünï \x00 code 　 x\x1cy İ!", "s9"), (105, "one", "s9")]
    # Extra columns take names that the operators use or add.
    extra = ("x", "y", "z", 1.5, "w")
    names = "doc_id bigint, text string, source string, size string, score string, __row string, hash double, digest string"
    return spark.createDataFrame([r + extra for r in rows], names)


def empty(docs):
    return docs.limit(0)

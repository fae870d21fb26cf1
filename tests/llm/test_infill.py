import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from dayferry.llm.infill import MARKS, Marks, restore, transform

from .helpers import empty, odd_docs

UNIT = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def by_hand(doc_id, text, percent=50, spm=80, seed=42, marks=MARKS):
    text = text or ""
    units = UNIT.findall(text)
    n = len(units)
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    if not text or any(m in text for m in (marks.prefix, marks.suffix, marks.middle)) or h[2] % 100 >= percent:
        return n, "plain", text, None, None
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h[3] % 100 < spm:
        return n, "spm", marks.suffix + s + marks.prefix + p + marks.middle + m, len(p), len(m)
    return n, "psm", marks.prefix + p + marks.suffix + s + marks.middle + m, len(p), len(m)


def odd(spark):
    texts = ["", None, " ", "\n\t ", " a", "a ", "a  b\n", "<P> a b", "x <S", "<S <P <M b> c", "a < S > <", "😀 é\r\nñ \x85　x", "$1 \\2 ${x} \\E",
             "\x00 a \x01", "<M>"]
    rows = [(i, t) for i, t in enumerate(texts * 12)]
    rows += [(None, "a b c d e"), (None, None), rows[4], rows[4], (7, "other text of the same id")]
    return spark.createDataFrame([r + ("n", "f", 1) for r in rows], "doc_id bigint, text string, output string, form string, N int")


@pytest.mark.parametrize("settings", [{}, {"percent": 100, "spm": 50, "seed": 7}, {"percent": 100, "spm": 0, "marks": Marks("$1", "\\E(", "[+")}])
def test_matches_by_hand_and_restores(spark, settings):
    named = {("spm_percent" if k == "spm" else k): v for k, v in settings.items()}
    for docs in (odd(spark), odd_docs(spark)):
        made = transform(docs, **named)
        marks = settings.get("marks", MARKS)
        made = made.withColumn("back", restore(F.col("output"), F.col("form"), marks))
        rows = made.collect()
        assert sorted(map(str, ((r["doc_id"], r["text"]) for r in rows))) == sorted(map(str, map(tuple, docs.select("doc_id", "text").collect())))
        for r in rows:
            assert tuple(r[c] for c in ("n", "form", "output", "prefix_chars", "middle_chars")) == by_hand(r["doc_id"], r["text"], **settings)
            assert r["back"] == (r["text"] or "")


def test_added_columns_replace_and_others_stay(spark):
    docs = odd_docs(spark)
    made = transform(docs)
    assert set(docs.columns) < set(made.columns)
    docs = odd(spark)
    assert [c.lower() for c in transform(docs).columns] == ["doc_id", "text", "n", "form", "output", "prefix_chars", "middle_chars"]


def test_empty_table(spark):
    made = transform(empty(odd_docs(spark)))
    assert made.count() == 0 and "output" in made.columns


def test_long_texts_need_no_deep_stack(spark):
    rng = random.Random(1)
    text = " ".join(rng.choice(["a", "bb", "ccc\n", "é"]) for _ in range(300_000)) + " " * 5000
    docs = spark.createDataFrame([(i, text) for i in range(4)], "doc_id bigint, text string")
    for r in transform(docs, percent=100).collect():
        assert tuple(r[c] for c in ("n", "form", "output", "prefix_chars", "middle_chars")) == by_hand(r["doc_id"], text, percent=100)


def test_one_pass_of_built_in_functions(spark):
    plan = transform(odd_docs(spark))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan and "Arrow" not in plan

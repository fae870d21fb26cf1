from collections import Counter

import pytest

import __spark_entry__ as contract
import corpus_pipeline
from dayferry.frames import written
from tests.llm.helpers import empty, odd_docs

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    """What goes into and comes out of each stage."""
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        made = written(stage(spark, docs, SF), "test-stage")
        out[name] = docs, made
        docs = made
    return out


def test_stages_in_order_and_columns_kept(stages):
    assert list(stages) == ["quality", "toxicity", "near_duplicates", "mixture", "packing"]
    for name, (docs, made) in list(stages.items())[:-1]:
        assert made.dtypes == docs.dtypes
        ids = {r[0] for r in docs.select("doc_id").collect()}
        assert {r[0] for r in made.select("doc_id").collect()} <= ids


def test_decisions_take_effect(spark, stages):
    from dayferry.llm.jaccard import find_classes
    from dayferry.llm.mixing import mix
    from dayferry.llm.quality import judge, trusted_ids

    labels = spark.read.parquet(f"{SF}/labels.parquet")
    docs, made = stages["quality"]
    kept = sorted(r["doc_id"] for r in judge(docs, trusted_ids(labels)).collect() if r["kept"])
    assert sorted(r["doc_id"] for r in made.collect()) == kept and 0 < len(kept) < docs.count()
    docs, made = stages["near_duplicates"]
    assert made.count() == find_classes(docs).select("class_id").distinct().count()
    docs, made = stages["mixture"]
    copies = {r["doc_id"]: r["copies"] for r in mix(docs).collect()}
    taken = [r["doc_id"] for r in made.collect()]
    assert sorted(taken) == sorted(i for i, n in copies.items() for _ in range(n))
    docs, made = stages["packing"]
    tokens = {(r["doc_id"], r["start"]): r["length"] for r in made.collect()}
    assert {i for i, _ in tokens} == set(taken)
    assert made.count() == sum(1 for _ in made.collect())


def test_registered(spark):
    names = contract.queries()
    assert "pipeline" in names and sum(n.startswith("op") for n in names) == 13
    assert corpus_pipeline.run(spark, SF).columns == ["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "ids"]


def _counted(rows):
    return Counter(tuple(r) for r in rows.collect())


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES[:-1])
def test_odd_rows_clashing_names_and_empty_tables(spark, name, stage):
    docs = written(odd_docs(spark), "test-odd")
    made = stage(spark, docs, SF)
    assert made.dtypes == docs.dtypes
    rows, found = _counted(docs), _counted(made)
    assert found and found.keys() <= rows.keys()
    wordless = {r for r in rows if not (r[1] or "").split()}
    if name == "quality":
        assert not wordless & found.keys() and all(found[r] == rows[r] for r in found)  # rows that repeat fare alike
    if name == "toxicity":
        assert wordless <= found.keys() and all(found[r] == rows[r] for r in found)
    if name == "near_duplicates":
        assert wordless <= found.keys() and max(found.values()) == 1 and len(found) == len(rows)  # no two texts are alike
    if name == "mixture":
        assert all(found[r] == rows[r] for r in wordless) and all(n <= 2 * rows[r] for r, n in found.items())
    nothing = stage(spark, empty(docs), SF)
    assert nothing.dtypes == docs.dtypes and nothing.count() == 0


def test_packing_odd_rows_and_empty_tables(spark):
    docs = written(odd_docs(spark), "test-odd")
    pieces = corpus_pipeline.packing(spark, docs, SF).collect()
    assert {r["doc_id"] for r in pieces} == {r["doc_id"] for r in docs.select("doc_id").collect()}
    assert all(r["doc_tokens"] == r["length"] == 1 for r in pieces if r["doc_id"] in (100, 101))  # the end id alone
    assert sum(r["start"] == 0 for r in pieces) == docs.count()  # rows that repeat are packed each
    assert corpus_pipeline.packing(spark, empty(docs), SF).count() == 0

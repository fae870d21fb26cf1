import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from dayferry.llm.packing import pack
from dayferry.llm.tokens import Encoder
from tests.llm.helpers import empty, odd_docs, text

BYTES, WORDS = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "word_bpe_49k.json"))
ENCODERS = {(p, s): Encoder(p, 500, s) for p in (BYTES, WORDS) for s in (False, True)}
PARTS = ["a", "Foo", "bar.", " ", "  ", "\n", "\t", "é", "ß", "Σ", "ς", "İ", "'s", "don't", "1", "!?", "...", "́",
         "中文", "😀", "\0", "<|endoftext|>", "<|startoftext|>", "<|EndOfText|>", ".,", "\x0b", "\x1c", "　", "_", "x" * 70, "Wört", "word.\nNext", "\r\n", " \n", "\n\n", "\x85", "\u2028", "***", "$%", "1|>", "a'.", "-_", "\"("]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.sampled_from(PARTS), max_size=12).map("".join), min_size=1, max_size=40))
@pytest.mark.parametrize("path", [BYTES, WORDS])
def test_cut_and_remembered_pieces_give_the_tokenizers_ids(path, texts):
    column = pa.array([t.encode() for t in texts], pa.binary())
    for special_as_text in (False, True):
        plain = Tokenizer.from_file(path)
        plain.encode_special_tokens = special_as_text  # False is the library's own way
        found = ENCODERS[path, special_as_text](column)
        assert [x.tolist() for x in found] == [plain.encode(t, add_special_tokens=False).ids for t in texts]


def test_null_and_broken_bytes():
    found = ENCODERS[BYTES, False](pa.array([None, b"", b"\xff a"], pa.binary()))
    assert [len(x) for x in found[:2]] == [0, 0] and len(found[2]) > 0


def _check(docs, pieces, length, end=1):
    encode = Encoder(BYTES)
    rows = pieces.collect()
    by_doc, by_sequence = {}, {}
    for r in rows:
        assert r["length"] * 4 == len(r["ids"]) > 0
        by_doc.setdefault(r["doc_id"], []).append(r)
        by_sequence.setdefault(r["sequence_id"], []).append(r)
    for found in by_sequence.values():
        found.sort(key=lambda r: r["offset"])
        assert [r["offset"] for r in found] == np.cumsum([0] + [r["length"] for r in found])[:-1].tolist()
        assert sum(r["length"] for r in found) <= length
    expected = {}
    for r in docs.select("doc_id", "text").collect():
        ids = encode.tokenizer.encode(r["text"] or "", add_special_tokens=False).ids + [end]
        expected.setdefault(r["doc_id"], []).append(np.array(ids, "<u4").tobytes())
    assert by_doc.keys() == expected.keys()
    for key, texts in expected.items():
        # Rows of one id are told apart by nothing but their pieces: all ids together must agree.
        pieces = sorted((r["start"], r["doc_tokens"], r["ids"]) for r in by_doc[key])
        if len(texts) == 1:
            assert b"".join(p[2] for p in pieces) == texts[0]
            assert {p[1] for p in pieces} == {len(texts[0]) // 4}
        assert sum(len(p[2]) for p in pieces) == sum(map(len, texts))
    return by_sequence


def test_every_id_once_gapless_and_little_padding(spark):
    docs = odd_docs(spark)
    for length, tasks in ((64, 1), (256, 5)):
        found = _check(docs, pack(docs.repartition(tasks), BYTES, length=length, open_windows=4, merged_tasks=3), length)
        totals = [sum(r["length"] for r in rows) for rows in found.values()]
        padding = sum(0 if t & (t - 1) == 0 else length - t for t in totals)
        assert padding < 0.2 * sum(totals)


def test_large_corpus_padding(spark):
    rng = random.Random(1)
    docs = spark.createDataFrame([(i, text(rng, rng.randint(1, 900))) for i in range(600)], "doc_id bigint, text string")
    rows = pack(docs.repartition(4), BYTES).groupBy("sequence_id").sum("length").collect()
    totals = [r[1] for r in rows]
    assert sum(0 if t & (t - 1) == 0 else 2048 - t for t in totals) < 0.03 * sum(totals)


def test_empty(spark):
    assert pack(empty(odd_docs(spark)), BYTES).count() == 0

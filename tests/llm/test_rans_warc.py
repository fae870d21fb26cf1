import hashlib
import zlib

import numpy as np
import public_tokenizers
import pytest
import zstandard
from hypothesis import given, settings
from hypothesis import strategies as st

from dayferry.frames import shared_dir
from dayferry.llm import rans, warc
from tests.llm.helpers import empty, odd_docs

WORDS = public_tokenizers.path("word_bpe_49k.json")


@settings(max_examples=40, deadline=None)
@given(st.lists(st.lists(st.integers(0, 300), max_size=200), max_size=8), st.sampled_from([1, 3, 64]))
def test_file_round_trip(docs, lanes):
    ids = [np.array(d, "<u4").tobytes() for d in docs]
    counts = np.bincount(np.concatenate([np.array(d, np.int64) for d in docs] or [[]]).astype(np.int64), minlength=301)
    table = rans.Table(counts, bits=12)
    data = rans.write_file(list(range(len(docs))), ids, table, lanes) + b"\n"
    assert list(rans.File(data, table).documents()) == list(enumerate(ids))


def test_spans_decode_alone_and_damage_is_found(monkeypatch):
    monkeypatch.setattr(rans, "BLOCK", 5000)
    monkeypatch.setattr(rans, "CHECKPOINT_STEPS", 10)
    ids = np.random.default_rng(1).geometric(0.05, 12_345).astype("<u4")
    table = rans.Table(np.bincount(ids))
    data = rans.write_file([7], [ids.tobytes()], table, lanes=32) + b"\n"
    file = rans.File(data, table)
    spans = file.spans()
    assert len(spans) > 30
    found = {s: file.span(*s) for s in reversed(spans)}
    assert np.concatenate([found[s] for s in spans]).tolist() == ids.tolist()
    broken = bytearray(data)
    broken[-50] ^= 1
    with pytest.raises(ValueError, match="checksum"):
        list(rans.File(bytes(broken), table).documents())
    with pytest.raises(ValueError, match="table"):
        rans.File(data, rans.Table(np.bincount(ids[:100])))
    assert len(data) < 0.45 * ids.nbytes


def test_table_sums_to_its_size():
    for counts in ([0, 1, 10**9, 1, 5], [1] * 4096, [3], list(range(3000))):
        table = rans.Table(np.array(counts), bits=12)
        assert table.freq.sum() == 4096 and ((table.freq > 0) == (np.array(counts) > 0)).all()


def test_documents_come_back_in_order(spark, monkeypatch):
    monkeypatch.setattr(rans, "FILE_TOKENS", 2000)
    docs = odd_docs(spark).repartition(3)
    path, counts = rans.code_tokens(docs, WORDS)
    rows = rans.read_tokens(spark, path, counts).collect()
    assert len({r["file"] for r in rows}) > 2
    from tokenizers import Tokenizer

    encode = Tokenizer.from_file(WORDS)
    expected = sorted(
        (r["doc_id"], np.array(encode.encode(r["text"] or "", add_special_tokens=False).ids + [1], "<u4").tobytes())
        for r in docs.collect()
        if r["doc_id"] is not None
    )
    assert sorted((r["doc_id"], r["ids"]) for r in rows) == expected
    files = {}
    for r in rows:
        files.setdefault(r["file"], []).append(r)
    for found in files.values():
        assert [r["first"] for r in found] == np.cumsum([0] + [r["n_tokens"] for r in found])[:-1].tolist()
        assert [r["doc_id"] for r in found] == sorted(r["doc_id"] for r in found)


def test_query_against_the_tokenizer(spark, sf_dir):
    rows = {r["doc_id"]: r for r in rans.op7_rans_tokens(spark, sf_dir).collect()}
    from tokenizers import Tokenizer

    encode, start = Tokenizer.from_file(WORDS), 0
    for r in spark.read.parquet(f"{sf_dir}/documents.parquet").orderBy("doc_id").collect():
        ids = np.array(encode.encode(r["text"] or "", add_special_tokens=False).ids + [1], "<u4").tobytes()
        found = rows.pop(r["doc_id"])
        assert (found["start"], found["n_tokens"], found["ids_crc32"]) == (start, len(ids) // 4, zlib.crc32(ids))
        start += len(ids) // 4
    assert not rows


def test_empty_tokens(spark):
    path, counts = rans.code_tokens(empty(odd_docs(spark)), WORDS)
    assert rans.read_tokens(spark, path, counts).count() == 0


PAGES = [
    (1, "http://a", "x" * 1000), (2, "http://b", "x" * 1000), (9, None, "x" * 1000), (9, "http://c", "x" * 1000),
    (3, "http://d", "y" * 999), (4, "http://e\r\nX: 1", "y" * 999), (5, None, None), (None, "u", "x" * 1000),
    (6, "http://f", "é" * 500), (7, "http://g", "é" * 500), (8, "h", "WARC/1.1\r\n\r\n" + "z" * 300_000),
]


def test_archives(spark, monkeypatch):
    monkeypatch.setattr(warc, "BUNDLE_BYTES", 200)
    pages = spark.createDataFrame([(*p, "k") for p in PAGES], "page_id bigint, url string, html string, key string")
    path = shared_dir(spark, "warc")
    warc.write_archives(pages.repartition(2), path)
    rows = warc.read_archives(spark, path).collect()
    assert len(rows) == len(PAGES)
    by = {}
    for r in rows:
        by.setdefault(r["key"], []).append(r)
    kinds = {k: sorted((r["record_type"], r["refers_to"]) for r in v) for k, v in by.items()}
    assert kinds["1"] == kinds["2"] == kinds[None] == [("revisit", "9")]
    assert kinds["9"] == [("response", None)] * 2 and kinds["3"] == kinds["4"] == kinds["5"] == [("response", None)]
    assert kinds["6"] == [("revisit", "7")] and kinds["7"] == [("response", None)]
    html = {str(k): (h or "").encode() for k, _, h in PAGES if k}
    for r in rows:
        if r["payload"] is not None:
            assert bytes(r["payload"]) == html[r["key"]]
        if r["key"]:
            assert r["payload_bytes"] == len(html[r["key"]])
            assert r["payload_digest"] == hashlib.sha1(html[r["key"]]).hexdigest()
    files = spark.read.format("binaryFile").load(path + "/*.txt").collect()
    assert len(files) > 1
    for f in files:
        data = bytes(f["content"])
        reader = warc.Reader(data)
        plain = b"".join(reader.frame(k) for k in range(len(reader.places)))
        assert zstandard.ZstdDecompressor().stream_reader(data, read_across_frames=True).read() == plain
        for key, k, at, size in reader.index:
            assert reader.frame(k)[at : at + size].startswith(b"WARC/1.1\r\n")
        broken = bytearray(data)
        broken[20] ^= 255
        with pytest.raises((ValueError, zstandard.ZstdError)):
            [warc.Reader(bytes(broken)).frame(k) for k in range(len(reader.places))]
    places = {(r["file"], r["frame"], r["offset"]) for r in rows}
    assert {(r["file"], r["frame"], r["offset"]) for r in warc.read_index(spark, path).collect()} == places


def test_empty_archives(spark):
    path = shared_dir(spark, "warc")
    warc.write_archives(spark.createDataFrame([], "page_id bigint, url string, html string"), path)
    assert warc.read_archives(spark, path).count() == 0

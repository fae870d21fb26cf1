"""Token ids in files, coded by a static range asymmetric numeral system.

One frequency table, counted over all documents, serves all files. A file holds documents in ascending
order of their ids. Its token ids are cut into blocks; a block is coded alone, by many interleaved
coders whose states move in step, so numpy does the arithmetic. At every checkpoint of a block the
states and the place in the words are noted, with a checksum of the ids up to the next one; so every
span between checkpoints can be decoded by itself.

A file: 8 bytes of magic, the length of the header (unsigned 32 bits, little endian like everything),
the header as JSON, the ids of its documents (signed 64 bits), their token counts (unsigned 64 bits),
the blocks, and a line feed. The header has the checksum of the table and for each block its place, the
number of its symbols, its words, and the checksums of its spans. A block: the states at every
checkpoint (unsigned 64 bits), then the words (unsigned 32 bits).
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from dayferry.frames import shared_dir, written
from dayferry.llm.tokens import encoder, in_slices

MAGIC = b"DFRANS1\n"
SCALE_BITS = 20
LANES = 4096
BLOCK = 1 << 20
CHECKPOINT_STEPS = 128
FILE_TOKENS = 4 << 20
END_ID = 1
_LOW = np.uint64(1 << 31)
_WORD = np.uint64(32)


class Table:
    """Frequencies that add up to 2**bits; every counted symbol has at least one."""

    def __init__(self, counts: np.ndarray, bits: int = SCALE_BITS):
        counts = np.asarray(counts, np.int64)
        total = int(counts.sum())
        size = 1 << bits
        seen = counts > 0
        if seen.sum() > size:
            raise ValueError("more symbols than the table has room for")
        freq = np.where(seen, np.maximum(1, counts * size // max(total, 1)), 0)
        over = int(freq.sum()) - size
        if total and over < 0:
            freq[np.argmax(freq)] -= over
        while over > 0:  # take from the most frequent ones, which lose least by it
            for s in np.argsort(-freq, kind="stable"):
                if over and freq[s] > 1:
                    take = min(over, max(1, int(freq[s]) // 16))
                    freq[s] -= take
                    over -= take
        self.bits = bits
        self.freq = freq.astype(np.uint64)
        self.start = np.concatenate([[0], np.cumsum(freq)[:-1]]).astype(np.uint64) if len(freq) else self.freq
        self.crc = zlib.crc32(freq.astype("<u4").tobytes())

    def symbols(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.freq), dtype=np.uint32), self.freq.astype(np.int64))


def encode_block(ids: np.ndarray, table: Table, lanes: int = LANES, every: int = CHECKPOINT_STEPS):
    """States at the checkpoints, words read before each, and the words."""
    bits = np.uint64(table.bits)
    freq, start = table.freq[ids], table.start[ids]
    if not freq.all():
        raise ValueError("a symbol that the table does not have")
    limit = freq << np.uint64(63 - table.bits)
    steps = -(-len(ids) // lanes)
    state = np.full(lanes, _LOW, np.uint64)
    words: list[np.ndarray] = []
    count, states, done = 0, [], []
    for t in reversed(range(steps)):
        at = slice(t * lanes, min(len(ids), (t + 1) * lanes))
        f, x = freq[at], state[: at.stop - at.start]
        full = x >= limit[at]
        out = x[full].astype(np.uint32)
        if len(out):
            words.append(out)
            count += len(out)
            x[full] >>= _WORD
        q, r = np.divmod(x, f)
        state[: len(x)] = (q << bits) + r + start[at]
        if t % every == 0:
            states.append(state.copy())
            done.append(count)
    before = [count - d for d in reversed(done)]
    return np.array(states[::-1], "<u8"), before, np.concatenate([*words[::-1], np.zeros(0, np.uint32)]).astype("<u4")


def decode_span(state: np.ndarray, words: np.ndarray, n: int, table: Table, symbols: np.ndarray, lanes: int) -> np.ndarray:
    """``n`` symbols from the states and the words that follow a checkpoint."""
    bits, mask = np.uint64(table.bits), np.uint64((1 << table.bits) - 1)
    state, out, pos = state.astype(np.uint64), np.empty(n, np.uint32), 0
    for at in range(0, n, lanes):
        x = state[: min(lanes, n - at)]
        slot = x & mask
        s = symbols[slot]
        out[at : at + len(x)] = s
        x = table.freq[s] * (x >> bits) + slot - table.start[s]
        low = x < _LOW
        k = int(np.count_nonzero(low))
        if k:
            x[low] = (x[low] << _WORD) | words[pos : pos + k]
            pos += k
        state[: len(x)] = x
    return out


def write_file(keys: list[int], ids: list[bytes], table: Table, lanes: int = LANES) -> bytes:
    """One file but for its last byte, the line feed."""
    symbols = np.frombuffer(b"".join(ids), "<u4")
    blocks, heads, at = [], [], 0
    for first in range(0, len(symbols), BLOCK):
        part = symbols[first : first + BLOCK]
        states, before, words = encode_block(part, table, lanes, CHECKPOINT_STEPS)
        data, span = states.tobytes() + words.tobytes(), lanes * CHECKPOINT_STEPS
        crcs = [zlib.crc32(part[i : i + span].tobytes()) for i in range(0, len(part), span)]
        heads.append({"at": at, "symbols": len(part), "words": len(words), "before": before, "crc32": crcs})
        blocks.append(data)
        at += len(data)
    head = {"docs": len(keys), "table": table.crc, "bits": table.bits, "lanes": lanes, "steps": CHECKPOINT_STEPS, "blocks": heads}
    text = json.dumps(head).encode()
    lengths = np.array([len(x) // 4 for x in ids], "<u8")
    return b"".join([
        MAGIC, len(text).to_bytes(4, "little"), text, np.array(keys, "<i8").tobytes(), lengths.tobytes(), *blocks,
    ])


class File:
    """Reads a file; ``span`` decodes one span between checkpoints and checks it."""

    def __init__(self, data: bytes, table: Table):
        if data[:8] != MAGIC or data[-1:] != b"\n":
            raise ValueError("no such file, or a part of one")
        size = int.from_bytes(data[8:12], "little")
        self.head = json.loads(data[12 : 12 + size])
        if self.head["table"] != table.crc or self.head["bits"] != table.bits:
            raise ValueError("coded by another table")
        n, at = self.head["docs"], 12 + size
        self.keys = np.frombuffer(data, "<i8", n, at)
        self.lengths = np.frombuffer(data, "<u8", n, at + 8 * n).astype(np.int64)
        self.data, self.first, self.table, self.symbols = data, at + 16 * n, table, table.symbols()

    def spans(self) -> list[tuple[int, int]]:
        return [(b, k) for b, block in enumerate(self.head["blocks"]) for k in range(len(block["crc32"]))]

    def span(self, block: int, k: int) -> np.ndarray:
        head, lanes = self.head["blocks"][block], self.head["lanes"]
        size, at = lanes * self.head["steps"], self.first + head["at"]
        state = np.frombuffer(self.data, "<u8", lanes, at + 8 * lanes * k)
        words = np.frombuffer(self.data, "<u4", head["words"], at + 8 * lanes * len(head["crc32"]))
        n = min(size, head["symbols"] - k * size)
        ids = decode_span(state, words[head["before"][k] :], n, self.table, self.symbols, lanes)
        if zlib.crc32(ids.astype("<u4").tobytes()) != head["crc32"][k]:
            raise ValueError(f"checksum of block {block}, span {k}")
        return ids

    def documents(self) -> Iterator[tuple[int, bytes]]:
        ids = np.concatenate([np.zeros(0, np.uint32), *[self.span(*s) for s in self.spans()]]).astype("<u4").tobytes()
        ends = 4 * np.cumsum(self.lengths)
        for key, end, n in zip(self.keys.tolist(), ends.tolist(), self.lengths.tolist()):
            yield key, ids[end - 4 * n : end]


def token_ids(docs: DataFrame, tokenizer: str, id_column: str, text_column: str, end_id: int = END_ID) -> DataFrame:
    """doc_id, n_tokens and ids (bytes of unsigned 16 bits if the vocabulary allows, else 32)."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer)
        kind = _width(encode.vocabulary)
        end = np.array([end_id], kind).tobytes()
        for part in in_slices(batches):
            found = encode(part.column(1))
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array([len(x) + 1 for x in found], pa.int64()),
                 pa.array([x.astype(kind).tobytes() + end for x in found], pa.binary())],
                names=["doc_id", "n_tokens", "ids"],
            )

    rows = docs.select(F.col(id_column).cast("bigint").alias("doc_id"), F.col(text_column).cast("binary"))
    return rows.mapInArrow(run, "doc_id bigint, n_tokens bigint, ids binary")


def _width(vocabulary: int) -> str:
    return "<u2" if vocabulary <= 1 << 16 else "<u4"


def count_ids(tokens: DataFrame, vocabulary: int) -> np.ndarray:
    """How often each id occurs in all documents: summed in each task, then by id."""
    kind = _width(vocabulary)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(vocabulary, np.int64)
        for part in in_slices(batches, 1024):
            ids = np.frombuffer(b"".join(part.column(0).to_pylist()), kind)
            total += np.bincount(ids, minlength=vocabulary)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen, pa.int64()), pa.array(total[seen], pa.int64())], names=["id", "n"])

    found = tokens.select("ids").mapInArrow(run, "id bigint, n bigint").groupBy("id").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros(vocabulary, np.int64)
    counts[found["id"].to_numpy()] = found["n"].to_numpy()  # at most one number per id of the vocabulary
    return counts


def write_tokens(tokens: DataFrame, counts: np.ndarray, path: str, vocabulary: int) -> None:
    """Write the files of all documents in ascending order of ids, null ids left out by the caller.

    Tasks take ranges of ids; a task cuts its range into files of bounded size, and Spark's committer
    publishes them, so a task that is run again leaves nothing behind.
    """
    kind = _width(vocabulary)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, keys, held, size = Table(counts), [], [], 0

        def file() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([write_file(keys, held, table)], pa.binary())], names=["value"])

        for part in in_slices(batches):
            for key, ids in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                keys.append(key)
                held.append(np.frombuffer(ids, kind).astype("<u4").tobytes())
                size += len(held[-1]) // 4
                if size >= FILE_TOKENS:
                    yield file()
                    keys, held, size = [], [], 0
        if keys:
            yield file()

    total = tokens.agg(F.sum("n_tokens")).first()[0] or 0
    parts = tokens.repartitionByRange(max(1, -(-total // FILE_TOKENS)), "doc_id").sortWithinPartitions("doc_id", "ids")
    coded = parts.select("doc_id", "ids").mapInArrow(run, "value binary")
    # The text writer puts out the bytes of a string as they are, and the line feed; one row makes one file.
    coded.select(F.col("value").cast("string")).write.option("maxRecordsPerFile", 1).text(path)


def read_tokens(spark: SparkSession, path: str, counts: np.ndarray) -> DataFrame:
    """file, place in the file, doc_id, first (ids before it in its file), n_tokens, ids (unsigned 32 bits)."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = Table(counts)
        for part in in_slices(batches, 1):
            name, data = part.column(0)[0].as_py(), part.column(1)[0].as_py()
            docs = list(File(data, table).documents()) if data else []
            first = 0
            for at in range(0, len(docs), 1000):
                keys, ids = zip(*docs[at : at + 1000])
                sizes = np.array([len(x) // 4 for x in ids])
                starts = first + np.cumsum(sizes) - sizes
                first += int(sizes.sum())
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name] * len(keys)), pa.array(keys, pa.int64()), pa.array(starts, pa.int64()),
                     pa.array(sizes, pa.int64()), pa.array(ids, pa.binary())],
                    names=["file", "doc_id", "first", "n_tokens", "ids"],
                )

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.txt").load(path).select("path", "content")
    return files.mapInArrow(run, "file string, doc_id bigint, first bigint, n_tokens bigint, ids binary")


def code_tokens(docs: DataFrame, tokenizer: str, id_column: str = "doc_id", text_column: str = "text") -> tuple[str, np.ndarray]:
    """Write all documents' token ids; returns the folder and the counts that make the table.

    A null text counts as empty and is the end id alone; rows that repeat are written as often as they
    occur; rows without an id have no place in the order and are left out. Other columns take no part.
    An empty table gives a folder without files.
    """
    vocabulary = encoder(tokenizer).vocabulary
    tokens = written(token_ids(docs.where(F.col(id_column).isNotNull()), tokenizer, id_column, text_column), "rans-ids")
    counts = count_ids(tokens, vocabulary)
    path = shared_dir(docs.sparkSession, "rans-files")
    write_tokens(tokens, counts, path, vocabulary)
    return path, counts


def op7_rans_tokens(spark, sf_dir):
    """What the files hold of every document."""
    import public_tokenizers

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    path, counts = code_tokens(docs, public_tokenizers.path("word_bpe_49k.json"))
    found = read_tokens(spark, path, counts).select(
        "file", "doc_id", "first", "n_tokens", F.crc32("ids").alias("ids_crc32")
    )
    found = written(found, "rans-read")
    # One row per file. Files hold ranges of ids; only repeated ids may lie in two, in any order.
    files = found.groupBy("file").agg(F.sum("n_tokens").alias("n"), F.min("doc_id").alias("least"), F.max("doc_id").alias("most"))
    before = F.sum("n").over(Window.orderBy("least", "most", "file").rowsBetween(Window.unboundedPreceding, -1))
    files = files.select(F.col("file").alias("of"), F.coalesce(before, F.lit(0)).alias("before"))
    return found.join(files, found["file"] == files["of"]).select(
        "doc_id", (F.col("before") + F.col("first")).alias("start"), "n_tokens", "ids_crc32"
    )

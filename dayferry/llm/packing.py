"""Packing documents into sequences with a bounded number of open windows.

Each task cuts its documents into full windows and a rest. The rest goes into the open window that
it fills best; if it fits into none, the fullest is emitted and a new one opened. So a task holds a
fixed number of windows, whatever it reads. What is still open at its end is written apart, and the
open windows of a fixed number of tasks are merged at last.
"""

from __future__ import annotations

import bisect
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dayferry.frames import written
from dayferry.llm.tokens import REMEMBERED, encoder, in_slices

LENGTH = 2048
OPEN_WINDOWS = 128
MERGED_TASKS = 32
END_ID = 1
_FLUSH_BYTES = 4 << 20

Piece = tuple  # (id, start, ids as bytes, tokens of the document)


class Windows:
    """Open windows in order of their free space."""

    def __init__(self, length: int, most: int):
        self.length, self.most = length, most
        self.free: list[int] = []
        self.pieces: list[list[Piece]] = []

    def place(self, piece: Piece) -> list[Piece] | None:
        """Put the piece, shorter than a window, where it leaves least. Returns a window to emit, if any."""
        n = len(piece[2]) // 4
        at = bisect.bisect_left(self.free, n)
        out = None
        if at < len(self.free):
            left, window = self.free.pop(at) - n, self.pieces.pop(at)
        else:
            if len(self.free) == self.most:
                self.free.pop(0)
                out = self.pieces.pop(0)
            left, window = self.length - n, []
        window.append(piece)
        if left == 0:
            return window
        self._open(left, window)
        return out

    def _open(self, left: int, window: list[Piece]) -> None:
        at = bisect.bisect_left(self.free, left)
        self.free.insert(at, left)
        self.pieces.insert(at, window)


def _schema(docs: DataFrame, id_column: str) -> T.StructType:
    long = T.LongType()
    return T.StructType([
        T.StructField(id_column, docs.schema[id_column].dataType),
        *[T.StructField(n, long) for n in ("start", "length", "doc_tokens", "sequence_id", "offset")],
        T.StructField("ids", T.BinaryType()),
        T.StructField("__group", long),
    ])


def _rows(window: list[Piece], sequence: int, group: int | None) -> list[tuple]:
    rows, offset = [], 0
    for key, start, ids, total in window:
        rows.append((key, start, len(ids) // 4, total, sequence, offset, ids, group))
        offset += len(ids) // 4
    return rows


def _task(
    tokenizer: str, remembered: int, length: int, open_windows: int, merged_tasks: int, end_id: int, id_type: pa.DataType
):
    end = np.array([end_id], "<u4").tobytes()
    schema = pa.schema([
        ("id", id_type), *[(n, pa.int64()) for n in ("start", "length", "doc_tokens", "sequence_id", "offset")],
        ("ids", pa.binary()), ("group", pa.int64()),
    ])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer, remembered)
        task = TaskContext.get().partitionId()
        windows = Windows(length, open_windows)
        sequence, held, rows = task << 32, 0, []

        def batch() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

        for part in in_slices(batches):
            for key, found in zip(part.column(0).to_pylist(), encode(part.column(1))):
                ids = found.astype("<u4", copy=False).tobytes() + end
                total, step = len(ids) // 4, 4 * length
                for at in range(0, len(ids), step):
                    piece = (key, at // 4, ids[at : at + step], total)
                    out = [piece] if len(piece[2]) == step else windows.place(piece)
                    if out:
                        rows += _rows(out, sequence, None)
                        sequence, held = sequence + 1, held + sum(len(p[2]) + 64 for p in out)
                if held > _FLUSH_BYTES:
                    yield batch()
                    held, rows = 0, []
        for window in windows.pieces:
            rows += _rows(window, sequence, task // merged_tasks)
            sequence += 1
        if rows:
            yield batch()

    return run


def _merge(length: int, id_column: str):
    """Packs the open windows of some tasks anew, largest pieces first; each holds a few rows per window.

    A window that stays less than half full at the end is cut where powers of two end, so that it needs no padding.
    """

    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["sequence_id", "offset"])
        pieces = [Piece(x) for x in zip(rows[id_column], rows["start"], rows["ids"], rows["doc_tokens"])]
        pieces.sort(key=lambda p: -len(p[2]))
        windows = Windows(length, len(pieces) + 1)
        done = [w for p in pieces if (w := windows.place(p))]
        for window in windows.pieces:
            done += _at_powers(window, length) if sum(len(p[2]) for p in window) < 2 * length else [window]
        first = (1 << 62) | (int(key[0]) << 32)
        out = [r[:-1] for i, window in enumerate(done) for r in _rows(window, first + i, None)]
        return pd.DataFrame(out, columns=[id_column, "start", "length", "doc_tokens", "sequence_id", "offset", "ids"])

    return run


def _at_powers(window: list[Piece], length: int) -> list[list[Piece]]:
    total = sum(len(p[2]) // 4 for p in window)
    parts, left = [], list(window)
    for bit in reversed(range(length.bit_length())):
        need = (1 << bit) * 4
        if not total & (1 << bit):
            continue
        part = []
        while need:
            key, start, ids, of = left.pop(0)
            part.append((key, start, ids[:need], of))
            if len(ids) > need:
                left.insert(0, (key, start + need // 4, ids[need:], of))
            need -= min(need, len(ids))
        parts.append(part)
    return parts


def pack(
    docs: DataFrame,
    tokenizer: str,
    id_column: str = "doc_id",
    text_column: str = "text",
    length: int = LENGTH,
    open_windows: int = OPEN_WINDOWS,
    merged_tasks: int = MERGED_TASKS,
    end_id: int = END_ID,
    remembered: int = REMEMBERED,
) -> DataFrame:
    """One row per piece: the id, start, length, doc_tokens, sequence_id, offset, and the ids as bytes.

    Every row of ``docs`` is a document, also rows that repeat; a null or empty text is the end id alone;
    a null id stays null. Documents longer than a window are cut into full windows and a rest. Columns
    other than the id and the text take no part, whatever their names. An empty table gives no pieces.
    ``ids`` are little-endian unsigned 32-bit integers; ``remembered`` bounds what a worker holds of the
    tokenizer's work, about 250 bytes each. A sequence that is not full is to be padded
    by its reader.
    """
    schema = _schema(docs, id_column)
    rows = docs.select(docs[f"`{id_column}`"], F.col(text_column).cast("binary"))
    arrow = rows.limit(0).toArrow().schema.field(0).type
    cut = written(
        rows.mapInArrow(_task(tokenizer, remembered, length, open_windows, merged_tasks, end_id, arrow), schema), "packing-windows"
    )
    closed = cut.where(F.col("__group").isNull()).drop("__group")
    merged = cut.where(F.col("__group").isNotNull()).groupBy("__group").applyInPandas(_merge(length, id_column), closed.schema)
    return closed.unionByName(merged)


def op1_window_packing(spark, sf_dir):
    """Where every piece of every document lies."""
    import public_tokenizers

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    pieces = pack(docs, public_tokenizers.path("byte_bpe_50k.json"))
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )

"""WARC archives as seekable Zstandard bundles.

Records are grouped into frames that are compressed alone. After the frames a bundle has a skippable
frame with its index, from record identifiers to a frame, an offset in the frame's content and a
length, and last the seek table of the seekable Zstandard format. So a reader needs the table, the
index and one frame to get at a record, and any Zstandard tool can unpack the whole.

Of records with equal payloads the one with the largest id keeps the payload; the others revisit it.
"""

from __future__ import annotations

import json
import struct
from collections.abc import Iterable, Iterator

import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dayferry.frames import shared_dir
from dayferry.llm.tokens import in_slices

LEAST_REVISIT = 1000  # bytes of payload from which equal ones are stored once
FRAME_BYTES = 256 << 10
BUNDLE_BYTES = 16 << 20
LEVEL = 3
DATE = "2024-01-01T00:00:00Z"
# Numbers of the Zstandard formats, and texts of the WARC format.
SKIPPABLE_INDEX = 0x184D2A5D
SKIPPABLE_TABLE = 0x184D2A5E
SEEKABLE_MAGIC = b"\xb1\xea\x92\x8f"
CHECKSUM_FLAG = 0x80
VERSION = b"WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_END = b"\r\n\r\n"


def _line(text: str | None) -> str:
    """A value that can't end its header line."""
    return "".join(c if c.isprintable() else f"%{ord(c):02X}" for c in text or "").strip()


def make_record(key: str, url: str | None, payload: bytes | None, size: int, digest: str, refers_to: str | None) -> bytes:
    """One record; without a payload a revisit. Its HTTP head has the size of the payload either way."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    revisit = refers_to is not None
    block = http if revisit else http + payload
    head = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", f"<urn:page:{key}>"),
        ("WARC-Date", DATE),
        ("WARC-Target-URI", _line(url) or f"urn:page:{key}"),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
        *([("WARC-Refers-To", f"<urn:page:{refers_to}>"), ("WARC-Profile", PROFILE)] if revisit else []),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", str(len(block))),
    ]
    lines = "".join(f"{k}: {v}\r\n" for k, v in head).encode()
    return VERSION + b"\r\n" + lines + b"\r\n" + block + _END


def parse_record(data: bytes, at: int) -> tuple[dict[str, str], bytes, int]:
    """Headers, block, and where the next record starts."""
    end = data.index(b"\r\n\r\n", at)
    version, *lines = data[at:end].split(b"\r\n")
    if version != VERSION:
        raise ValueError("no record starts here")
    head = dict(line.decode().split(": ", 1) for line in lines)
    first, size = end + 4, int(head["Content-Length"])
    if data[first + size : first + size + 4] != _END:
        raise ValueError("the record's length is wrong")
    return head, data[first : first + size], first + size + 4


class Bundle:
    """Collects records; ``close`` gives the bundle without its last four bytes, which the writer adds."""

    def __init__(self, level: int = LEVEL):
        self.compress = zstandard.ZstdCompressor(level=level, write_content_size=True, write_checksum=True).compress
        self.frames: list[bytes] = []
        self.table: list[tuple[int, int, int]] = []
        self.index: list[tuple[str, int, int, int]] = []
        self.open: list[bytes] = []
        self.size = self.packed = 0

    def add(self, key: str, record: bytes) -> None:
        self.index.append((key, len(self.frames), self.size, len(record)))
        self.open.append(record)
        self.size += len(record)
        if self.size >= FRAME_BYTES:
            self._end_frame()

    def _end_frame(self) -> None:
        data = b"".join(self.open)
        frame = self.compress(data)
        self.frames.append(frame)
        self.table.append((len(frame), len(data), xxhash.xxh64_intdigest(data) & 0xFFFFFFFF))
        self.open, self.size = [], 0
        self.packed += len(frame)

    def close(self) -> bytes:
        if self.open:
            self._end_frame()
        index = json.dumps(self.index).encode()
        index = struct.pack("<II", SKIPPABLE_INDEX, len(index)) + index
        table = [*self.table, (len(index), 0, xxhash.xxh64_intdigest(b"") & 0xFFFFFFFF)]
        entries = b"".join(struct.pack("<III", *x) for x in table)
        foot = struct.pack("<IB", len(table), CHECKSUM_FLAG)
        seek = struct.pack("<II", SKIPPABLE_TABLE, len(entries) + len(foot) + 4) + entries + foot
        return b"".join([*self.frames, index, seek])


class Reader:
    """Random access to a bundle."""

    def __init__(self, data: bytes):
        if data[-4:] != SEEKABLE_MAGIC:
            raise ValueError("no seek table")
        n, flag = struct.unpack("<IB", data[-9:-4])
        first = len(data) - 9 - 12 * n
        if struct.unpack("<I", data[first - 8 : first - 4])[0] != SKIPPABLE_TABLE or flag != CHECKSUM_FLAG:
            raise ValueError("a seek table of another kind")
        entries = list(struct.iter_unpack("<III", data[first : len(data) - 9]))
        self.data, self.places, at = data, [], 0
        for packed, size, check in entries:
            self.places.append((at, packed, size, check))
            at += packed
        place, packed, _, _ = self.places.pop()
        self.index = [tuple(x) for x in json.loads(data[place + 8 : place + packed])]

    def frame(self, k: int) -> bytes:
        at, packed, size, check = self.places[k]
        data = zstandard.ZstdDecompressor().decompress(self.data[at : at + packed], max_output_size=size)
        if len(data) != size or xxhash.xxh64_intdigest(data) & 0xFFFFFFFF != check:
            raise ValueError(f"checksum of frame {k}")
        return data

    def record(self, key: str) -> bytes:
        """The first record of that identifier, by the index: one frame is unpacked."""
        k, at, size = next((k, at, size) for name, k, at, size in self.index if name == key)
        return self.frame(k)[at : at + size]


def with_revisits(pages: DataFrame, id_column: str, url_column: str, html_column: str, least: int) -> DataFrame:
    """key, url, payload (null for revisits), size, digest, refers_to."""
    payload = F.coalesce(F.col(html_column), F.lit("")).cast("binary")
    rows = pages.select(F.col(id_column).alias("key"), F.col(url_column).alias("url"), payload.alias("payload"))
    rows = rows.select("*", F.octet_length("payload").cast("bigint").alias("size"), F.sha1("payload").alias("digest"))
    groups = (
        rows.where(F.col("size") >= least)
        .groupBy(F.col("digest").alias("same"), F.col("size").alias("same_size"))
        .agg(F.max("key").alias("keeper"), F.count(F.lit(1)).alias("n"))
        .where(F.col("n") > 1)
    )
    # Only payloads that occur twice or more are on the right side.
    found = rows.join(groups, (F.col("digest") == F.col("same")) & (F.col("size") == F.col("same_size")), "left")
    revisit = F.col("keeper").isNotNull() & ~F.col("key").eqNullSafe(F.col("keeper"))
    return found.select(
        F.col("key").cast("string").alias("key"),
        F.col("url").cast("string").alias("url"),
        F.when(~revisit, F.col("payload")).alias("payload"),
        "size",
        "digest",
        F.when(revisit, F.col("keeper").cast("string")).alias("refers_to"),
    )


def write_archives(
    pages: DataFrame,
    path: str,
    id_column: str = "page_id",
    url_column: str = "url",
    html_column: str = "html",
    least: int = LEAST_REVISIT,
) -> None:
    """Write one record per row into bundles of bounded size in a new folder.

    A null text is an empty payload, a null url is replaced by the record's identifier. A null id is
    written as ``null`` and never the one that others revisit, unless all equal payloads have none: then
    each keeps its payload. Rows that repeat the largest id all keep theirs. Other columns take no part.
    An empty table gives a folder without bundles. Spark's committer publishes the bundles, so a task
    that is run again leaves nothing behind.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bundle = Bundle()
        for part in in_slices(batches, 64):
            for r in part.to_pylist():
                key = r["key"] or "null"
                bundle.add(key, make_record(key, r["url"], r["payload"], r["size"], r["digest"], r["refers_to"]))
                if bundle.packed >= BUNDLE_BYTES:
                    yield pa.RecordBatch.from_arrays([pa.array([bundle.close()], pa.binary())], names=["value"])
                    bundle = Bundle()
        if bundle.index:
            yield pa.RecordBatch.from_arrays([pa.array([bundle.close()], pa.binary())], names=["value"])

    bundles = with_revisits(pages, id_column, url_column, html_column, least).mapInArrow(run, "value binary")
    # The text writer puts out the bytes of a string as they are; one row makes one file, and its line end
    # is the magic number that ends a seek table.
    writer = bundles.select(F.col("value").cast("string")).write.option("maxRecordsPerFile", 1)
    writer.option("encoding", "ISO-8859-1").option("lineSep", SEEKABLE_MAGIC.decode("latin-1")).text(path)


_SCHEMA = "file string, frame bigint, offset bigint, key string, url string, record_type string, refers_to string, payload binary, payload_bytes bigint, payload_digest string"


def _bundles(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").option("pathGlobFilter", "*.txt").load(path).select("path", "content")


def _id(field: str | None) -> str | None:
    key = field[len("<urn:page:") : -1] if field else None
    return None if key == "null" else key


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """Every record of the bundles, frame by frame, each frame checked; payloads of responses only."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in in_slices(batches, 1):
            file, data = part.column(0)[0].as_py(), part.column(1)[0].as_py()
            if not data:
                continue
            bundle = Reader(data)
            for k in range(len(bundle.places)):
                content, at, rows = bundle.frame(k), 0, []
                while at < len(content):
                    head, block, after = parse_record(content, at)
                    http, _, payload = block.partition(b"\r\n\r\n")
                    size = int(http.rpartition(b"Content-Length: ")[2])
                    kind = head["WARC-Type"]
                    rows.append((
                        file, k, at, _id(head["WARC-Record-ID"]), head["WARC-Target-URI"], kind, _id(head.get("WARC-Refers-To")),
                        payload if kind == "response" else None, size, head["WARC-Payload-Digest"].removeprefix("sha1:"),
                    ))
                    at = after
                kinds = [pa.string(), pa.int64(), pa.int64(), *[pa.string()] * 4, pa.binary(), pa.int64(), pa.string()]
                names = ["file", "frame", "offset", "key", "url", "record_type", "refers_to", "payload", "payload_bytes", "payload_digest"]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=names)

    return _bundles(spark, path).mapInArrow(run, _SCHEMA)


def read_index(spark: SparkSession, path: str) -> DataFrame:
    """file, key, frame, offset and length of every record, from the bundles' indexes alone."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in in_slices(batches, 1):
            index = Reader(part.column(1)[0].as_py()).index
            columns = [[part.column(0)[0].as_py()] * len(index), *zip(*index)]
            kinds = [pa.string(), pa.string(), pa.int64(), pa.int64(), pa.int64()]
            names = ["file", "key", "frame", "offset", "length"]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names=names)

    return _bundles(spark, path).mapInArrow(run, "file string, key string, frame bigint, offset bigint, length bigint")


def op8_seekable_warc(spark, sf_dir):
    """What the archives hold of every page."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    path = shared_dir(spark, "warc")
    write_archives(pages, path)
    kind = pages.schema["page_id"].dataType
    stored = F.col("payload").isNotNull()
    return read_archives(spark, path).select(
        F.col("key").cast(kind).alias("page_id"),
        F.when(stored, F.octet_length("payload").cast("bigint")).otherwise(F.col("payload_bytes")).alias("payload_bytes"),
        F.when(stored, F.sha1("payload")).otherwise(F.col("payload_digest")).alias("payload_digest"),
        "record_type",
        F.col("refers_to").cast(kind).alias("refers_to"),
    )


OP8_SQL = """
WITH p AS (
  SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages
), k AS (
  SELECT payload_digest, payload_bytes, max(page_id) AS keeper FROM p WHERE payload_bytes >= 1000 GROUP BY ALL
)
SELECT page_id, CAST(p.payload_bytes AS BIGINT) AS payload_bytes, p.payload_digest,
       CASE WHEN keeper IS NOT NULL AND page_id IS DISTINCT FROM keeper THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id IS DISTINCT FROM keeper THEN keeper END AS refers_to
FROM p LEFT JOIN k ON p.payload_digest = k.payload_digest AND p.payload_bytes = k.payload_bytes
"""

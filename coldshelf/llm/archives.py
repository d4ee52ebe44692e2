"""WARC records in seekable Zstandard bundles.

A bundle holds groups of records, each group a Zstandard frame of its own, and ends with
a seek table: a frame that decoders skip, with the compressed and plain size of every
frame.  An index gives the bundle, the frame and the place within the plain frame for each
record identifier, so one record is read by one seek and one small frame.

Of pages with equal payloads the one with the least id is written as response, the others
as revisits that refer to it.  Bundles get a name of their own for each attempt of a task;
the index, written once, names the bundles of the attempts that counted, so a lost
executor leaves at most a file that nothing names.

Defined results: a null payload is empty, a null address is left out, a null id is greater
than all others.  Ids enter headers percent-encoded, so any text may be one; rows that
share an id are told apart by nothing and each is a response if one is.  A payload of any
length is one record, cut into frames by whole records.  Other columns of the input are
ignored, whatever their names; an empty table gives no bundle and no rows.
"""

from __future__ import annotations

import base64
import re
import struct
import uuid
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from coldshelf.llm.batches import slices
from coldshelf.plans.staging import new_path, stage

# fixed values of the seekable format and of the archive format
SKIPPABLE_MAGIC = 0x184D2A5E
SEEKABLE_MAGIC = 0x8F92EAB1
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

FRAME_BYTES = 256 << 10
BUNDLE_BYTES = 256 << 20
_INDEX = "record_id string, bundle string, frame int, start bigint, length bigint"
_ID, _NO_ID = "urn:x-page:", "urn:x-page-without-id"


def page_urn(page_id) -> str:
    """The record identifier of a page; percent-encoded, as it stands in a header."""
    return _NO_ID if page_id is None else _ID + quote(str(page_id), safe="")


def _open(path: str) -> tuple[fs.FileSystem, str]:
    if re.match(r"[A-Za-z][A-Za-z0-9+.-]*:", path):
        return fs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", path))
    return fs.LocalFileSystem(), path


def record(kind: str, record_id: str, headers: dict[str, str | None], block: bytes) -> bytes:
    """One record; headers without a value are left out."""
    fields = {"WARC-Type": kind, "WARC-Record-ID": f"<{record_id}>", **headers, "Content-Length": str(len(block))}
    lines = ["WARC/1.1", *(f"{k}: {v}" for k, v in fields.items() if v is not None)]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def page_record(page_id, url: str | None, payload: bytes, digest: str, refers_to, date: str) -> bytes:
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    headers: dict[str, str | None] = {
        "WARC-Date": date,
        "WARC-Target-URI": None if url is None else re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url),
        "WARC-Payload-Digest": f"sha1:{digest}",
        "Content-Type": "application/http; msgtype=response",
    }
    if refers_to is None:
        return record("response", page_urn(page_id), headers, http + payload)
    headers |= {"WARC-Refers-To": f"<{page_urn(refers_to[0])}>", "WARC-Profile": REVISIT_PROFILE}
    return record("revisit", page_urn(page_id), headers, http)


class BundleWriter:
    """Writes records into frames and closes the bundle with its seek table."""

    def __init__(self, folder: str) -> None:
        system, root = _open(folder)
        system.create_dir(root, recursive=True)
        self.name = f"{uuid.uuid4().hex}.warc.zst"
        self.out = system.open_output_stream(f"{root}/{self.name}", compression=None)
        self.compressor = zstandard.ZstdCompressor(level=3)
        self.pending: list[bytes] = []
        self.size = 0
        self.sizes: list[tuple[int, int]] = []
        self.written = 0
        self.add(record("warcinfo", f"urn:uuid:{uuid.uuid4()}", {"Content-Type": "application/warc-fields"}, b"format: WARC File Format 1.1\r\n"))

    def add(self, data: bytes) -> tuple[int, int, int]:
        """Frame, start in the plain frame and length of the record."""
        if self.pending and self.size + len(data) > FRAME_BYTES:
            self._end_frame()
        place = (len(self.sizes), self.size, len(data))
        self.pending.append(data)
        self.size += len(data)
        return place

    def _end_frame(self) -> None:
        frame = self.compressor.compress(b"".join(self.pending))
        self.out.write(frame)
        self.sizes.append((len(frame), self.size))
        self.written += len(frame)
        self.pending, self.size = [], 0

    def close(self) -> None:
        if self.pending:
            self._end_frame()
        table = b"".join(struct.pack("<II", *pair) for pair in self.sizes)
        footer = struct.pack("<IBI", len(self.sizes), 0, SEEKABLE_MAGIC)
        self.out.write(struct.pack("<II", SKIPPABLE_MAGIC, len(table) + len(footer)) + table + footer)
        self.out.close()


def write_bundles(
    pages: DataFrame,
    folder: str,
    *,
    id_col: str = "page_id",
    url_col: str = "url",
    payload_col: str = "html",
    date: str = "1970-01-01T00:00:00Z",
    least_bytes: int = 0,
) -> DataFrame:
    """Write a record for every row below ``folder``; returns the index, already written.

    Payloads of fewer than ``least_bytes`` bytes are never revisits.
    """
    chosen = pages.select(
        F.col(id_col).alias("id"),
        F.col(url_col).cast("string").alias("url"),
        F.coalesce(F.col(payload_col).cast("binary"), F.lit(b"")).alias("payload"),
    ).withColumn("digest", F.sha1("payload"))
    equal = (
        chosen.where(F.octet_length("payload") >= least_bytes)
        .groupBy("digest")
        .agg(F.min("id").alias("first"), F.count("*").alias("n"))
    )
    firsts = stage(equal.where("n > 1").select("digest", "first", F.lit(True).alias("many")), "firsts")
    decided = chosen.join(firsts, "digest", "left").select(
        "id", "url", "payload", "digest", "first",
        (F.coalesce("many", F.lit(False)) & ~F.col("id").eqNullSafe(F.col("first"))).alias("revisit"),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer = None
        for whole in batches:
            for batch in slices(whole, "payload"):
                rows = []
                for row in batch.to_pylist():
                    if writer and writer.written >= BUNDLE_BYTES:
                        writer.close()
                        writer = None
                    writer = writer or BundleWriter(folder)
                    digest = base64.b32encode(bytes.fromhex(row["digest"])).decode()
                    refers_to = (row["first"],) if row["revisit"] else None
                    data = page_record(row["id"], row["url"], row["payload"], digest, refers_to, date)
                    rows.append((page_urn(row["id"]), writer.name, *writer.add(data)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c) for c in zip(*rows, strict=True)], ["record_id", "bundle", "frame", "start", "length"]
                )
        if writer:
            writer.close()

    return stage(decided.mapInArrow(_typed(run), _INDEX), "index")


def _typed(run):
    schema = pa.schema(
        [("record_id", pa.string()), ("bundle", pa.string()), ("frame", pa.int32()), ("start", pa.int64()), ("length", pa.int64())]
    )

    def typed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in run(batches):
            yield batch.cast(schema)

    return typed


# -- reading ------------------------------------------------------------------------


def seek_table(source) -> list[tuple[int, int, int]]:
    """(offset, compressed size, plain size) of every frame of an open bundle."""
    end = source.size()
    count, _, magic = struct.unpack("<IBI", source.read_at(9, end - 9))
    if magic != SEEKABLE_MAGIC:
        raise ValueError("the bundle has no seek table")
    entries = struct.iter_unpack("<II", source.read_at(8 * count, end - 9 - 8 * count))
    frames, offset = [], 0
    for packed, plain in entries:
        frames.append((offset, packed, plain))
        offset += packed
    return frames


def parse_records(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields and block of each record of a plain frame."""
    at = 0
    while at < len(data):
        end = data.index(b"\r\n\r\n", at)
        lines = data[at:end].decode().split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError("not a record")
        fields = dict(line.split(": ", 1) for line in lines[1:])
        start = end + 4
        at = start + int(fields["Content-Length"])
        yield fields, data[start:at]
        if data[at : at + 4] != b"\r\n\r\n":
            raise ValueError("a record is longer or shorter than it says")
        at += 4


_RECORDS = "record_id string, record_type string, url string, payload_digest string, payload_bytes bigint, refers_to string, payload binary"


def _row(fields: dict[str, str], block: bytes) -> tuple:
    head, _, payload = block.partition(b"\r\n\r\n")
    length = int(re.search(rb"Content-Length: (\d+)", head)[1])
    refers_to = fields.get("WARC-Refers-To")
    return (
        fields["WARC-Record-ID"][1:-1], fields["WARC-Type"], fields.get("WARC-Target-URI"),
        fields["WARC-Payload-Digest"].removeprefix("sha1:"), length, refers_to[1:-1] if refers_to else None,
        payload if fields["WARC-Type"] == "response" else None,
    )


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    types = [pa.string()] * 4 + [pa.int64(), pa.string(), pa.binary()]
    names = [c.split()[0] for c in _RECORDS.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names)


def read_bundles(index: DataFrame, folder: str) -> DataFrame:
    """All records of the bundles that an index names, frame by frame.

    Bundles are dealt out over as many tasks as there are bundles, which adaptive execution
    does not join again, however little of the index each of them gets.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = _open(folder)
        for batch in batches:
            for name in batch.column("bundle").to_pylist():
                with system.open_input_file(f"{root}/{name}") as source:
                    for offset, packed, plain in seek_table(source):
                        data = zstandard.ZstdDecompressor().decompress(source.read_at(packed, offset), max_output_size=plain)
                        rows = [_row(f, b) for f, b in parse_records(data) if f["WARC-Type"] != "warcinfo"]
                        if rows:
                            yield _batch(rows)

    bundles = stage(index.select("bundle").distinct(), "bundles")
    return bundles.repartition(max(1, bundles.count()), "bundle").mapInArrow(run, _RECORDS)


def fetch_records(index: DataFrame, folder: str) -> DataFrame:
    """The records of some rows of an index, each by a seek to its frame."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = _open(folder)
        for batch in batches:
            for row in batch.to_pylist():
                with system.open_input_file(f"{root}/{row['bundle']}") as source:
                    offset, packed, plain = seek_table(source)[row["frame"]]
                    data = zstandard.ZstdDecompressor().decompress(source.read_at(packed, offset), max_output_size=plain)
                part = data[row["start"] : row["start"] + row["length"]]
                yield _batch([_row(*next(parse_records(part)))])

    return index.select("bundle", "frame", "start", "length").mapInArrow(run, _RECORDS)


def archive_round_trip(pages: DataFrame, *, id_col: str = "page_id", folder: str | None = None, **columns: str) -> DataFrame:
    """Write bundles, read them back, and describe each page by what its record says.

    Returns the id, ``payload_bytes``, ``payload_digest``, ``record_type`` and ``refers_to``.
    """
    folder = folder or new_path(pages.sparkSession, "bundles")
    index = write_bundles(pages, folder, id_col=id_col, **columns)
    kind = pages.schema[id_col].dataType

    def page(column: str) -> Column:
        return F.when(F.col(column).startswith(_ID), F.url_decode(F.substr(column, F.lit(len(_ID) + 1)))).cast(kind)

    return read_bundles(index, folder).select(
        page("record_id").alias(id_col), "payload_bytes", "payload_digest", "record_type", page("refers_to").alias("refers_to")
    )

"""WARC archives compressed with their own Zstandard dictionary.

Each task packs its records into archives of some ``ARCHIVE_BYTES``: a
dictionary is trained on the first ``SAMPLE_BYTES`` of an archive's records,
embedded in a leading skippable frame (magic 0x184D2A5D), and every record is
a frame of its own compressed with it.  Too few or too small records train no
dictionary; such an archive has none.  An archive is a row (archive, data) of
a table in the shared folder, ``data`` being the bytes of a .warc.zst file;
names follow the task's partition, so a repeated task writes the same.

Records of equal payloads (by SHA-1) of at least ``least`` bytes: that with
the smallest page_id is a response, the others are revisits that refer to it.
All rows that repeat the smallest page_id are responses; null page_ids count
as larger than any other.  A null html is an empty payload, a null url a
``urn:page:`` of the id.  Control characters and spaces in a url are escaped.
"""

from __future__ import annotations

import base64
import hashlib
import io
import re
from collections.abc import Iterator
from pathlib import Path
from urllib.parse import quote

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from rollwise.llm.common import saved

ARCHIVE_BYTES = 4 << 20
SAMPLE_BYTES = 2 << 20
DICTIONARY_BYTES = 64 << 10
LEVEL = 6
SALT = 32
DATE = "2024-01-01T00:00:00Z"
#: Fixed values of the formats.
SKIPPABLE = 0x184D2A5D
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def digest32(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, revisit: bool) -> bytes:
    """One WARC/1.1 record; a revisit keeps the HTTP head and leaves the payload out."""
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = head if revisit else head + payload
    target = quote(url, safe="!#$%&'()*+,/:;=?@[]~") if url else f"urn:page:{page_id}"
    lines = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: <urn:page:{page_id}>",
             f"WARC-Date: {DATE}", f"WARC-Target-URI: {target}", f"WARC-Payload-Digest: sha1:{digest32(payload)}",
             f"WARC-Block-Digest: sha1:{digest32(block)}", "Content-Type: application/http; msgtype=response"]
    if revisit:
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <urn:page:{refers_to}>"]
    lines += [f"Content-Length: {len(block)}", "", ""]
    return "\r\n".join(lines).encode() + block + b"\r\n\r\n"


class Packer:
    """Builds one archive after the other from records."""

    def __init__(self):
        self.waiting, self.size, self.out, self.frames = [], 0, None, None

    def _open(self) -> None:
        import zstandard
        self.out = io.BytesIO()
        try:
            trained = zstandard.train_dictionary(DICTIONARY_BYTES, self.waiting) if len(self.waiting) > 7 else None
        except zstandard.ZstdError:  # samples too few or too alike
            trained = None
        if trained:
            raw = trained.as_bytes()
            self.out.write(SKIPPABLE.to_bytes(4, "little") + len(raw).to_bytes(4, "little") + raw)
        self.frames = zstandard.ZstdCompressor(level=LEVEL, dict_data=trained, write_content_size=True, write_checksum=True)
        for r in self.waiting:
            self.out.write(self.frames.compress(r))
        self.waiting, self.size = [], 0

    def add(self, data: bytes) -> bytes | None:
        """Takes a record; gives the archive that it filled."""
        if self.out is None:
            self.waiting.append(data)
            self.size += len(data)
            if self.size < SAMPLE_BYTES:
                return None
            self._open()
        else:
            self.out.write(self.frames.compress(data))
        return self.close() if self.out.tell() >= ARCHIVE_BYTES else None

    def close(self) -> bytes | None:
        if self.out is None and not self.waiting:
            return None
        if self.out is None:
            self._open()
        data, self.out = self.out.getvalue(), None
        return data


def records(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(header, block) of each record of an archive; block digests are checked."""
    import zstandard
    dictionary, at = None, 0
    if int.from_bytes(data[:4], "little") == SKIPPABLE:
        at = 8 + int.from_bytes(data[4:8], "little")
        dictionary = zstandard.ZstdCompressionDict(data[8:at])
    reader = io.BufferedReader(zstandard.ZstdDecompressor(dict_data=dictionary).stream_reader(
        io.BytesIO(memoryview(data)[at:]), read_across_frames=True))
    while version := reader.readline():
        if version.strip() != b"WARC/1.1":
            raise ValueError(f"no record where one should begin: {version[:40]!r}")
        header = {}
        while line := reader.readline().decode().rstrip("\r\n"):
            name, _, value = line.partition(": ")
            header[name] = value
        block = reader.read(int(header["Content-Length"]))
        if reader.read(4) != b"\r\n\r\n" or header["WARC-Block-Digest"] != f"sha1:{digest32(block)}":
            raise ValueError(f"record {header.get('WARC-Record-ID')} is damaged")
        yield header, block


def _page(urn: str | None) -> int | None:
    m = re.fullmatch(r"<urn:page:(-?\d+)>", urn or "")
    return int(m[1]) if m else None


def write_archives(pages: DataFrame, least: int = 0) -> DataFrame:
    """Archives (archive, data) of ``pages`` (page_id, url, html), in the shared folder."""
    payload = F.coalesce("html", F.lit(""))
    rows = pages.select("page_id", "url", payload.alias("html"), F.sha1(payload.cast("binary")).alias("sha"),
                        F.octet_length(payload).alias("size"))
    copies = (rows.where(F.col("size") >= least).groupBy("sha")
              .agg(F.min("page_id").alias("first"), F.count("*").alias("copies")).where("copies > 1").drop("copies"))
    # One payload may be a third of all rows: its rows are dealt over SALT parts.
    salted = copies.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALT - 1))))
    linked = (rows.withColumn("salt", F.pmod(F.xxhash64("page_id"), F.lit(SALT)).cast("int"))
              .join(salted, ["sha", "salt"], "left").select("page_id", "url", "html", "first"))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer, part, n = Packer(), TaskContext.get().partitionId(), 0

        def row(data: bytes) -> pa.RecordBatch:
            nonlocal n
            n += 1
            return pa.RecordBatch.from_arrays([pa.array([f"pages-{part:06d}-{n:05d}.warc.zst"]), pa.array([data], pa.binary())],
                                              names=["archive", "data"])

        for batch in batches:
            for k in range(batch.num_rows):
                page, url, html, first = (batch.column(c)[k].as_py() for c in range(4))
                again = first is not None and page != first
                if full := packer.add(record(page, url, html.encode(), first, again)):
                    yield row(full)
        if full := packer.close():
            yield row(full)

    return saved(linked.mapInArrow(pack, "archive string, data binary"), "warc")


def read_archives(archives: DataFrame) -> DataFrame:
    """A row per record: page_id, payload_bytes, payload_digest, record_type,
    refers_to and, of responses, the payload."""

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "payload"]
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()]
        for batch in batches:
            for k in range(batch.num_rows):
                rows, size = [], 0
                for header, block in records(batch.column(0)[k].as_py()):
                    head, _, payload = block.partition(b"\r\n\r\n")
                    length = int(re.search(rb"Content-Length: (\d+)", head)[1])
                    digest = header["WARC-Payload-Digest"].removeprefix("sha1:")
                    kind = header["WARC-Type"]
                    if kind == "response" and (len(payload) != length or digest32(payload) != digest):
                        raise ValueError(f"payload of {header['WARC-Record-ID']} is damaged")
                    rows.append((_page(header["WARC-Record-ID"]), length, digest, kind, _page(header.get("WARC-Refers-To")),
                                 payload if kind == "response" else None))
                    size += len(payload)
                    if size > 4 << 20:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=names)
                        rows, size = [], 0
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=names)

    return archives.select("data").mapInArrow(
        unpack, "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary")


def export(archives: DataFrame, folder: str) -> None:
    """The archives as files of a folder that every executor mounts."""

    def write(rows) -> None:
        for r in rows:
            path = Path(folder, r.archive)
            path.with_suffix(".part").write_bytes(r.data)
            path.with_suffix(".part").replace(path)

    archives.foreachPartition(write)

"""WARC archives as seekable Zstandard bundles.

Each record is complete; records are put together into independent frames of about a mebibyte, and the file
ends with an index from record id to (frame, offset in the frame, length) and a seek table. A reader of one
record decompresses one frame.

Of records with equal payloads one is written as ``response`` and the others as ``revisit`` records that name it
and hold the HTTP header alone.

Defined cases: a null html is an empty payload; a null url is written as empty; of rows with equal id and payload the
first is the response if that id is the largest, the rest revisit it; rows without an id count as smallest; other columns
are ignored; an empty table gives no files.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellweave.llm.common import filesystem, keep, rows, scratch, whole_file
from cellweave.llm.seekable import FrameReader, FrameWriter

FRAME_BYTES = 1 << 20
# Stands for a missing page id, the smallest of all.
NO_ID = -(1 << 63)
MANIFEST = "file string, n_records long"
READ = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_LENGTH = re.compile(rb"\r\nContent-Length: (\d+)\r\n")


def record_id(page_id: int, digest: str, repeat: int = 0) -> str:
    """Identifier of the record of a page and its payload's digest; repeated rows of both are numbered.

    Rows of one page id but different payloads are written by different tasks, so the id alone would not be unique.
    """
    return f"urn:page:{'none' if page_id == NO_ID else page_id}:{digest}" + (f":{repeat}" if repeat else "")


def page_of(identifier: str) -> int | None:
    page = identifier.split(":")[2]
    return None if page == "none" else int(page)


def sha1_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def make_record(
    identifier: str, url: str, payload: bytes, date: str, refers_to: str | None
) -> bytes:
    """One WARC record; with ``refers_to`` a revisit, whose block leaves the payload out."""
    http = (
        "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
        f"Content-Length: {len(payload)}\r\n\r\n"
    ).encode()
    block = http + payload if refers_to is None else http
    fields = {
        "WARC-Type": "response" if refers_to is None else "revisit",
        "WARC-Record-ID": f"<{identifier}>",
        "WARC-Date": date,
        "WARC-Target-URI": quote(url, safe=":/?#[]@!$&'()*+,;=%-._~"),
        "WARC-Payload-Digest": f"sha1:{sha1_digest(payload)}",
        "Content-Type": "application/http; msgtype=response",
    }
    if refers_to is not None:
        fields |= {"WARC-Refers-To": f"<{refers_to}>", "WARC-Profile": REVISIT_PROFILE}
    fields["Content-Length"] = str(len(block))
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields.items()) + "\r\n"
    return head.encode() + block + b"\r\n\r\n"


def parse_records(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields and block of each record in a frame."""
    at = 0
    while at < len(data):
        stop = data.index(b"\r\n\r\n", at)
        lines = data[at:stop].decode().split("\r\n")
        if lines[0] != "WARC/1.1":
            raise ValueError("not a WARC record")
        fields = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in lines[1:])
        end = stop + 4 + int(fields["Content-Length"])
        if data[end : end + 4] != b"\r\n\r\n":
            raise ValueError("a record does not end where its header says")
        yield fields, data[stop + 4 : end]
        at = end + 4


class BundleWriter:
    """Groups records into frames; holds one frame and the index of the file."""

    def __init__(self, out, frame_bytes: int = FRAME_BYTES):
        self.frames = FrameWriter(out)
        self.frame_bytes = frame_bytes
        self.waiting = bytearray()
        self.index: list[str] = []
        self.number = 0

    def add(self, identifier: str, record: bytes) -> None:
        if self.waiting and len(self.waiting) + len(record) > self.frame_bytes:
            self._flush()
        self.index.append(f"{identifier}\t{self.number}\t{len(self.waiting)}\t{len(record)}")
        self.waiting += record

    def _flush(self) -> None:
        self.frames.frame(bytes(self.waiting))
        self.waiting.clear()
        self.number += 1

    def close(self) -> None:
        if self.waiting:
            self._flush()
        self.frames.finish("\n".join(self.index).encode())


class BundleReader:
    """Records of a bundle, one by identifier or all in order."""

    def __init__(self, source):
        self.frames = FrameReader(source)

    def record(self, identifier: str) -> tuple[dict[str, str], bytes]:
        index = b"\n%b\n" % self.frames.index()
        at = index.find(b"\n%b\t" % identifier.encode())
        if at < 0:
            raise KeyError(identifier)
        _, frame, offset, length = index[at + 1 : index.index(b"\n", at + 1)].split(b"\t")
        data = self.frames.frame(int(frame))
        return next(parse_records(data[int(offset) : int(offset) + int(length)]))

    def records(self) -> Iterator[tuple[dict[str, str], bytes]]:
        for number in range(self.frames.frames):
            yield from parse_records(self.frames.frame(number))


def with_response(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Pages with ``digest`` and, for payloads of at least ``min_bytes`` found twice or more, ``response``: the
    largest page id that has it.

    Only ids and digests are grouped and joined for that. The pages themselves move once, equal ones together, so
    that a response and its repeated rows meet in one task.
    """
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    key = F.coalesce(F.col("page_id"), F.lit(NO_ID)).alias("_key")
    digest = F.sha1(payload).alias("digest")
    named = pages.select(key, digest).where(F.octet_length(payload) >= min_bytes)
    groups = named.groupBy("digest").agg(F.max("_key").alias("response"), F.count("*").alias("n")).where("n > 1")
    shared = named.join(groups.drop("n"), "digest").distinct()
    full = pages.select(key, digest, F.coalesce("url", F.lit("")).alias("url"), payload.alias("payload"))
    return full.repartition("_key", "digest").join(shared, ["_key", "digest"], "left")


def write_archives(
    pages: DataFrame, folder: str, min_bytes: int = 0, date: str = "2025-01-01T00:00:00Z", frame_bytes: int = FRAME_BYTES
) -> DataFrame:
    """Write a record for each page to bundles in ``folder``; a row for each file, which the caller must store."""
    ready = with_response(pages, min_bytes).sortWithinPartitions("_key", "digest")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        batches = (b for b in batches if b.num_rows)
        first = next(batches, None)
        if first is None:
            return
        name = f"pages-{TaskContext.get().partitionId():07d}.warc.zst"
        count, last, repeat = 0, None, 0
        with whole_file(folder, name) as out:
            writer = BundleWriter(out, frame_bytes)
            while first is not None:
                for page_id, url, payload, digest, response in rows(
                    first, "_key", "url", "payload", "digest", "response"
                ):
                    repeat = repeat + 1 if last == (page_id, digest) else 0
                    last = (page_id, digest)
                    is_response = response is None or (response == page_id and not repeat)
                    identifier = record_id(page_id, digest, repeat)
                    refers_to = None if is_response else record_id(response, digest)
                    writer.add(identifier, make_record(identifier, url, payload, date, refers_to))
                    count += 1
                first = next(batches, None)
            writer.close()
        yield pa.RecordBatch.from_pydict({"file": [name], "n_records": pa.array([count], pa.int64())})

    return ready.mapInArrow(write, MANIFEST)


def read_archives(spark: SparkSession, folder: str, manifest: DataFrame) -> DataFrame:
    """Per record: page, size and digest of the full payload, record type and the page it revisits.

    The digest of a response is worked out from its payload and must be that in its header.
    """
    files = manifest.select("file").repartitionByRange(max(1, manifest.count()), "file")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = filesystem(folder)
        for batch in batches:
            for (name,) in rows(batch, "file"):
                with system.open_input_file(f"{root}/{name}") as source:
                    found = []
                    for fields, block in BundleReader(source).records():
                        found.append(_described(fields, block))
                        if len(found) == 4096:
                            yield _batch(found)
                            found = []
                    if found:
                        yield _batch(found)

    return files.mapInArrow(read, READ)


def _described(fields: dict[str, str], block: bytes) -> tuple:
    kind = fields["WARC-Type"]
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    cut = block.index(b"\r\n\r\n") + 4
    size = int(_LENGTH.search(block[:cut])[1])
    refers_to = None
    if kind == "response":
        payload = block[cut:]
        if len(payload) != size or sha1_digest(payload) != digest:
            raise ValueError(f"the payload of {fields['WARC-Record-ID']} does not match its header")
    else:
        refers_to = page_of(fields["WARC-Refers-To"].strip("<>"))
    return page_of(fields["WARC-Record-ID"].strip("<>")), size, digest, kind, refers_to


def _batch(found: list[tuple]) -> pa.RecordBatch:
    kinds = {"page_id": pa.int64(), "payload_bytes": pa.int64(), "payload_digest": pa.string()}
    kinds |= {"record_type": pa.string(), "refers_to": pa.int64()}
    columns = [pa.array(c, t) for c, t in zip(zip(*found, strict=True), kinds.values(), strict=True)]
    return pa.RecordBatch.from_arrays(columns, names=list(kinds))


def archives(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Write the archives to a folder of their own and describe the records read back."""
    spark = pages.sparkSession
    folder = scratch(spark, "archives")
    return read_archives(spark, folder, keep(write_archives(pages, folder, min_bytes), "manifest"))

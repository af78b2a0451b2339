"""Token ids in binary files of independent Zstandard frames.

A shard file holds the ids of its documents one after another as little-endian unsigned 32-bit
integers, cut into frames of a fixed number of ids, so the frame of an id follows by division.
Its index has the document ids and where each document starts. A reader of some documents
decompresses only the frames these lie in.

Defined cases: a null text is an empty one and gives the end id alone; null document ids come
first; documents of equal id are all written, in an order of their own; a text of any length is one record;
other columns are ignored; an empty table gives no files.
"""

from __future__ import annotations

import struct
import zlib
from bisect import bisect_right
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cellweave.llm.common import filesystem, keep, rows, scratch, text_or_empty, whole_file
from cellweave.llm.encoder import batch_encoder
from cellweave.llm.seekable import FrameReader, FrameWriter

FRAME_TOKENS = 1 << 18
HEAD = struct.Struct("<QQ")
NO_ID = -(1 << 63)
MANIFEST = "shard int, file string, n_docs long, n_tokens long"


class ShardWriter:
    """Collects ids into frames; holds one frame and 16 bytes a document."""

    def __init__(self, out, frame_tokens: int = FRAME_TOKENS):
        self.frames = FrameWriter(out)
        self.frame_bytes = 4 * frame_tokens
        self.frame_tokens = frame_tokens
        self.waiting = bytearray()
        self.doc_ids: list[int] = []
        self.starts: list[int] = []
        self.tokens = 0

    def add(self, doc_id: int | None, ids: bytes) -> None:
        self.doc_ids.append(NO_ID if doc_id is None else doc_id)
        self.starts.append(self.tokens)
        self.tokens += len(ids) // 4
        self.waiting += ids
        while len(self.waiting) >= self.frame_bytes:
            self.frames.frame(bytes(self.waiting[: self.frame_bytes]))
            del self.waiting[: self.frame_bytes]

    def close(self) -> None:
        if self.waiting:
            self.frames.frame(bytes(self.waiting))
        self.frames.finish(
            HEAD.pack(self.frame_tokens, self.tokens)
            + np.array(self.doc_ids, dtype="<i8").tobytes()
            + np.array(self.starts, dtype="<u8").tobytes()
        )


class ShardReader:
    """Documents of one shard file, by position or by id."""

    def __init__(self, source):
        self.frames = FrameReader(source)
        index = self.frames.index()
        self.frame_tokens, self.tokens = HEAD.unpack_from(index)
        n = (len(index) - HEAD.size) // 16
        self.doc_ids = np.frombuffer(index, dtype="<i8", count=n, offset=HEAD.size)
        self.starts = np.frombuffer(index, dtype="<u8", count=n, offset=HEAD.size + 8 * n)
        self.last: tuple[int, bytes] = (-1, b"")

    def span(self, position: int) -> tuple[int, int]:
        end = self.starts[position + 1] if position + 1 < len(self.starts) else self.tokens
        return int(self.starts[position]), int(end)

    def pieces(self, position: int) -> Iterator[bytes]:
        """The ids of a document, a piece for each frame it lies in."""
        start, end = self.span(position)
        while start < end:
            number, skip = divmod(start, self.frame_tokens)
            if self.last[0] != number:
                self.last = (number, self.frames.frame(number))
            stop = min(end, (number + 1) * self.frame_tokens)
            yield self.last[1][4 * skip : 4 * (skip + stop - start)]
            start = stop

    def document(self, doc_id: int) -> np.ndarray:
        """The ids of the first document of this id; ids ascend in a file."""
        at = int(np.searchsorted(self.doc_ids, doc_id))
        if at == len(self.doc_ids) or self.doc_ids[at] != doc_id:
            raise KeyError(doc_id)
        return np.frombuffer(b"".join(self.pieces(at)), dtype="<u4")

    def holder(self, token: int) -> int:
        """Position of the document that holds a token of the shard."""
        return bisect_right(self.starts, token) - 1


def write_token_files(
    docs: DataFrame, folder: str, tokenizer: str, end_id: int, frame_tokens: int = FRAME_TOKENS
) -> DataFrame:
    """Write documents in ascending id order; a row for each shard file, which the caller must store.

    Rows of equal id and text may go to different shards, so that no id makes a large one.
    """
    text = text_or_empty()
    ordered = (
        docs.select("doc_id", text.alias("text"))
        .withColumn("_text", F.xxhash64("text"))
        .withColumn("_row", F.monotonically_increasing_id())
    )
    keys = ("doc_id", "_text", "_row")
    ordered = ordered.repartitionByRange(*keys).sortWithinPartitions(*keys).select("doc_id", "text")
    end = np.array([end_id], dtype="<u4").tobytes()

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = batch_encoder(tokenizer)
        shard = TaskContext.get().partitionId()
        batches = (b for b in batches if b.num_rows)
        first = next(batches, None)
        if first is None:
            return
        name = f"shard-{shard:07d}.tokens"
        with whole_file(folder, name) as out:
            writer = ShardWriter(out, frame_tokens)
            texts = (row for batch in chain([first], batches) for row in rows(batch, "doc_id", "text"))
            for doc_id, ids in encoder.encode_all(texts):
                writer.add(doc_id, ids + end)
            writer.close()
        yield pa.RecordBatch.from_pydict(
            {
                "shard": pa.array([shard], pa.int32()),
                "file": [name],
                "n_docs": [len(writer.doc_ids)],
                "n_tokens": [writer.tokens],
            }
        )

    return ordered.mapInArrow(write, MANIFEST)


def read_token_files(spark: SparkSession, folder: str, manifest: DataFrame) -> DataFrame:
    """Per document: its id, the ids before it in all shards, how many it has and their CRC-32.

    The manifest has a row for each file, so numbering it is small work for one task.
    """
    before = F.sum("n_tokens").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1))
    files = manifest.withColumn("base", F.coalesce(before, F.lit(0)))
    files = files.repartitionByRange(max(1, manifest.count()), "shard")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = filesystem(folder)
        for batch in batches:
            for name, base in rows(batch, "file", "base"):
                with system.open_input_file(f"{root}/{name}") as source:
                    shard = ShardReader(source)
                    for at in range(0, len(shard.doc_ids), 8192):
                        yield _described(shard, base, range(at, min(at + 8192, len(shard.doc_ids))))

    return files.mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def _described(shard: ShardReader, base: int, positions: range) -> pa.RecordBatch:
    found = {"doc_id": [], "start": [], "n_tokens": [], "ids_crc32": []}
    for position in positions:
        start, end = shard.span(position)
        check = 0
        for piece in shard.pieces(position):
            check = zlib.crc32(piece, check)
        doc_id = int(shard.doc_ids[position])
        found["doc_id"].append(None if doc_id == NO_ID else doc_id)
        found["start"].append(base + start)
        found["n_tokens"].append(end - start)
        found["ids_crc32"].append(check)
    return pa.RecordBatch.from_pydict({k: pa.array(v, pa.int64()) for k, v in found.items()})


def token_files(docs: DataFrame, tokenizer: str, end_id: int, frame_tokens: int = FRAME_TOKENS) -> DataFrame:
    """Write the files to a folder of their own and describe what they hold."""
    spark = docs.sparkSession
    folder = scratch(spark, "tokens")
    manifest = keep(write_token_files(docs, folder, tokenizer, end_id, frame_tokens), "manifest")
    return read_token_files(spark, folder, manifest)

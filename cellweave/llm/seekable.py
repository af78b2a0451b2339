"""Files of independent Zstandard frames with a trailing seek table.

The layout is the public "Zstandard Seekable Format": data frames, then a skippable frame that
lists compressed size, plain size and a checksum (low 32 bits of XXH64) of every frame, then a
footer. Any Zstandard decoder reads such a file from start to end; a reader with the table
decompresses single frames. The caller's index is a skippable frame of its own, listed with plain
size zero just before the table.
"""

from __future__ import annotations

import struct
from itertools import accumulate

import xxhash
import zstandard

# Fixed values of the format.
TABLE_MAGIC = 0x184D2A5E
FOOTER_MAGIC = 0x8F92EAB1
INDEX_MAGIC = 0x184D2A50
HAS_CHECKSUMS = 0x80
HEADER = struct.Struct("<II")
ENTRY = struct.Struct("<III")
FOOTER = struct.Struct("<IBI")


class FrameWriter:
    """Writes frames one by one; only the table, 12 bytes a frame, stays in memory."""

    def __init__(self, out, level: int = 3):
        self.out = out
        self.packer = zstandard.ZstdCompressor(level=level, write_checksum=True)
        self.entries: list[tuple[int, int, int]] = []

    def frame(self, data: bytes) -> int:
        """Write one frame and return its number."""
        packed = self.packer.compress(data)
        self.out.write(packed)
        self.entries.append((len(packed), len(data), xxhash.xxh64_intdigest(data) & 0xFFFFFFFF))
        return len(self.entries) - 1

    def finish(self, index: bytes) -> None:
        """Write the index and the seek table."""
        packed = self.packer.compress(index)
        self.out.write(HEADER.pack(INDEX_MAGIC, len(packed)) + packed)
        check = xxhash.xxh64_intdigest(b"") & 0xFFFFFFFF
        self.entries.append((HEADER.size + len(packed), 0, check))
        body = b"".join(ENTRY.pack(*e) for e in self.entries)
        body += FOOTER.pack(len(self.entries), HAS_CHECKSUMS, FOOTER_MAGIC)
        self.out.write(HEADER.pack(TABLE_MAGIC, len(body)) + body)


class FrameReader:
    """Reads single frames of a file open for random access, checking each against the table."""

    def __init__(self, source):
        self.source = source
        size = source.size()
        n, flags, magic = FOOTER.unpack(self._at(size - FOOTER.size, FOOTER.size))
        if magic != FOOTER_MAGIC or not flags & HAS_CHECKSUMS:
            raise ValueError("no seek table with checksums at the end of the file")
        table = self._at(size - FOOTER.size - n * ENTRY.size, n * ENTRY.size)
        self.entries = list(ENTRY.iter_unpack(table))
        self.starts = [0, *accumulate(e[0] for e in self.entries)]
        self.frames = n - 1
        self.read_frames = 0

    def _at(self, offset: int, length: int) -> bytes:
        self.source.seek(offset)
        data = self.source.read(length)
        if len(data) != length:
            raise ValueError("the file ends early")
        return data

    def frame(self, number: int) -> bytes:
        packed, plain, check = self.entries[number]
        data = zstandard.ZstdDecompressor().decompress(self._at(self.starts[number], packed), plain)
        if len(data) != plain or xxhash.xxh64_intdigest(data) & 0xFFFFFFFF != check:
            raise ValueError(f"frame {number} does not match its checksum")
        self.read_frames += 1
        return data

    def index(self) -> bytes:
        packed = self._at(self.starts[-2] + HEADER.size, self.entries[-1][0] - HEADER.size)
        return zstandard.ZstdDecompressor().decompress(packed)

import zlib

import numpy as np
import public_tokenizers as P
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from cellweave.llm import token_files
from cellweave.llm.common import filesystem, keep, scratch
from cellweave.llm.seekable import FrameReader, FrameWriter
from helpers_llm import documents, odd_documents

BYTE = P.path("byte_bpe_50k.json")


def expected_rows(rows):
    library = Tokenizer.from_file(BYTE)
    encoded = []
    for doc_id, text in rows:
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 2]
        encoded.append((doc_id, len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes())))
    return encoded


def test_ids_round_trip_in_ascending_order(spark):
    rows = odd_documents()
    found = token_files.token_files(documents(spark, rows), BYTE, 2, frame_tokens=1000).collect()
    assert sorted([(r.doc_id, r.n_tokens, r.ids_crc32) for r in found], key=repr) == sorted(expected_rows(rows), key=repr)
    by_start = sorted(found, key=lambda r: r.start)
    assert [r.start for r in by_start] == np.cumsum([0] + [r.n_tokens for r in by_start])[:-1].tolist()
    ids = [r.doc_id for r in by_start]
    assert ids == sorted(ids, key=lambda i: (i is not None, i))


def test_empty_table(spark):
    assert token_files.token_files(documents(spark, []), BYTE, 2).count() == 0


def test_reader_decompresses_only_the_frames_of_a_document(spark):
    rows = [(i, f"text number {i} " * 300) for i in range(40)]
    folder = scratch(spark, "tokens")
    manifest = keep(token_files.write_token_files(documents(spark, rows).repartition(1), folder, BYTE, 2, 500), "manifest")
    name = manifest.collect()[0].file
    system, root = filesystem(folder)
    with system.open_input_file(f"{root}/{name}") as source:
        shard = token_files.ShardReader(source)
        wanted = int(shard.doc_ids[len(shard.doc_ids) // 2])
        ids = shard.document(wanted)
        assert shard.frames.read_frames <= len(ids) // 500 + 2 < shard.frames.frames
        assert ids.tolist() == [*Tokenizer.from_file(BYTE).encode(dict(rows)[wanted]).ids, 2]
        with pytest.raises(KeyError):
            shard.document(10_000)


def test_damage_is_found():
    sink = pa.BufferOutputStream()
    writer = FrameWriter(sink)
    writer.frame(b"first" * 100)
    writer.frame(b"second" * 100)
    writer.finish(b"index")
    data = bytearray(sink.getvalue().to_pybytes())
    reader = FrameReader(pa.BufferReader(bytes(data)))
    assert (reader.frame(1), reader.index(), reader.frames) == (b"second" * 100, b"index", 2)
    data[reader.starts[1] + 12] ^= 0xFF
    with pytest.raises(Exception):
        FrameReader(pa.BufferReader(bytes(data))).frame(1)
    with pytest.raises(ValueError):
        FrameReader(pa.BufferReader(bytes(data[:-3])))

import base64
import hashlib

import pytest

from cellweave.llm import warc
from cellweave.llm.common import filesystem, keep, scratch

PAGES = "page_id long, url string, html string, digest int, response string, file string"


def pages(spark, rows):
    return spark.createDataFrame([(*r, 1, "x", "y") for r in rows], PAGES).repartition(3)


ROWS = [
    (1, "http://a.com/x", "<p>one</p>"), (2, "http://a.com/ä b\r\nX: y", "<p>one</p>"), (3, None, None), (4, "", ""),
    (5, "http://b.com", "long " * 100_000), (6, "http://b.com/2", "WARC/1.1\r\n\r\nContent-Length: 3\r\n\r\n"),
    (7, "http://c.com", "<p>one</p>"), (8, "http://c.com", "ü€👍"), (8, "http://c.com", "ü€👍"), (8, "http://c.com", "other"),
    (None, "http://d.com", "<p>one</p>"), (None, "http://d.com", "only without id"), (None, "http://d.com", "only without id"),
]


def expected(rows):
    result, seen = [], set()
    best = {}
    for page_id, _, html in rows:
        key = html or ""
        best[key] = max(best.get(key, warc.NO_ID), warc.NO_ID if page_id is None else page_id)
    for page_id, _, html in rows:
        payload = (html or "").encode()
        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        own = warc.NO_ID if page_id is None else page_id
        first = best[html or ""] == own and (own, digest) not in seen
        seen.add((own, digest))
        refers_to = None if first or best[html or ""] == warc.NO_ID else best[html or ""]
        result.append((page_id, len(payload), digest, "response" if first else "revisit", refers_to))
    return result


def test_records_round_trip(spark):
    result = warc.archives(pages(spark, ROWS))
    assert result.columns == ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    assert sorted(map(tuple, result.collect()), key=repr) == sorted(expected(ROWS), key=repr)


def test_small_payloads_are_all_responses(spark):
    found = {r.page_id: r.record_type for r in warc.archives(pages(spark, ROWS[:5]), min_bytes=11).collect()}
    assert set(found.values()) == {"response"}


def test_empty_table(spark):
    assert warc.archives(pages(spark, [])).count() == 0


def test_one_record_is_read_from_one_frame(spark):
    rows = [(i, f"http://h.com/{i}", f"page {i} " * 400) for i in range(60)]
    folder = scratch(spark, "archives")
    manifest = keep(warc.write_archives(pages(spark, rows), folder, frame_bytes=8000), "manifest")
    assert sum(r.n_records for r in manifest.collect()) == 60
    system, root = filesystem(folder)
    found = set()
    for row in manifest.collect():
        with system.open_input_file(f"{root}/{row.file}") as source:
            reader = warc.BundleReader(source)
            names = [line.split("\t")[0] for line in reader.frames.index().decode().split("\n")]
            fields, block = reader.record(names[-1])
            assert reader.frames.read_frames == 1
            page_id = warc.page_of(names[-1])
            assert block.endswith(f"page {page_id} ".encode() * 400) and fields["WARC-Target-URI"] == f"http://h.com/{page_id}"
            found |= set(names)
            with pytest.raises(KeyError):
                reader.record("urn:page:none")
    assert len(found) == 60


def test_record_ids_are_unique_and_revisits_name_a_response(spark):
    """Rows of one page id, null included, with different payloads lie in different files."""
    rows = [(1 + i % 2 if i % 3 else None, "http://a.com", f"payload {i % 7}") for i in range(120)]
    folder = scratch(spark, "archives")
    manifest = keep(warc.write_archives(pages(spark, rows), folder), "manifest")
    system, root = filesystem(folder)
    named, referred, read = {}, set(), 0
    for row in manifest.collect():
        with system.open_input_file(f"{root}/{row.file}") as source:
            reader = warc.BundleReader(source)
            for fields, block in reader.records():
                name = fields["WARC-Record-ID"].strip("<>")
                assert reader.record(name) == (fields, block)
                named[name] = (fields["WARC-Type"], fields["WARC-Payload-Digest"])
                referred |= {(fields["WARC-Refers-To"].strip("<>"), fields["WARC-Payload-Digest"])} if "WARC-Refers-To" in fields else set()
                read += 1
    assert read == len(named) == 120 and len(referred) == 7
    assert all(named[name] == ("response", digest) for name, digest in referred)


def test_wrong_payload_is_refused():
    record = warc.make_record("urn:page:1", "http://a.com", b"payload", "2025-01-01T00:00:00Z", None)
    fields, block = next(warc.parse_records(record))
    with pytest.raises(ValueError):
        warc._described(fields, block.replace(b"payload", b"Payload"))
    with pytest.raises(ValueError):
        list(warc.parse_records(record[:-4] + b"and more\r\n\r\n"))

import hashlib
import struct

import pytest
import zstandard

from stockwave.llm import warc
from stockwave.session import scratch_path

SCHEMA = "page_id long, url string, html string, digest string, first string"


def brute(rows):
    payloads = {}
    for page_id, _, html in rows:
        data = (html or "").encode()
        if page_id is not None:
            payloads[data] = min(payloads.get(data, page_id), page_id)
    out = []
    seen = set()
    for page_id, _, html in rows:
        data = (html or "").encode()
        first = payloads.get(data)
        again = (page_id, data) in seen
        seen.add((page_id, data))
        revisit = len(data) >= 100 and first is not None and (page_id != first or again)
        out.append((page_id, len(data), hashlib.sha256(data).hexdigest(), "revisit" if revisit else "response", first if revisit else None))
    return sorted(out, key=str)


def pages(n):
    body = "<html><body>" + "<p>shared boilerplate of every page</p>" * 4
    rows = [(i, f"http://h/{i}\r\nX: y", f"{body}{'é' * (i % 7)}{i % (n // 2)}") for i in range(n)]
    return rows + [(1000, None, None), (1001, "u", ""), (1002, "u", "short"), (1003, "u", "short"), (None, "u", rows[0][2]), (None, None, "z" * 500), (1004, "u", "퟿\r\n\r\n" + "x" * 100), (5, "u", rows[5][2]), (1005, "big", "y " * 300_000)]


@pytest.fixture(scope="module")
def written(spark):
    rows = pages(300)
    df = spark.createDataFrame([(*r, "a", "b") for r in rows], SCHEMA).repartition(4)
    path = scratch_path(spark, "warc-test")
    warc.write_archives(df, path, named=True)
    return rows, path


def test_round_trip(spark, written):
    rows, path = written
    found = warc.read_archives(spark, path)
    got = found.select(warc.page_of("record_id").alias("p"), "payload_bytes", "payload_digest", "record_type", warc.page_of("refers_to").alias("r")).collect()
    assert sorted(map(tuple, got), key=str) == brute(rows)
    texts = {(r.record_id.split(":")[2], r.payload_digest): r.payload for r in found.where("record_type = 'response'").collect()}
    for page_id, _, html in rows:
        data = (html or "").encode()
        key = ("" if page_id is None else str(page_id), hashlib.sha256(data).hexdigest())
        assert key not in texts or bytes(texts[key]) == data


def test_archives_start_with_their_dictionary(spark, written, tmp_path):
    content = [bytes(r.content) for r in spark.read.format("binaryFile").load(written[1]).where("length > 0 and path like '%.warc.zst'").collect()]
    assert content
    for data in content:
        magic, size = struct.unpack_from("<II", data)
        assert magic == 0x184D2A5D
        words = zstandard.ZstdCompressionDict(zstandard.ZstdDecompressor().decompress(data[8 : 8 + size]))
        assert words.dict_id() != 0
        reader = zstandard.ZstdDecompressor(dict_data=words).stream_reader(data, read_across_frames=True)
        text = reader.read()
        assert text.count(b"WARC/1.1\r\nWARC-Type: ") >= 1 and text.endswith(b"\r\n\r\n")


def test_damage_is_found(spark):
    with pytest.raises(ValueError, match="damaged"):
        warc.parse(warc.record(1, "u", b"abc", "0" * 64, None, 0, warc.WARC_DATE))


def test_headers_stay_on_their_line():
    made = warc.record(1, "http://x/\r\nWARC-Type: fake", b"", hashlib.sha256(b"").hexdigest(), None, 0, warc.WARC_DATE)
    assert made.count(b"\r\nWARC-Type:") == 1


def test_small_and_empty_tables(spark):
    for rows in ([], [(1, "u", "x" * 200)]):
        path = scratch_path(spark, "warc-test")
        warc.write_archives(spark.createDataFrame([(*r, "a", "b") for r in rows], SCHEMA), path)
        assert warc.read_archives(spark, path).count() == len(rows)


def test_string_ids(spark):
    long = "<html>" + "x" * 200
    rows = [("b:1", "u", long), ("a/é %2B+>", "u", long), ("", "u", "short"), (None, "u", long), ("7", None, None)]
    path = scratch_path(spark, "warc-test")
    warc.write_archives(spark.createDataFrame(rows, "page_id string, url string, html string"), path)
    found = warc.read_archives(spark, path).select(warc.page_of("record_id", "string").alias("p"), "record_type", warc.page_of("refers_to", "string").alias("r")).collect()
    want = [("b:1", "revisit", "a/é %2B+>"), ("a/é %2B+>", "response", None), ("", "response", None), (None, "revisit", "a/é %2B+>"), ("7", "response", None)]
    assert sorted(map(tuple, found), key=str) == sorted(want, key=str)


def test_number_of_archives():
    """Full archives for much data, several a core for little, none beyond the least size; empty records count too."""
    assert warc.n_archives(0, 8) == 1 and warc.n_archives(20_000_000, 8) == 2
    assert warc.n_archives(1_000_000_000, 8) == 32
    assert warc.n_archives(100 * 10**12, 4000) == 781_250


def test_several_archives_without_names(spark, monkeypatch):
    monkeypatch.setattr(warc, "LEAST_ARCHIVE_BYTES", 10_000)
    rows = pages(300)
    path = scratch_path(spark, "warc-test")
    warc.write_archives(spark.createDataFrame([(*r, "a", "b") for r in rows], SCHEMA), path)
    listed = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("path").collect()
    assert len(listed) > 4 and not any(r.path.endswith(".warc.zst") for r in listed)
    found = warc.read_archives(spark, path, with_payload=False)
    got = found.select(warc.page_of("record_id").alias("p"), "payload_bytes", "payload_digest", "record_type", warc.page_of("refers_to").alias("r")).collect()
    assert sorted(map(tuple, got), key=str) == brute(rows)

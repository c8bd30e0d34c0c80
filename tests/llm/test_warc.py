import base64
import hashlib
import io
import struct

import zstandard
from pyspark.sql import functions as F

from ledgerflow.llm import warc
from ledgerflow.session import scratch_path

PAGES = "page_id bigint, url string, html string"


def brute(rows):
    largest = {}
    for i, _, html in rows:
        largest[html or ""] = max(largest.get(html or "", i), i)
    out = {}
    for i, _, html in rows:
        raw, top = (html or "").encode(), largest[html or ""]
        out[warc.page_urn(i)] = (len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode(),
                                 "response" if i == top else "revisit", None if i == top else warc.page_urn(top))
    return out


def test_round_trip(spark):
    rows = [(i, f"http://h{i}/ä b\r\nX: 1", f"<p>page {i % 7} é</p>" * (i % 11 + 1)) for i in range(300)]
    rows += [(900, None, None), (901, "u", ""), (902, "u", None), (903, "u", "x" * 3_000_000)]
    df = spark.createDataFrame(rows, PAGES).repartition(4).withColumn("payload", F.lit(1)).withColumn("sha1", F.lit(2))
    found = warc.roundtrip(df).collect()
    assert len(found) == len(rows) and all(r.error is None for r in found)
    assert {r.record_id: (r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in found} == brute(rows)
    assert warc.roundtrip(df.filter("false")).count() == 0


def test_null_and_repeated_ids(spark):
    rows = [(None, "u", "same"), (4, "u", "same"), (4, "v", "same"), (None, "u", "alone")]
    found = sorted((r.record_id, r.record_type, r.refers_to or "") for r in
                   warc.roundtrip(spark.createDataFrame(rows, PAGES)).collect())
    assert found == [("<urn:page:4>", "response", ""), ("<urn:page:4>", "response", ""),
                     ("<urn:page:none>", "response", ""), ("<urn:page:none>", "revisit", "<urn:page:4>")]


def test_payloads_and_archive_layout(spark):
    rows = [(i, "http://x/", f"<html>{i} some repeated markup</html>" * 5) for i in range(400)]
    folder = scratch_path(spark, "warc-test")
    marked = warc.mark_revisits(spark.createDataFrame(rows, PAGES).coalesce(1))
    manifest = warc.write_archives(marked, folder)
    got = {r.record_id: bytes(r.payload) for r in warc.read_archives(spark, manifest).collect()}
    assert got == {warc.page_urn(i): html.encode() for i, _, html in rows}
    system, path = warc._filesystem(manifest.first().archive)
    raw = system.open_input_stream(path).read()
    assert struct.unpack("<I", raw[:4])[0] == warc.DICTIONARY_MAGIC
    trained = zstandard.ZstdCompressionDict(raw[8:8 + struct.unpack("<I", raw[4:8])[0]])
    reader = zstandard.ZstdDecompressor(dict_data=trained).stream_reader(raw[8 + len(trained.as_bytes()):],
                                                                         read_across_frames=True)
    assert reader.read().count(b"WARC/1.1\r\n") == 400


def frames(*records, dictionary=None, tail=b""):
    packed = b"".join(zstandard.ZstdCompressor(dict_data=dictionary).compress(r) for r in records)
    return [r for r in warc._frames(io.BytesIO(packed + tail))]


def test_damaged_frames_and_records():
    good = warc.build_record(1, "http://x/", b"payload", None, False)
    assert frames(good, good) == [good, good]
    assert frames(good, tail=b"not a frame") == [good, None]
    cut = zstandard.ZstdCompressor().compress(good)[:-3]
    assert list(warc._frames(io.BytesIO(cut))) == [None]
    assert list(warc._frames(io.BytesIO(b""))) == []
    assert warc.parse_record(good)["payload"] == b"payload"
    for old, new, error in ((b"WARC/1.1", b"WARC/9", "no WARC header"), (b"payload\r\n", b"payl\r\n", "content length"),
                            (b"payload\r\n", b"PAYLOAD\r\n", "payload digest"),
                            (b"WARC-Date: ", b"X-Date: ", "header missing"), (b"WARC-Type:", b"WARC-Type", "header line"),
                            (b"WARC-Type: response", b"WARC-Type: revisit", "revisit with a payload")):
        assert warc.parse_record(good.replace(old, new))["error"].startswith(error)


def test_compressed_dictionary():
    samples = [f"<html>{i} common markup {i * 7}</html>".encode() * 3 for i in range(500)]
    trained = zstandard.train_dictionary(2048, samples)
    body = zstandard.ZstdCompressor().compress(trained.as_bytes())
    record = warc.build_record(1, None, samples[0], None, False)
    archive = struct.pack("<II", warc.DICTIONARY_MAGIC, len(body)) + body + zstandard.ZstdCompressor(
        dict_data=trained).compress(record)
    assert list(warc._frames(io.BytesIO(archive))) == [record]

"""WARC archives compressed with Zstandard: writer, reader, revisit records.

An archive starts with a skippable frame that holds a Zstandard dictionary
trained on its first records (left out where there is too little to train
on), followed by one frame per WARC/1.1 record.  The reader loads the
dictionary from that frame, decodes one frame per record as it streams
through the file, and checks the version line, the mandatory headers, the
content length, the record's end and the payload digest.  A damaged record
gives a row with ``error`` set; so does what follows an unreadable frame,
as one row.

Files: each task writes archives of bounded size into one shared folder,
under names that hold its task attempt; only archives named in the
manifest, which Spark commits, count, so a lost or repeated task leaves
unread files and no wrong rows.  Archives are opened with Arrow's file
systems, on the executors; records are streamed, never a whole archive.

Revisits: of pages with equal payloads the one with the largest page_id is
the response.  Defined results: a null html is an empty payload; a null
page_id sorts before all others and has null in ``refers_to`` of its
revisits; rows that repeat the largest page_id are all responses; a null
URL leaves the target header out; an empty table gives no archive and no
rows.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from .common import small_batches, stage, trimmed

DICTIONARY_MAGIC = 0x184D2A5D        # skippable frame that holds the dictionary
FRAME_MAGIC = 0xFD2FB528
ARCHIVE_BYTES = 64 << 20             # payload bytes after which an archive is closed
SAMPLE_RECORDS, SAMPLE_BYTES = 200, 2 << 20
DICTIONARY_BYTES = 16 << 10
READ = 1 << 20
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2024-01-01T00:00:00Z"
MANDATORY = ("warc-type", "warc-record-id", "warc-date", "content-length")

MANIFEST = "archive string, records bigint, bytes bigint"
RECORDS = ("archive string, record_type string, record_id string, target_uri string, payload_bytes bigint, "
           "payload_digest string, refers_to string, payload binary, error string")


def digest_of(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def page_urn(page_id: int | None) -> str:
    return f"<urn:page:{'none' if page_id is None else page_id}>"


def _filesystem(uri: str):
    """(file system, path) of a shared URI."""
    from pyarrow import fs

    if uri.startswith("file:"):
        uri = "file:///" + uri[len("file:"):].lstrip("/")
    return fs.FileSystem.from_uri(uri)


def build_record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None,
                 revisit: bool) -> bytes:
    """One WARC record, response or revisit; a revisit has no payload of its own."""
    http = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
            f"Content-Length: {len(payload)}\r\n\r\n").encode()
    block = http if revisit else http + payload
    lines = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}",
             f"WARC-Record-ID: {page_urn(page_id)}", f"WARC-Date: {DATE}"]
    if url is not None:
        lines.append("WARC-Target-URI: " + quote(url, safe="!#$%&'()*+,/:;=?@[]~-._"))
    lines.append(f"WARC-Payload-Digest: sha1:{digest_of(payload)}")
    if revisit:
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {page_urn(refers_to)}"]
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _dictionary(samples: list[bytes]):
    import zstandard

    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples)
    except zstandard.ZstdError:
        return None


class _Archive:
    """Writes one archive; the first records wait until the dictionary is trained."""

    def __init__(self, uri: str):
        self.uri, self.waiting, self.payload, self.records, self.bytes = uri, [], 0, 0, 0
        self.out = self.compressor = None

    def add(self, record: bytes) -> None:
        self.payload += len(record)
        self.records += 1
        if self.out is not None:
            self._put(self.compressor.compress(record))
            return
        self.waiting.append(record)
        if len(self.waiting) >= SAMPLE_RECORDS or self.payload >= SAMPLE_BYTES:
            self._open()

    def _open(self) -> None:
        import zstandard

        system, path = _filesystem(self.uri)
        self.out = system.open_output_stream(path)
        trained = _dictionary(self.waiting)
        if trained is not None:
            body = trained.as_bytes()
            self._put(struct.pack("<II", DICTIONARY_MAGIC, len(body)) + body)
        self.compressor = zstandard.ZstdCompressor(level=3, dict_data=trained, write_content_size=True)
        for record in self.waiting:
            self._put(self.compressor.compress(record))
        self.waiting = []

    def _put(self, data: bytes) -> None:
        self.out.write(data)
        self.bytes += len(data)

    def close(self) -> pa.RecordBatch:
        if self.out is None:
            self._open()
        self.out.close()
        return pa.RecordBatch.from_pydict({"archive": [self.uri], "records": [self.records],
                                           "bytes": [self.bytes]})


def mark_revisits(pages: DataFrame, id_col: str = "page_id", url_col: str = "url",
                  html_col: str = "html") -> DataFrame:
    """(page_id, url, payload, response_id, revisit) of every page."""
    small_batches(pages.sparkSession)
    payload = F.coalesce(F.col(html_col), F.lit("")).cast("binary")
    rows = pages.select(F.col(id_col).cast("bigint").alias("page_id"), F.col(url_col).alias("url"),
                        payload.alias("payload"), F.sha1(payload).alias("sha1"))
    shared = stage(rows.groupBy("sha1").agg(F.max("page_id").alias("response_id"), F.count("*").alias("n"))
                   .filter("n > 1").select(F.col("sha1").alias("same"), "response_id"), "warc-shared")
    joined = rows.join(shared, F.col("sha1") == F.col("same"), "left")
    revisit = F.col("same").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("response_id"))
    return joined.select("page_id", "url", "payload", "response_id", revisit.alias("revisit"))


def write_archives(marked: DataFrame, folder: str) -> DataFrame:
    """Write ``mark_revisits`` rows as archives under ``folder``; the staged manifest."""
    def run(batches):
        from pyspark import TaskContext

        context, part = TaskContext.get(), 0
        name = f"{folder}/pages-{context.partitionId():06d}-{context.taskAttemptId()}"
        archive = None
        for batch in batches:
            for page_id, url, payload, response_id, revisit in zip(*[c for c in batch.columns]):
                if archive is None:
                    archive, part = _Archive(f"{name}-{part:04d}.warc.zst"), part + 1
                archive.add(build_record(page_id.as_py(), url.as_py(), payload.as_py(),
                                         response_id.as_py(), revisit.as_py()))
                if archive.payload >= ARCHIVE_BYTES:
                    yield archive.close()
                    archive = None
        if archive is not None:
            yield archive.close()

    spark = marked.sparkSession
    # The folder must exist before executors open files in it.
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(path)
    return stage(marked.mapInArrow(trimmed(run), MANIFEST), "warc-manifest")


def _frames(stream) -> Iterator[bytes | None]:
    """Decoded frames of an archive in order; None where the rest can't be decoded."""
    import zstandard

    data, trained = stream.read(8), None
    if len(data) == 8 and struct.unpack("<I", data[:4])[0] == DICTIONARY_MAGIC:
        body = stream.read(struct.unpack("<I", data[4:])[0])
        if body[:4] == struct.pack("<I", FRAME_MAGIC):     # the dictionary itself may be compressed
            body = zstandard.ZstdDecompressor().decompress(body, max_output_size=1 << 26)
        trained, data = zstandard.ZstdCompressionDict(body), b""
    reader = zstandard.ZstdDecompressor(dict_data=trained)
    data = data or stream.read(READ)
    while data:
        frame, decoded = reader.decompressobj(), []
        try:
            while True:
                decoded.append(frame.decompress(data))
                if frame.eof:
                    data = frame.unused_data
                    break
                data = stream.read(READ)
                if not data:
                    yield None
                    return
        except zstandard.ZstdError:
            yield None
            return
        yield b"".join(decoded)
        data = data or stream.read(READ)


def parse_record(raw: bytes) -> dict:
    """Fields of one decoded record; ``error`` says what is wrong with it."""
    out = dict.fromkeys(("record_type", "record_id", "target_uri", "payload_bytes", "payload_digest",
                         "refers_to", "payload", "error"))
    head, mark, rest = raw.partition(b"\r\n\r\n")
    lines = head.split(b"\r\n")
    if not mark or lines[0] not in (b"WARC/1.0", b"WARC/1.1"):
        return out | {"error": "no WARC header"}
    try:
        pairs = [line.decode("utf-8").split(":", 1) for line in lines[1:]]
        headers = {name.strip().lower(): value.strip() for name, value in pairs}
    except ValueError:
        return out | {"error": "header line without a name or not UTF-8"}
    out |= {"record_type": headers.get("warc-type"), "record_id": headers.get("warc-record-id"),
            "target_uri": headers.get("warc-target-uri"), "refers_to": headers.get("warc-refers-to")}
    if missing := [name for name in MANDATORY if name not in headers]:
        return out | {"error": f"header missing: {missing[0]}"}
    length = headers["content-length"]
    if not length.isdecimal() or len(rest) != int(length) + 4 or rest[-4:] != b"\r\n\r\n":
        return out | {"error": "content length differs from the block"}
    http, mark, payload = rest[:-4].partition(b"\r\n\r\n")
    if not mark:
        return out | {"error": "no HTTP header"}
    stated = next((line.split(b":", 1)[1].strip() for line in http.split(b"\r\n")[1:]
                   if line.lower().startswith(b"content-length:")), b"")
    out["payload_digest"] = headers.get("warc-payload-digest", "").removeprefix("sha1:") or None
    if not stated.isdigit():
        return out | {"error": "payload length missing"}
    out["payload_bytes"] = int(stated)
    if out["record_type"] == "revisit":
        return out | ({"error": "revisit with a payload"} if payload else {})
    if len(payload) != int(stated):
        return out | {"error": "payload length differs"}
    if digest_of(payload) != out["payload_digest"]:
        return out | {"error": "payload digest differs"}
    return out | {"payload": payload}


def read_archives(spark: SparkSession, manifest: DataFrame, payloads: bool = True) -> DataFrame:
    """One row per record of the archives named in ``manifest.archive``."""
    fields = [name.split()[0] for name in RECORDS.split(", ")]
    schema = spark.createDataFrame([], RECORDS).schema

    def run(batches):
        arrow = pa.schema([(f, pa.binary() if f == "payload" else pa.int64() if f == "payload_bytes"
                            else pa.string()) for f in fields])
        for batch in batches:
            for uri in batch.column(0).to_pylist():
                system, path = _filesystem(uri)
                rows, size = [], 0
                with system.open_input_stream(path) as stream:
                    for raw in _frames(stream):
                        row = parse_record(raw) if raw is not None else {"error": "frame can't be decoded"}
                        if not payloads:
                            row["payload"] = None
                        rows.append(row | {"archive": uri})
                        size += len(row.get("payload") or b"")
                        if len(rows) >= 1000 or size >= READ:
                            yield pa.RecordBatch.from_pylist(rows, arrow)
                            rows, size = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, arrow)

    archives = manifest.select("archive")
    return archives.repartition(max(1, min(archives.count(), 10_000))).mapInArrow(trimmed(run), schema)


def roundtrip(pages: DataFrame) -> DataFrame:
    """Write ``pages`` to archives in the shared scratch folder and read the records back."""
    spark = pages.sparkSession
    manifest = write_archives(mark_revisits(pages), scratch_path(spark, "warc"))
    return read_archives(spark, manifest, payloads=False)

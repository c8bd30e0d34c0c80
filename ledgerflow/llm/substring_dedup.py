"""Exact substring deduplication with fixed-block anchors.

A window is ``WINDOW`` consecutive words of one text.  A word goes when a
window that covers it also starts earlier, in a text with a smaller id or
earlier in the same text.

1. Texts are packed, whole, into chunks of about ``CHUNK`` bytes.
2. The reference blocks of a text are its non-overlapping runs of ``BLOCK``
   words.  They are indexed by hash and probed with every rolling window
   of ``BLOCK`` words of every text: per chunk, each distinct hash is sent
   once, as four bytes, to the bucket of its hash.  A bucket answers a
   chunk with those of its blocks that occur elsewhere.  Any window of
   2 * BLOCK - 1 or more words holds a whole block, so a repeated window
   holds only blocks that were hit.
3. Runs of hit blocks are extended to every window they allow.  Those
   candidates are compared exactly, by 64-bit window hash: per chunk the
   earliest place of each goes to the bucket of its hash, which answers
   chunks whose earliest place is not the first of all.  Consecutive
   repeated windows make up the maximal repeats, whose words go.

Only texts with a hit block travel to the third step.  A passage in any
number of texts costs one entry per chunk that holds it, and buckets are
sized by words, so no key gathers a share of the rows.  The four-byte
entries may add candidates, which step 3 discards, and lose none.

Defined results: a null or blank text has no words.  Fewer than ``WINDOW``
words: nothing is removed.  Rows that share an id count as one text's
places, ties remove nothing.  A null id comes after all others.  Other
columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import small_batches, stage, text_or_empty, trimmed
from .texthash import documents, windows

WINDOW = 20
BLOCK = 10
CHUNK = 2 << 20
FLUSH = 2_000_000          # words whose entries a task holds before sending them
BUCKET_BYTES = 12 << 20    # text bytes a bucket stands for
LEAST_BUCKETS = 64
_REST = np.uint64((1 << 30) - 1)
_LAST_ID = np.iinfo(np.int64).max

RESULT = "doc_id bigint, n_words bigint, n_removed bigint, kept_sha256 string"


# -- chunks -----------------------------------------------------------------

def _pack(ids: pa.Array, texts: pa.Array) -> bytes:
    batch = pa.RecordBatch.from_arrays([ids, texts.cast(pa.large_string())], names=["doc_id", "text"])
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_batch(batch)
    return sink.getvalue().to_pybytes()


def _unpack(body: bytes) -> pa.RecordBatch:
    table = pa.ipc.open_stream(body).read_all().combine_chunks()
    return table.to_batches()[0]


def _chunks(docs: DataFrame) -> DataFrame:
    """(chunk, bytes, body): consecutive rows of a task, packed and compressed."""
    def run(batches):
        from pyspark import TaskContext

        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            sizes = np.cumsum([len(t.as_buffer()) if t.is_valid else 0 for t in batch.column(1)])
            at, done = 0, 0
            while at < batch.num_rows:
                end = max(at + 1, int(np.searchsorted(sizes, done + CHUNK, side="right")))
                part = batch.slice(at, end - at)
                yield pa.RecordBatch.from_pydict({
                    "chunk": pa.array([number], pa.int64()), "bytes": pa.array([int(sizes[end - 1]) - done]),
                    "body": pa.array([_pack(part.column(0), part.column(1))], pa.binary())})
                number, at, done = number + 1, end, int(sizes[end - 1])

    return docs.mapInArrow(trimmed(run), "chunk bigint, bytes bigint, body binary")


# -- step 2: reference blocks and rolling probes ----------------------------

def _split(hashes: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """(bucket, 30-bit rest) of block hashes."""
    return ((hashes >> np.uint64(32)) % np.uint64(buckets)).astype(np.int64), hashes & _REST


def _probes(chunks: DataFrame, buckets: int) -> DataFrame:
    """(bucket, chunk, entries): rest << 2 | repeated in the chunk << 1 | is a block."""
    def send(held: list, names: list[int]):
        code = np.sort(np.concatenate(held))
        value = code >> np.uint64(1)
        first = np.flatnonzero(np.concatenate(([True], value[1:] != value[:-1])))
        last = np.append(first[1:], len(code)) - 1
        value = value[first]
        entry = (((value & _REST) << np.uint64(2)) | ((last > first).astype(np.uint64) << np.uint64(1))
                 | (code[last] & np.uint64(1))).astype(np.uint32)
        key = (value >> np.uint64(30)).astype(np.int64)
        starts = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
        ends = np.append(starts[1:], len(key))
        return pa.RecordBatch.from_pydict({
            "bucket": pa.array((key[starts] % buckets).astype(np.int32)),
            "chunk": pa.array(np.array(names, dtype=np.int64)[key[starts] // buckets]),
            "entries": pa.array([entry[a:b].tobytes() for a, b in zip(starts, ends)], pa.binary())})

    def run(batches):
        held, names, words = [], [], 0
        for batch in batches:
            for chunk, body in zip(batch.column(0).to_pylist(), batch.column(1)):
                for _, _, _, _, hashes in documents(_unpack(body.as_py()).column(1), lower=False):
                    if len(hashes) < WINDOW:
                        continue
                    bucket, rest = _split(windows(hashes, BLOCK), buckets)
                    code = ((len(names) * buckets + bucket).astype(np.uint64) << np.uint64(31)) | (rest << np.uint64(1))
                    code[::BLOCK] |= np.uint64(1)
                    held.append(code)
                    words += len(code)
                names.append(chunk)
                if words >= FLUSH:
                    yield send(held, names)
                    held, names, words = [], [], 0
        if held:
            yield send(held, names)

    return chunks.select("chunk", "body").mapInArrow(trimmed(run), "bucket int, chunk bigint, entries binary")


def _hits_of_bucket(frame: pd.DataFrame) -> pd.DataFrame:
    """(chunk, bucket, hits): rests of the chunk's blocks that occur elsewhere."""
    arrays = [np.frombuffer(e, dtype=np.uint32) for e in frame["entries"]]
    entries = np.concatenate(arrays)
    rest = entries >> np.uint32(2)
    order = np.sort(rest)
    repeated = np.unique(np.concatenate((order[1:][order[1:] == order[:-1]],
                                         rest[(entries & np.uint32(2)) > 0])))
    hit = ((entries & np.uint32(1)) > 0)
    at = np.minimum(np.searchsorted(repeated, rest), max(0, len(repeated) - 1))
    hit &= (repeated[at] == rest) if len(repeated) else False
    edges = np.cumsum([0] + [len(a) for a in arrays])
    found = [(chunk, rest[a:b][hit[a:b]].tobytes()) for chunk, a, b in
             zip(frame["chunk"], edges[:-1], edges[1:]) if hit[a:b].any()]
    return pd.DataFrame({"chunk": [c for c, _ in found], "bucket": frame["bucket"].iloc[0],
                         "hits": [h for _, h in found]})


# -- step 3: candidate windows ----------------------------------------------

def _candidates(hashes: np.ndarray, buckets: int, hits: np.ndarray) -> np.ndarray:
    """Which windows of one text hold hit blocks only; ``hits`` is sorted bucket << 30 | rest."""
    count = len(hashes) - WINDOW + 1
    if count <= 0 or not len(hits):
        return np.zeros(max(0, count), dtype=bool)
    bucket, rest = _split(windows(hashes, BLOCK)[::BLOCK], buckets)
    key = (bucket.astype(np.uint64) << np.uint64(30)) | rest
    hit = hits[np.minimum(np.searchsorted(hits, key), len(hits) - 1)] == key
    place = np.arange(count)
    lead = -(-place // BLOCK)                     # first block that begins in the window
    return hit[lead] & ((place % BLOCK != 0) | hit[np.minimum(lead + 1, len(hit) - 1)])


def _digest(words: bytes) -> str:
    return hashlib.sha256(words).hexdigest()


def _joined(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> bytes:
    raw = data.tobytes()
    return b" ".join([raw[a:b] for a, b in zip(starts.tolist(), ends.tolist())])


FIRST = ("kind int, doc_id bigint, n_words bigint, n_removed bigint, kept_sha256 string, "
         "bucket int, chunk bigint, body binary")


def _extend(buckets: int):
    """Cogroup function: one chunk and its hits -> finished texts, texts to finish, candidate entries."""
    def run(chunk: pd.DataFrame, hits: pd.DataFrame) -> pd.DataFrame:
        rows = []
        keys = [(np.uint64(b) << np.uint64(30)) | np.frombuffer(h, dtype=np.uint32).astype(np.uint64)
                for b, h in zip(hits["bucket"], hits["hits"])]
        keys = np.sort(np.concatenate(keys)) if keys else np.empty(0, dtype=np.uint64)
        for name, body in zip(chunk["chunk"], chunk["body"]):
            batch = _unpack(body)
            ids = _ids(batch)
            pending, found = [], []
            for row, data, starts, ends, hashes in documents(batch.column(1), lower=False):
                candidate = _candidates(hashes, buckets, keys)
                if candidate.any():
                    pending.append(row)
                    places = np.flatnonzero(candidate)
                    found.append((windows(hashes, WINDOW)[places], np.full(len(places), ids[row]), places))
                else:
                    rows.append((0, batch.column(0)[row].as_py(), len(hashes), 0,
                                 _digest(_joined(data, starts, ends)), None, None, None))
            if pending:
                rest = batch.take(pa.array(pending))
                rows.append((1, None, None, None, None, None, name, _pack(rest.column(0), rest.column(1))))
                h, who, where = (np.concatenate(x) for x in zip(*found))
                order = np.lexsort((where, who, h))
                first = order[np.concatenate(([True], h[order][1:] != h[order][:-1]))]
                h, who, where = h[first], who[first], where[first]
                bucket = (h >> np.uint64(32)) % np.uint64(buckets)
                for b in np.unique(bucket):
                    mine = bucket == b
                    rows.append((2, None, None, None, None, int(b), name,
                                 _entries(h[mine], who[mine], where[mine])))
        return pd.DataFrame(rows, columns=[c.split()[0] for c in FIRST.split(", ")]).astype(
            {"doc_id": "Int64", "n_words": "Int64", "n_removed": "Int64", "bucket": "Int64", "chunk": "Int64"})

    return run


def _ids(batch: pa.RecordBatch) -> np.ndarray:
    return batch.column(0).fill_null(_LAST_ID).to_numpy(zero_copy_only=False)


def _entries(h: np.ndarray, who: np.ndarray, where: np.ndarray) -> bytes:
    """Compressed (hash, id, place) columns."""
    import zstandard

    ids, at = np.unique(who, return_inverse=True)
    raw = b"".join([np.array([len(h), len(ids)], dtype=np.int64).tobytes(), h.tobytes(), ids.tobytes(),
                    at.astype(np.uint32).tobytes(), where.astype(np.uint32).tobytes()])
    return zstandard.ZstdCompressor(level=1).compress(raw)


def _read_entries(body: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    import zstandard

    raw = zstandard.ZstdDecompressor().decompress(body)
    n, k = np.frombuffer(raw, dtype=np.int64, count=2)
    h = np.frombuffer(raw, dtype=np.uint64, count=n, offset=16)
    ids = np.frombuffer(raw, dtype=np.int64, count=k, offset=16 + 8 * n)
    at = np.frombuffer(raw, dtype=np.uint32, count=n, offset=16 + 8 * (n + k))
    where = np.frombuffer(raw, dtype=np.uint32, count=n, offset=16 + 8 * (n + k) + 4 * n)
    return h, ids[at], where.astype(np.int64)


def _later_chunks(frame: pd.DataFrame) -> pd.DataFrame:
    """(chunk, later): hashes whose earliest place lies in another chunk."""
    parts = [_read_entries(b) for b in frame["body"]]
    edges = np.cumsum([0] + [len(p[0]) for p in parts])
    h, who, where = (np.concatenate(x) for x in zip(*parts))
    order = np.lexsort((where, who, h))
    fresh = np.concatenate(([True], h[order][1:] != h[order][:-1]))
    best = order[fresh][np.cumsum(fresh) - 1]                  # the first place of each entry's hash
    later = np.zeros(len(h), dtype=bool)
    later[order] = (who[order] != who[best]) | (where[order] != where[best])
    found = [(c, h[a:b][later[a:b]].tobytes()) for c, a, b in zip(frame["chunk"], edges[:-1], edges[1:])
             if later[a:b].any()]
    return pd.DataFrame({"chunk": pd.array([c for c, _ in found], dtype="Int64"), "later": [x for _, x in found]})


def _finish(chunk: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
    later = [np.frombuffer(x, dtype=np.uint64) for x in answers["later"]]
    later = np.sort(np.concatenate(later)) if later else np.empty(0, dtype=np.uint64)
    rows = []
    for body in chunk["body"]:
        batch = _unpack(body)
        ids = _ids(batch)
        texts = list(documents(batch.column(1), lower=False))
        hashes = [windows(t[4], WINDOW) for t in texts]
        h = np.concatenate(hashes)
        who = np.repeat(ids, [len(x) for x in hashes])
        where = np.concatenate([np.arange(len(x)) for x in hashes])
        order = np.lexsort((where, who, h))
        fresh = np.concatenate(([True], h[order][1:] != h[order][:-1]))
        best = order[fresh][np.cumsum(fresh) - 1]
        repeated = np.zeros(len(h), dtype=bool)
        repeated[order] = (who[order] != who[best]) | (where[order] != where[best])
        if len(later):
            repeated |= later[np.minimum(np.searchsorted(later, h), len(later) - 1)] == h
        at = 0
        for (row, data, starts, ends, words), own in zip(texts, hashes):
            places = np.flatnonzero(repeated[at:at + len(own)])
            at += len(own)
            edge = np.zeros(len(words) + 1, dtype=np.int64)
            np.add.at(edge, places, 1)
            np.add.at(edge, places + WINDOW, -1)
            keep = np.cumsum(edge)[:-1] == 0
            rows.append((batch.column(0)[row].as_py(), len(words), int((~keep).sum()),
                         _digest(_joined(data, starts[keep], ends[keep]))))
    return pd.DataFrame(rows, columns=["doc_id", "n_words", "n_removed", "kept_sha256"]).astype(
        {"doc_id": "Int64"})


def substring_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256), one row per document."""
    small_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), text_or_empty(text_col).alias("text"))
    chunks = stage(_chunks(rows), "substring-chunks")
    size = chunks.agg(F.sum("bytes")).first()[0] or 0
    buckets = max(LEAST_BUCKETS, -(-size // BUCKET_BYTES))
    hits = stage(_probes(chunks, buckets).groupBy("bucket").applyInPandas(
        _hits_of_bucket, "chunk bigint, bucket int, hits binary"), "substring-hits")
    first = stage(chunks.select("chunk", "body").groupBy("chunk").cogroup(hits.groupBy("chunk"))
                  .applyInPandas(_extend(buckets), FIRST), "substring-first")
    answers = (first.filter("kind = 2").select("bucket", "chunk", "body").groupBy("bucket")
               .applyInPandas(_later_chunks, "chunk bigint, later binary"))
    done = first.filter("kind = 0").select("doc_id", "n_words", "n_removed", "kept_sha256")
    last = (first.filter("kind = 1").select("chunk", "body").groupBy("chunk")
            .cogroup(answers.groupBy("chunk")).applyInPandas(_finish, RESULT))
    return done.unionByName(last)

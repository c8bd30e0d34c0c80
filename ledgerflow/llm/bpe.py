"""Byte-level BPE through a sentencepiece model serialised from a rank file.

The rank file (one base64 token and its rank a line) becomes a
sentencepiece BPE model without any training: every token's bytes are
mapped to printable characters, one to one, and the piece scores minus its
rank, so that merging the best-scored pair first is merging the lowest
rank first.  Normalisation is the identity.  A text is split by the
vocabulary's pattern, each pre-token is mapped and encoded by itself (one
that is a token as a whole is that token), and ids are decoded by mapping
their pieces' characters back to bytes.

Texts are handled whole, in pieces of about a million characters cut where
a pre-token must begin, so memory does not follow the length of a text.
The pre-token cache of a task is bounded.  The vocabulary's path is a
parameter; the file is read on the driver and its bytes (below 1 MB) travel
with the task.

Defined results: a null text counts as empty and has no ids.  Null ids
decode to empty bytes.  Rows come back one for one with all their other
columns untouched by the caller's choice of ``keep``.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import small_batches, trimmed

PIECE = 1 << 20        # characters
CACHE = 1 << 18        # pre-tokens remembered by a task
LONG = 64              # characters beyond which a pre-token is not remembered


def byte_alphabet() -> list[str]:
    """A printable character for every byte: itself where printable, else from U+0100 on."""
    printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = iter(range(0x100, 0x200))
    return [chr(b) if b in printable else chr(next(others)) for b in range(256)]


def read_ranks(path: str) -> list[bytes]:
    """Tokens in order of rank; ranks must run from 0 without gaps."""
    with open(path, "rb") as lines:
        pairs = [line.split() for line in lines if line.strip()]
    tokens = {int(rank): base64.b64decode(token) for token, rank in pairs}
    if sorted(tokens) != list(range(len(tokens))):
        raise ValueError("ranks must run from 0 without gaps")
    return [tokens[i] for i in range(len(tokens))]


def _varint(n: int) -> bytes:
    out = bytearray()
    while n > 0x7F:
        out.append(n & 0x7F | 0x80)
        n >>= 7
    return bytes(out + bytes([n]))


def _field(number: int, payload: bytes) -> bytes:
    return _varint(number << 3 | 2) + _varint(len(payload)) + payload


def _number(number: int, value: int) -> bytes:
    return _varint(number << 3) + _varint(value)


def sentencepiece_model(tokens: list[bytes]) -> bytes:
    """Serialised sentencepiece ModelProto; a piece's id is its token's rank."""
    alphabet = byte_alphabet()

    def piece(text: str, score: float, kind: int) -> bytes:
        return _field(1, _field(1, text.encode()) + b"\x15" + struct.pack("<f", score) + _number(3, kind))

    normal, unknown, bpe = 1, 2, 2      # enum values of the format
    body = b"".join(piece("".join(alphabet[b] for b in token), -float(rank), normal)
                    for rank, token in enumerate(tokens))
    body += piece("⁇", 0.0, unknown)          # outside the alphabet, never produced
    trainer = _number(3, bpe) + _number(4, len(tokens) + 1) + _number(40, len(tokens))
    normalizer = _field(1, b"identity") + _number(3, 0) + _number(4, 0) + _number(5, 0)
    return body + _field(2, trainer) + _field(3, normalizer)


class Codec:
    """Encoder and decoder of one vocabulary; made once per task."""

    def __init__(self, tokens: list[bytes], pattern: str):
        import regex
        import sentencepiece

        self.blank = regex.compile(r"\S ")
        self.pieces = sentencepiece.SentencePieceProcessor(model_proto=sentencepiece_model(tokens))
        self.pattern = regex.compile(pattern)
        alphabet = byte_alphabet()
        self.to_piece = dict(enumerate(alphabet))
        back = {c: b for b, c in enumerate(alphabet)}
        self.bytes_of = [bytes(back[c] for c in self.pieces.id_to_piece(i)) for i in range(len(tokens))]
        self.whole = {token: struct.pack("<I", rank) for rank, token in enumerate(tokens)}
        self.cache: dict[str, bytes] = {}
        self.misses = 0

    def _pre_tokens(self, text: str) -> Iterator[list[str]]:
        """Pre-tokens in order, a bounded stretch of the text at a time."""
        at = 0
        while at < len(text):
            end = len(text)
            if at + PIECE < len(text):
                # A blank after a non-blank always begins a pre-token.
                cut = self.blank.search(text, at + PIECE)
                end = cut.start() + 1 if cut else len(text)
            yield self.pattern.findall(text[at:end])
            at = end

    def _learn(self, fresh: list[str]) -> dict[str, bytes]:
        """Little-endian 32-bit ids of pre-tokens."""
        found, rest = {}, []
        for token in fresh:
            raw = token.encode("utf-8", "surrogatepass")
            known = self.whole.get(raw)
            if known is not None:
                found[token] = known
            else:
                rest.append((token, raw.decode("latin-1").translate(self.to_piece)))
        encoded = self.pieces.encode([m for _, m in rest], out_type=int, num_threads=1)
        for (token, _), ids in zip(rest, encoded):
            found[token] = np.asarray(ids, dtype="<u4").tobytes()
        return found

    def encode(self, text: str | None) -> bytes:
        """Ids of a whole text as little-endian unsigned 32-bit integers."""
        parts = []
        for tokens in self._pre_tokens(text or ""):
            cache = self.cache
            found = self._learn(list({t for t in tokens if t not in cache}))
            cache.update(found)
            parts.append(b"".join([cache[t] for t in tokens]))
            self._forget(found)
        return b"".join(parts)

    def _forget(self, found: dict[str, bytes]) -> None:
        """Keep the cache within its bound; start afresh once most lookups miss it."""
        cache, over = self.cache, len(self.cache) > CACHE
        for token in found:
            if over or len(token) > LONG:
                del cache[token]
        self.misses = self.misses + len(found) if over else 0
        if self.misses > 4 * CACHE:
            cache.clear()
            self.misses = 0

    def decode(self, ids: np.ndarray) -> bytes:
        table = self.bytes_of
        return b"".join([table[i] for i in ids.tolist()])


def encode_texts(docs: DataFrame, vocabulary: str, pattern: str, text_col: str = "text",
                 keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns + (n_tokens, ids array<int>), one row per document."""
    small_batches(docs.sparkSession)
    tokens = docs.sparkSession.sparkContext.broadcast(read_ranks(vocabulary))
    kept = [F.col(c) for c in keep]
    schema = docs.select(*kept).withColumns({"n_tokens": F.lit(0).cast("bigint"),
                                             "ids": F.array().cast("array<int>")}).schema

    def run(batches):
        codec = Codec(tokens.value, pattern)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):      # bounded output batches
                rows = batch.slice(at, 256)
                encoded = [codec.encode(t.as_py()) for t in rows.column(rows.num_columns - 1)]
                sizes = np.array([len(e) // 4 for e in encoded], dtype=np.int64)
                offsets = np.concatenate(([0], np.cumsum(sizes))).astype(np.int32)
                ids = pa.ListArray.from_arrays(pa.array(offsets), pa.array(
                    np.frombuffer(b"".join(encoded), dtype="<i4")))
                yield pa.RecordBatch.from_arrays([*rows.columns[:-1], pa.array(sizes), ids],
                                                 names=[f.name for f in schema.fields])

    return docs.select(*kept, F.col(text_col).cast("string").alias("__text")).mapInArrow(trimmed(run), schema)


def decode_ids(encoded: DataFrame, vocabulary: str, pattern: str, ids_col: str = "ids",
               keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns + (decoded binary), one row per row."""
    tokens = encoded.sparkSession.sparkContext.broadcast(read_ranks(vocabulary))
    kept = [F.col(c) for c in keep]
    schema = encoded.select(*kept).withColumn("decoded", F.lit(b"")).schema

    def run(batches):
        codec = Codec(tokens.value, pattern)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                rows = batch.slice(at, 256)
                decoded = [codec.decode(_ids_of(ids)) for ids in rows.column(rows.num_columns - 1)]
                yield pa.RecordBatch.from_arrays([*rows.columns[:-1], pa.array(decoded, pa.binary())],
                                                 names=[f.name for f in schema.fields])

    return encoded.select(*kept, F.col(ids_col).alias("__ids")).mapInArrow(trimmed(run), schema)


def _ids_of(scalar: pa.ListScalar) -> np.ndarray:
    if not scalar.is_valid:
        return np.empty(0, dtype="<u4")
    return scalar.values.to_numpy(zero_copy_only=False).astype("<u4")


def digests(encoded: DataFrame, vocabulary: str, pattern: str, with_ids: bool = False) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256[, ids]) of encoded rows, decoding the ids."""
    tokens = encoded.sparkSession.sparkContext.broadcast(read_ranks(vocabulary))
    schema = "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string"

    def run(batches):
        codec = Codec(tokens.value, pattern)
        for batch in batches:
            arrays = [_ids_of(ids) for ids in batch.column(2)]
            found = pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1),
                 pa.array([hashlib.sha256(a.tobytes()).hexdigest() for a in arrays], pa.string()),
                 pa.array([hashlib.sha256(codec.decode(a)).hexdigest() for a in arrays], pa.string())],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])
            yield found.append_column("ids", batch.column(2)) if with_ids else found

    return encoded.select("doc_id", "n_tokens", "ids").mapInArrow(trimmed(run), schema + ", ids array<int>" if with_ids else schema)

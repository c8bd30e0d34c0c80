"""Alignment of two tokenizers over the same bytes, with an identity-map fast path.

A text with a blank before it is encoded by both vocabularies.  Byte
offsets where a token of A and a token of B both end cut the two id
sequences into groups; the last tokens of a group are linked.

1. A text is cut into units before a blank that follows a character which
   is neither white space nor U+2581.  Neither vocabulary has a token across
   such a place (checked for B's pieces), so a unit is encoded and aligned by
   itself, once per call and Python worker while it is remembered: the tasks
   of a call that a worker runs one after the other share its units.
2. The identity map holds, for each A id, the B id with the same bytes.  A
   group of one A token and that B token is exact; it is kept as its A id
   and counted in a vector of A's length.  Only the links of the other
   groups are counted as (A id, B id) pairs and shuffled, after a partial
   count per task.
3. Linked tokens end together, so the bytes of one end those of the other.
   There are at most as many such pairs as A's and B's tokens have bytes, a
   bound of the vocabularies alone, checked before the counts are sent to
   all tasks.  A second pass over the staged links adds them up by document.

The vocabularies' files are read on the driver; their bytes (some MB)
travel with the tasks.  Memory follows the longest unit, not the text.

Defined results: a null or empty text, or one with a unit whose joined
token bytes differ from it under either vocabulary (U+2581 in a text, say),
has no tokens: zeros and an empty digest.  Texts of any length are encoded
whole.  Rows come back one for one;
repeated rows count as often as they occur.  Null ids stay null.  Columns
other than the id and the text are ignored.  An empty table gives an empty
result.
"""

from __future__ import annotations

import hashlib
import os
import re
import struct
import uuid
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bpe import byte_alphabet
from .common import small_batches, stage, trimmed

UNITS = 1 << 19        # units remembered by a worker, about 200 bytes each
LONG = 48              # characters beyond which a unit is not remembered
ROWS = 256             # rows of an output batch
CUT = re.compile(r"(?<=[^\s▁])(?= )")
ODD = re.compile(r"\s |▁")

ENCODED = ("doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, "
           "groups_sha256 string, exact binary, pairs binary")
RESULT = ("doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, "
          "n_best bigint, count_sum bigint, groups_sha256 string")


def a_bytes(tokenizer) -> list[bytes]:
    """Bytes of every id of a byte-level vocabulary."""
    back = {c: b for b, c in enumerate(byte_alphabet())}
    entries = tokenizer.get_vocab(with_added_tokens=False)
    found = [b""] * (max(entries.values()) + 1)
    for piece, i in entries.items():
        found[i] = bytes(back[c] for c in piece)
    return found


def b_bytes(pieces) -> list[bytes]:
    """Bytes of every id of a sentencepiece vocabulary; control pieces have none."""
    found = []
    for i, piece in enumerate(map(pieces.id_to_piece, range(pieces.get_piece_size()))):
        if pieces.is_byte(i):
            found.append(bytes([int(piece[3:5], 16)]))
        else:
            plain = not (pieces.is_control(i) or pieces.is_unknown(i))
            found.append(piece.replace("▁", " ").encode() if plain else b"")
    return found


def identity_map(a: list[bytes], b: list[bytes]) -> np.ndarray:
    """For each A id the smallest B id with the same bytes, -1 without one."""
    by_bytes: dict[bytes, int] = {}
    for i, token in enumerate(b):
        if token:
            by_bytes.setdefault(token, i)
    return np.array([by_bytes.get(token, -1) for token in a], dtype=np.int64)


def most_pairs(a: list[bytes], b: list[bytes]) -> int:
    """Bound of the pairs of tokens of which one ends the other."""
    return sum(map(len, a)) + sum(map(len, b))


class Aligner:
    """Both vocabularies and the units of one worker."""

    def __init__(self, a_json: str, b_model: bytes):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.first = Tokenizer.from_str(a_json)
        self.first.encode_special_tokens = True
        self.second = sentencepiece.SentencePieceProcessor(model_proto=b_model)
        self.a, self.b = a_bytes(self.first), b_bytes(self.second)
        self.same = identity_map(self.a, self.b).tolist()
        pieces = map(self.second.id_to_piece, range(len(self.b)))
        if any(re.search("[^▁]▁", p) for p in pieces):
            raise ValueError("a piece reaches across a blank")
        self.exact_type, self.exact_code = ("<u2", "H") if len(self.a) <= 1 << 16 else ("<u4", "I")
        self.units: dict[str, tuple | None] = {}
        self.misses = 0

    def _align(self, a_ids: list[int], b_ids: list[int]) -> tuple:
        """(n_a, n_b, n_groups, groups, exact, pairs) of one unit with equal bytes."""
        a, b, same = self.a, self.b, self.same
        groups, exact, pairs = [], [], []
        i = j = left_a = left_b = 0           # first tokens of the open group
        a_end, b_end = len(a[a_ids[0]]), len(b[b_ids[0]])
        while True:
            if a_end == b_end:
                x, y = a_ids[i], b_ids[j]
                if i == left_a and j == left_b:
                    groups.append(f"{x}|{y}")
                else:
                    groups.append(f"{','.join(map(str, a_ids[left_a:i + 1]))}|"
                                  f"{','.join(map(str, b_ids[left_b:j + 1]))}")
                if i == left_a and j == left_b and same[x] == y:
                    exact.append(x)
                else:
                    pairs.append(y * len(a) + x)
                i += 1
                j += 1
                if i == len(a_ids):
                    break
                left_a, left_b = i, j
                a_end += len(a[a_ids[i]])
                b_end += len(b[b_ids[j]])
            elif a_end < b_end:
                i += 1
                a_end += len(a[a_ids[i]])
            else:
                j += 1
                b_end += len(b[b_ids[j]])
        return (len(a_ids), len(b_ids), len(groups), ";".join(groups),
                struct.pack(f"<{len(exact)}{self.exact_code}", *exact), struct.pack(f"<{len(pairs)}I", *pairs))

    def _learn(self, keys: list[str]) -> dict[str, tuple | None]:
        """Aligned units, None where token bytes differ; a key is its unit without the first blank."""
        blank = self.second.piece_to_id("▁")
        found = {}
        for at in range(0, len(keys), 4096):
            some = keys[at:at + 4096]
            ours = self.first.encode_batch_fast([" " + k for k in some], add_special_tokens=False)
            theirs = self.second.encode(some, out_type=int, num_threads=1)
            for key, x, y in zip(some, ours, theirs):
                a_ids, b_ids = x.ids, y if key else [blank]
                a_raw = b"".join([self.a[i] for i in a_ids])
                b_raw = b"".join([self.b[i] for i in b_ids])
                raw = f" {key}".encode()
                found[key] = self._align(a_ids, b_ids) if a_raw == raw == b_raw else None
        return found

    def text(self, text: str | None) -> tuple[int, int, int, str, bytes, bytes]:
        """(n_a, n_b, n_groups, digest, exact, pairs) of a whole text."""
        none = (0, 0, 0, "", b"", b"")
        if not text:
            return none
        if not ODD.search(text) and text[0] != " ":
            keys = text.split(" ")
        elif "▁" in text:
            keys = [text]
        else:
            keys = [unit[1:] for unit in CUT.split(" " + text)]
        known = self.units
        found = self._learn(list({k for k in keys if k not in known}))
        known.update(found)
        parts = [known[k] for k in keys]
        self._forget(found)
        if None in parts:
            return none
        n_a, n_b, n_groups, groups, exact, pairs = zip(*parts)
        digest = hashlib.sha256(";".join(groups).encode()).hexdigest()
        return sum(n_a), sum(n_b), sum(n_groups), digest, b"".join(exact), b"".join(pairs)

    def _forget(self, found: dict) -> None:
        """Keep the units within their bound; start afresh once most lookups miss."""
        units, over = self.units, len(self.units) > UNITS
        for key in found:
            if over or len(key) > LONG:
                del units[key]
        self.misses = self.misses + len(found) if over else 0
        if self.misses > 4 * UNITS:
            units.clear()
            self.misses = 0


_KEPT: dict[str, Aligner] = {}   # of this worker: that of the last call


def kept_aligner(call: str, files: tuple[str, bytes]) -> Aligner:
    """The worker's aligner of a call, with the units that the call's earlier tasks have met."""
    if call not in _KEPT:
        _KEPT.clear()
        _KEPT[call] = Aligner(*files)
    return _KEPT[call]


def _files(spark, a_path: str, b_path: str):
    with open(a_path, encoding="utf-8") as a, open(b_path, "rb") as b:
        return spark.sparkContext.broadcast((a.read(), b.read()))


def encode_links(docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """Counts, digest and packed links of every document: A ids of exact groups, codes of the other pairs."""
    small_batches(docs.sparkSession)
    files, call = _files(docs.sparkSession, a_path, b_path), uuid.uuid4().hex

    def run(batches):
        aligner = kept_aligner(call, files.value)
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                rows = batch.slice(at, ROWS)
                found = [aligner.text(t.as_py()) for t in rows.column(1)]
                n_a, n_b, n_groups, digests, exact, pairs = (list(x) for x in zip(*found))
                longs = [pa.array(x, pa.int64()) for x in (n_a, n_b, n_groups, n_groups)]
                yield pa.RecordBatch.from_arrays(
                    [rows.column(0), *longs, pa.array(digests, pa.string()), pa.array(exact, pa.binary()),
                     pa.array(pairs, pa.binary())],
                    names=["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "exact", "pairs"])

    return docs.select(F.col(id_col).cast("bigint"), F.col(text_col).cast("string")).mapInArrow(trimmed(run), ENCODED)


def _joined(column: pa.Array, dtype: str) -> np.ndarray:
    return np.frombuffer(b"".join([v.as_buffer() for v in column]), dtype=dtype)


def link_counts(encoded: DataFrame, same: np.ndarray, exact_type: str) -> DataFrame:
    """(a, b, n): how many links of the corpus hold each pair."""
    size = len(same)

    def run(batches):
        _KEPT.clear()                         # the units are not needed any more
        vector = np.zeros(size, dtype=np.int64)
        others: Counter[int] = Counter()
        for batch in batches:
            vector += np.bincount(_joined(batch.column(0), exact_type), minlength=size)
            codes, n = np.unique(_joined(batch.column(1), "<u4"), return_counts=True)
            others.update(dict(zip(codes.tolist(), n.tolist())))
        held = np.flatnonzero(vector)
        codes = np.concatenate([same[held] * size + held, np.fromiter(others, dtype=np.int64, count=len(others))])
        n = np.concatenate([vector[held], np.fromiter(others.values(), dtype=np.int64, count=len(others))])
        for at in range(0, len(codes), 1 << 16):
            part = slice(at, at + (1 << 16))
            yield pa.RecordBatch.from_arrays(
                [pa.array(codes[part] % size), pa.array(codes[part] // size), pa.array(n[part])],
                names=["a", "b", "n"])

    partial = encoded.select("exact", "pairs").mapInArrow(trimmed(run), "a bigint, b bigint, n bigint")
    return partial.groupBy("a", "b").agg(F.sum("n").alias("n"))


def align(docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256), one row per document."""
    spark = docs.sparkSession
    with open(a_path, encoding="utf-8") as a, open(b_path, "rb") as b:
        aligner = Aligner(a.read(), b.read())
    same, size, exact_type = np.array(aligner.same), len(aligner.a), aligner.exact_type
    encoded = stage(encode_links(docs, a_path, b_path, id_col, text_col), "align-links")
    counts = stage(link_counts(encoded, same, exact_type), "align-counts")
    if counts.count() > most_pairs(aligner.a, aligner.b):
        raise ValueError("more linked pairs than two vocabularies over the same bytes can have")
    table = counts.toArrow()
    codes = table["b"].to_numpy() * size + table["a"].to_numpy()
    order = np.argsort(codes)
    codes, n = codes[order], table["n"].to_numpy()[order]
    most = np.zeros(len(aligner.b), dtype=np.int64)
    np.maximum.at(most, codes // size, n)
    shared = spark.sparkContext.broadcast((codes, n, n == most[codes // size]))

    def run(batches):
        codes, n, best = shared.value
        vector, hits = np.zeros(size, dtype=np.int64), np.zeros(size, dtype=np.int64)
        own = same * size + np.arange(size)
        at = np.searchsorted(codes, own)
        held = (same >= 0) & (np.take(codes, at, mode="clip") == own) if len(codes) else np.zeros(size, dtype=bool)
        vector[held], hits[held] = n[at[held]], best[at[held]]
        for batch in batches:
            sums, bests = [], []
            for exact, pairs in zip(batch.column(6), batch.column(7)):
                x = np.frombuffer(exact.as_buffer(), dtype=exact_type)
                y = np.searchsorted(codes, np.frombuffer(pairs.as_buffer(), dtype="<u4"))
                sums.append(int(vector[x].sum() + n[y].sum()))
                bests.append(int(hits[x].sum() + best[y].sum()))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:5], pa.array(bests, pa.int64()), pa.array(sums, pa.int64()), batch.column(5)],
                names=["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"])

    return encoded.mapInArrow(trimmed(run), RESULT)

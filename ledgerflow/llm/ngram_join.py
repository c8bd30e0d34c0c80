"""Set similarity join on word n-grams by prefix filtering.

Every text becomes its set of distinct 4-word shingles, hashed once.  Two
sets are linked when 100 * intersection >= ``PERCENT`` * union.

1. Screen.  In any one order of all shingles, linked sets of at least n
   members share ``spare(n)`` values among their first ``head(n)``.  The order
   of the hashes needs no counts, so this is asked first: a document with
   fewer head values that another document's head holds has no partner and
   is settled, exactly.  The others are open.
2. Open documents with equal sets form a class, one set from here on.
3. Rare-first prefixes: the shingles of open sets are ordered by their
   number of sets, then by hash.  Linked sets share one of the first
   ``prefix(n)``.  Shingles of one set only fill prefixes without making
   pairs, so only the others are indexed, with their position and with the
   counts of the shingles behind them in ``CELLS`` cells.
4. The index is joined on the n-gram under three filters: length (the sizes
   allow the similarity), position (as first common n-gram, the members
   behind it still suffice) and suffix (counts per cell bound the Hamming
   distance of what lies behind).
5. First every class is tried with one partner, the one that most of its
   prefix n-grams name; verified links make components.  Then all pairs that
   pass the filters and lie in different components are verified, each once.
   Pairs within a component can't change the result and aren't made.

Sets are compared through 64-bit hashes of their shingles, kept to 63 bits:
two different shingles pass for one with a probability of about 2**-60.
Classes are told apart by 128-bit digests of whole sets.

Defined results: a null or blank text has no shingles and links to
nothing; fewer than four words give one shingle, the whole sequence.  Texts
of any length are read whole.  A null id is never compared: its component
is null.  Rows that repeat an id keep a component each, that of their own
text.  Columns other than the id and the text are ignored; an empty table
gives an empty result.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import bloom
from .common import small_batches, stage, trimmed
from .components import components
from .texthash import documents, windows

SHINGLE = 4
PERCENT = 85
CELLS = 16             # a byte each, in two 64-bit numbers
SET_VALUES = 500_000   # shingles after which a task hands on what it holds

SIGNED = "doc_id bigint, n_shingles bigint, digest binary, head array<bigint>"
INDEX = "digest binary, n bigint, h bigint, at bigint, cells0 bigint, cells1 bigint"


def needed(n, percent: int = PERCENT):
    """Least number of members that a set of n shares with a linked one."""
    return -(-n * percent // 100)


def spare(n):
    return n // 16 + 1


def head(n, percent: int = PERCENT):
    return n - needed(n, percent) + spare(n)


def shingle_set(hashes: np.ndarray, width: int = SHINGLE) -> np.ndarray:
    """Sorted distinct 63-bit shingle hashes of one text's word hashes."""
    if not len(hashes):
        return np.empty(0, dtype=np.int64)
    return np.unique((windows(hashes, min(width, len(hashes))) >> np.uint64(1)).astype(np.int64))


def set_digest(values: np.ndarray) -> bytes:
    return hashlib.blake2b(values.tobytes(), digest_size=16).digest()


def _arrays(parts: list[np.ndarray]) -> pa.Array:
    offsets = np.concatenate(([0], np.cumsum([len(p) for p in parts]))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(
        np.concatenate(parts) if parts else np.empty(0, dtype=np.int64)))


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))


def signed_heads(texts: DataFrame, percent: int) -> DataFrame:
    """Set size, digest and head values of every document; a text without words has no digest."""
    def run(batches):
        for batch in batches:
            sizes, digests, heads, first, held = [], [], [], 0, 0
            for row, _, _, _, hashes in documents(batch.column(1), lower=True):
                values = shingle_set(hashes)
                n = len(values)
                sizes.append(n)
                digests.append(set_digest(values) if n else None)
                heads.append(values[:head(n, percent)] if n else values)
                held += n
                if held >= SET_VALUES or row == batch.num_rows - 1:
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0).slice(first, len(sizes)), pa.array(sizes, pa.int64()),
                         pa.array(digests, pa.binary()), _arrays(heads)],
                        names=["doc_id", "n_shingles", "digest", "head"])
                    sizes, digests, heads, first, held = [], [], [], row + 1, 0

    return texts.mapInArrow(trimmed(run), SIGNED)


def open_documents(signed: DataFrame, percent: int) -> DataFrame:
    """(doc_id, digest, n) of the documents whose head allows a partner."""
    spark = signed.sparkSession
    rows = signed.filter("doc_id IS NOT NULL AND digest IS NOT NULL").select(
        "doc_id", "digest", F.col("n_shingles").alias("n"), "head")
    often = stage(rows.select(F.explode("head").alias("h")).groupBy("h").count().filter("count > 1").select("h"),
                  "join-often")
    bitmap, _ = bloom.build(often, often.count())
    shared = spark.sparkContext.broadcast(bitmap)

    def least(n):
        # The partner may be smaller, and so may the number it shares for sure.
        return spare(needed(n, percent))

    def run(batches):
        for batch in batches:
            parts, keep = [], []
            for n, values in zip(batch.column(2).to_pylist(), batch.column(3)):
                values = values.values.to_numpy()
                values = values[bloom.contains(shared.value, values.view(np.uint64))]
                keep.append(len(values) >= least(n))
                if keep[-1]:
                    parts.append(values)
            kept = batch.filter(pa.array(keep))
            yield pa.RecordBatch.from_arrays([*kept.columns[:3], _arrays(parts)], names=["doc_id", "digest", "n", "head"])

    likely = stage(rows.mapInArrow(trimmed(run), "doc_id bigint, digest binary, n bigint, head array<bigint>"), "join-likely")
    floor = (F.floor((F.col("n") * percent + 99) / 100 / 16) + 1).cast("bigint")
    found = (likely.select("doc_id", "digest", "n", F.explode("head").alias("h")).join(often, "h", "left_semi")
             .groupBy("doc_id", "digest", "n").count().filter(F.col("count") >= floor))
    return stage(found.select("doc_id", "digest", "n"), "join-open")


def class_sets(texts: DataFrame, classes: DataFrame) -> DataFrame:
    """(digest, n, set) of the classes, rebuilt from the text of their smallest document."""
    def mark(ids: np.ndarray, digests: np.ndarray) -> np.ndarray:
        return bloom.mix64(ids.view(np.uint64)) ^ digests

    def marks(batches):
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            digests = np.array([int.from_bytes(d.as_buffer()[:8], "little") for d in batch.column(1)], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([pa.array(mark(ids, digests).view(np.int64))], names=["mark"])

    bitmap, _ = bloom.build(classes.select("rep", "digest").mapInArrow(trimmed(marks), "mark bigint"), classes.count())
    ids, _ = bloom.build(classes.select("rep"), classes.count())
    shared = texts.sparkSession.sparkContext.broadcast((bitmap, ids))

    def run(batches):
        bitmap, wanted = shared.value
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            chosen = bloom.contains(wanted, ids.view(np.uint64))
            ids, batch = ids[chosen], batch.filter(pa.array(chosen))
            held, digests, size = [], [], 0
            for row, _, _, _, hashes in documents(batch.column(1), lower=True):
                values = shingle_set(hashes)
                digest = set_digest(values)
                own = mark(ids[row:row + 1], np.array([int.from_bytes(digest[:8], "little")], dtype=np.uint64))
                if len(values) and bloom.contains(bitmap, own)[0]:
                    held.append(values)
                    digests.append(digest)
                    size += len(values)
                if held and (size >= SET_VALUES or row == batch.num_rows - 1):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(digests, pa.binary()), pa.array([len(v) for v in held], pa.int64()), _arrays(held)],
                        names=["digest", "n", "set"])
                    held, digests, size = [], [], 0

    return texts.filter("doc_id IS NOT NULL").mapInArrow(trimmed(run), "digest binary, n bigint, set array<bigint>")


def prefix_index(sets: DataFrame, percent: int) -> DataFrame:
    """Index rows (digest, n, h, at, cells0, cells1): shared n-grams of rare-first prefixes."""
    values = sets.select("digest", "n", F.explode("set").alias("h"))
    counts = stage(values.groupBy("h").agg(F.count("*").alias("df")).filter("df > 1"), "join-counts")
    shared = values.join(counts, "h").groupBy("digest", "n").agg(F.collect_list(F.struct("df", "h")).alias("hs"))

    def run(batches):
        for batch in batches:
            out = [[] for _ in range(6)]
            for digest, n, hs in zip(batch.column(0), batch.column(1).to_pylist(), batch.column(2)):
                df, h = (hs.values.field(k).to_numpy() for k in (0, 1))
                h = h[np.lexsort((h, df))]
                alone = n - len(h)                      # shingles of no other set come first
                count = min(len(h), n - needed(n, percent) + 1 - alone)
                if count <= 0:
                    continue
                cells = np.zeros((len(h), CELLS), dtype=np.int64)
                cells[np.arange(len(h)), (bloom.mix64(h.view(np.uint64)) % np.uint64(CELLS)).astype(np.int64)] = 1
                behind = cells[::-1].cumsum(axis=0)[::-1][:count] - cells[:count]
                packed = np.minimum(behind, 255).astype(np.uint8).view("<i8")
                out[0] += [digest.as_py()] * count
                for column, piece in zip(out[1:], (np.full(count, n), h[:count], alone + np.arange(count),
                                                   packed[:, 0], packed[:, 1])):
                    column.append(piece)
            if out[0]:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(out[0], pa.binary()), *[pa.array(np.concatenate(c)) for c in out[1:]]],
                    names=["digest", "n", "h", "at", "cells0", "cells1"])

    return stage(shared.mapInArrow(trimmed(run), INDEX), "join-index")


def _filters(x: str, y: str, percent: int) -> Column:
    """Length, positional and suffix filter of two index rows with the same n-gram."""
    n_x, n_y = F.col(f"{x}.n"), F.col(f"{y}.n")
    length = (n_x * 100 >= n_y * percent) & (n_y * 100 >= n_x * percent)
    # Least intersection of linked sets of these sizes.
    common = F.ceil((n_x + n_y) * percent / F.lit(100 + percent) - F.lit(1e-9)).cast("bigint")
    behind_x, behind_y = n_x - F.col(f"{x}.at") - 1, n_y - F.col(f"{y}.at") - 1
    position = F.least(behind_x, behind_y) + 1 >= common
    distance = F.lit(0).cast("bigint")
    for word in ("cells0", "cells1"):
        for k in range(8):
            cell = lambda side: F.shiftright(F.col(f"{side}.{word}"), 8 * k).bitwiseAND(F.lit(255).cast("bigint"))  # noqa: E731,B023
            distance = distance + F.abs(cell(x) - cell(y))
    suffix = distance <= behind_x + behind_y - 2 * (common - 1)
    return length & position & suffix


def _first_pairs(index: DataFrame, percent: int) -> DataFrame:
    """(a, b): every class b with the one partner that most of its prefix n-grams name."""
    pivots = stage(index.groupBy("h").agg(
        F.min_by(F.struct("digest", "n", "at", "cells0", "cells1"), F.struct("at", "digest")).alias("p"),
        F.count("*").alias("size")).filter("size > 1").select("h", "p.*"), "join-pivots")
    votes = (index.alias("y").join(pivots.alias("x"), F.col("x.h") == F.col("y.h"))
             .filter((F.col("x.digest") != F.col("y.digest")) & _filters("x", "y", percent))
             .groupBy(F.col("x.digest").alias("a"), F.col("y.digest").alias("b")).agg(F.count("*").alias("votes")))
    return votes.groupBy("b").agg(F.max_by("a", F.struct("votes", "a")).alias("a")).select(
        F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _other_pairs(index: DataFrame, labels: DataFrame, tried: DataFrame, percent: int) -> DataFrame:
    """(a, b), a < b: pairs across components that pass the filters and were not tried."""
    named = stage(index.join(labels, index["digest"] == labels["node"], "left").select(
        *index.columns, F.coalesce("component", "digest").alias("c")), "join-named")
    mixed = stage(named.groupBy("h").agg(F.min("c").alias("lo"), F.max("c").alias("hi")).filter("lo <> hi").select("h"),
                  "join-mixed")
    left = stage(named.join(mixed, "h", "left_semi"), "join-mixed-index")
    x, y = left.alias("x"), left.alias("y")
    return (x.join(y, F.col("x.h") == F.col("y.h"))
            .filter((F.col("x.digest") < F.col("y.digest")) & (F.col("x.c") != F.col("y.c")) & _filters("x", "y", percent))
            .select(F.col("x.digest").alias("a"), F.col("y.digest").alias("b")).distinct()
            .join(tried, ["a", "b"], "left_anti"))


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs whose full sets reach the similarity."""
    side = lambda key: sets.select(F.col("digest").alias(key), F.col("set").alias(f"set_{key}"))
    both = F.size(F.array_intersect("set_a", "set_b"))
    union = F.size("set_a") + F.size("set_b") - both
    return pairs.join(side("b"), "b").join(side("a"), "a").filter(both * 100 >= union * percent).select("a", "b")


def ngram_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_shingles, component_id), one row per document."""
    if not 50 <= percent <= 100:
        raise ValueError(f"percent {percent} is not in 50..100")
    small_batches(docs.sparkSession)
    texts = _texts(docs, id_col, text_col)
    signed = stage(signed_heads(texts, percent), "join-heads")
    opened = open_documents(signed, percent)
    classes = stage(opened.groupBy("digest", "n").agg(F.min("doc_id").alias("rep")), "join-classes")
    sets = stage(class_sets(texts, classes), "join-sets")
    index = prefix_index(sets, percent)

    tried = stage(_first_pairs(index, percent), "join-first")
    links = stage(_verified(tried, sets, percent), "join-links")
    labels = stage(components(links), "join-labels")
    more = stage(_verified(_other_pairs(index, labels, tried, percent), sets, percent), "join-more")
    if not more.isEmpty():
        links = links.unionByName(more)
        labels = stage(components(links), "join-components")

    # Digests of a component, then its smallest document.
    named = classes.join(labels, classes["digest"] == labels["node"], "left").select(
        "digest", "rep", F.coalesce("component", "digest").alias("c"))
    named = stage(named, "join-named-classes")
    smallest = named.groupBy("c").agg(F.min("rep").alias("component_id"))
    found = stage(named.join(smallest, "c").select("digest", "component_id"), "join-found")
    return (signed.select("doc_id", "n_shingles", "digest").join(found, "digest", "left")
            .select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.coalesce(
                "component_id", "doc_id")).alias("component_id")))

"""A blocked Bloom filter of 64-bit hashes, built in Spark tasks.

The bit array is cut into segments of 2**16 bits.  The top bits of a hash
choose the segment and four 16-bit pieces of its mix choose bits within
it.  Two bitmaps are kept: ``once`` (bit set by a row) and ``twice`` (bit
set by at least two rows).  A hash that occurs twice has all its bits in
``twice``, so a row with a clear bit there is certainly unique.

The filter is sized from the number of rows, up to ``MAX_BITS``; only that
bounded array reaches the driver and is broadcast.  Beyond the bound the
filter fills up and lets more rows through, which costs shuffle volume but
never a row.
"""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import local_rows, trimmed

SEGMENT_BITS = 1 << 16
SEGMENT_BYTES = SEGMENT_BITS // 8
MAX_BITS = 1 << 28
BITS_PER_ROW = 24
MERGE_FAN_IN = 64


def mix64(x: np.ndarray) -> np.ndarray:
    """Finaliser of the splitmix64 generator (wrapping arithmetic)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def segments_for(n_rows: int) -> int:
    """Number of segments (a power of two) for so many rows."""
    wanted = max(1, -(-min(n_rows * BITS_PER_ROW, MAX_BITS) // SEGMENT_BITS))
    return 1 << (wanted - 1).bit_length()


def _slots(hashes: np.ndarray, n_segments: int) -> np.ndarray:
    """(4, n) global bit numbers of each hash."""
    mixed = mix64(hashes)
    again = mix64(mixed + np.uint64(0x9E3779B97F4A7C15))
    base = (mixed & np.uint64(n_segments - 1)) * np.uint64(SEGMENT_BITS)
    return np.stack([base + ((again >> np.uint64(16 * i)) & np.uint64(0xFFFF)) for i in range(4)])


def build(hashes: DataFrame, n_rows: int) -> tuple[np.ndarray, np.ndarray]:
    """(once, twice) bitmaps of the one bigint column of ``hashes``."""
    n_segments = segments_for(n_rows)

    def local(batches):
        once = np.zeros(n_segments * SEGMENT_BYTES, dtype=np.uint8)
        twice = np.zeros(n_segments * SEGMENT_BYTES, dtype=np.uint8)
        for batch in batches:
            values = batch.column(0).drop_null().to_numpy(zero_copy_only=False).view(np.uint64)
            for slots in _slots(values, n_segments):
                unique, counts = np.unique(slots, return_counts=True)
                seen = _has(once, unique)
                _set_bits(twice, unique[seen | (counts > 1)])
                _set_bits(once, unique)
        task = task_number()
        for s in range(n_segments):
            part = slice(s * SEGMENT_BYTES, (s + 1) * SEGMENT_BYTES)
            if once[part].any():
                yield pa.RecordBatch.from_pydict({
                    "segment": pa.array([s], pa.int32()), "task": pa.array([task], pa.int32()),
                    "once": pa.array([zlib.compress(once[part].tobytes(), 1)], pa.binary()),
                    "twice": pa.array([zlib.compress(twice[part].tobytes(), 1)], pa.binary())})

    def merge(frame: pd.DataFrame) -> pd.DataFrame:
        once = np.zeros(SEGMENT_BYTES, dtype=np.uint8)
        twice = np.zeros(SEGMENT_BYTES, dtype=np.uint8)
        for o, t in zip(frame["once"], frame["twice"]):
            o = np.frombuffer(zlib.decompress(o), dtype=np.uint8)
            twice |= np.frombuffer(zlib.decompress(t), dtype=np.uint8) | (once & o)
            once |= o
        return pd.DataFrame({"segment": frame["segment"].iloc[:1], "task": frame["task"].iloc[:1],
                             "once": [zlib.compress(once.tobytes(), 1)],
                             "twice": [zlib.compress(twice.tobytes(), 1)]})

    schema = "segment int, task int, once binary, twice binary"
    parts = hashes.mapInArrow(trimmed(local), schema)
    parts = (parts.groupBy("segment", F.floor(F.col("task") / MERGE_FAN_IN).alias("bunch"))
             .applyInPandas(merge, schema))
    parts = parts.groupBy("segment").applyInPandas(merge, schema)
    once = np.zeros(n_segments * SEGMENT_BYTES, dtype=np.uint8)
    twice = np.zeros(n_segments * SEGMENT_BYTES, dtype=np.uint8)
    for row in local_rows(parts):
        at = row["segment"] * SEGMENT_BYTES
        once[at:at + SEGMENT_BYTES] = np.frombuffer(zlib.decompress(row["once"]), dtype=np.uint8)
        twice[at:at + SEGMENT_BYTES] = np.frombuffer(zlib.decompress(row["twice"]), dtype=np.uint8)
    return once, twice


def task_number() -> int:
    from pyspark import TaskContext

    context = TaskContext.get()
    return context.partitionId() if context else 0


def _has(bitmap: np.ndarray, slots: np.ndarray) -> np.ndarray:
    return (bitmap[slots >> np.uint64(3)] >> (7 - (slots & np.uint64(7))).astype(np.uint8)) & 1 > 0


def _set_bits(bitmap: np.ndarray, slots: np.ndarray) -> None:
    """Set the bits of sorted, distinct slot numbers."""
    if len(slots):
        at = slots >> np.uint64(3)
        bits = np.left_shift(1, (7 - (slots & np.uint64(7))).astype(np.int64)).astype(np.uint8)
        first = np.flatnonzero(np.concatenate(([True], at[1:] != at[:-1])))
        bitmap[at[first]] |= np.bitwise_or.reduceat(bits, first)


def contains(bitmap: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Which hashes have all their bits set."""
    n_segments = len(bitmap) // SEGMENT_BYTES
    found = np.ones(len(hashes), dtype=bool)
    for slots in _slots(hashes, n_segments):
        found &= _has(bitmap, slots)
    return found


def might_contain(spark, bitmap: np.ndarray, column: Column) -> Column:
    """Boolean column: the hash may be in the (broadcast, bounded) bitmap."""
    shared = spark.sparkContext.broadcast(bitmap)

    @F.pandas_udf("boolean")
    def probe(values: pd.Series) -> pd.Series:
        return pd.Series(contains(shared.value, values.to_numpy(dtype=np.int64).view(np.uint64)))

    return probe(column)

"""Batches of a stream, closed by size or by age.

Records of the shard log are gathered per (shard, slice) until a batch holds
``max_records`` or its first record has waited ``max_age_seconds``; the batch
then leaves with its records in sequence order.  The open batch is list state
in RocksDB and its age a processing-time timer, so a restarted query goes on
with the batch it had open.

A record belongs to exactly one batch: state and the file sink commit with
the micro-batch.  Which records share a batch follows the order in which they
arrive; batch numbers of a (shard, slice) count from 0 without gaps.

Scale: state is bounded by ``max_records`` per key.  One key is one task's
work, so a hot shard is cut by ``slice``: give a hash of the partition key to
keep the records of a card in one slice.
"""

from __future__ import annotations

from typing import Iterator

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from ..sources import shard_log

MAX_RECORDS = 100
MAX_AGE_SECONDS = 10

POLL_SECONDS = 0.2
DRAIN_TRIGGER = "200 milliseconds"

CLOSED_BY_SIZE = "size"
CLOSED_BY_AGE = "age"

STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

OPEN_STATE = "open_records"

RECORD_SCHEMA = T.StructType([f for f in shard_log.LOG_SCHEMA.fields if f.name != "shard_id"])
OPEN_SCHEMA = T.StructType([T.StructField("batch_number", T.LongType()), *RECORD_SCHEMA.fields])
BATCH_SCHEMA = T.StructType([
    T.StructField("shard_id", T.StringType()),
    T.StructField("slice", T.LongType()),
    T.StructField("batch_number", T.LongType()),
    T.StructField("closed_by", T.StringType()),
    *RECORD_SCHEMA.fields,
])


class BatchBuilder(StatefulProcessor):
    """State of one (shard, slice): the open batch, its number and its deadline."""

    def __init__(self, max_records: int, max_age_seconds: float):
        self.max_records = max_records
        self.max_age_ms = int(max_age_seconds * 1000)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.records = handle.getListState(OPEN_STATE, OPEN_SCHEMA)
        self.batch = handle.getValueState("batch", "number long, deadline long")

    def _closed(self, key, number: int, records: list[tuple], closed_by: str) -> Iterator[Row]:
        for record in sorted(records, key=lambda r: r[0]):
            yield Row(shard_id=key[0], slice=key[1], batch_number=number, closed_by=closed_by,
                      **dict(zip(RECORD_SCHEMA.names, record)))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        number, deadline = self.batch.get() or (0, None)
        pending = [tuple(r)[1:] for r in self.records.get()]
        kept = len(pending)                     # of the pending ones, already in state
        first_deadline = deadline
        for row in rows:
            if not pending:
                deadline = timerValues.getCurrentProcessingTimeInMs() + self.max_age_ms
            pending.append(tuple(row[name] for name in RECORD_SCHEMA.names))
            if len(pending) >= self.max_records:
                yield from self._closed(key, number, pending, CLOSED_BY_SIZE)
                number, pending, kept, deadline = number + 1, [], 0, None
        if kept == 0:
            self.records.clear()
        if len(pending) > kept:
            self.records.appendList([(number, *record) for record in pending[kept:]])
        if deadline != first_deadline:
            if first_deadline is not None:
                self.handle.deleteTimer(first_deadline)
            if deadline is not None:
                self.handle.registerTimer(deadline)
        self.batch.update((number, deadline))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        number, deadline = self.batch.get() or (0, None)
        if deadline is None or expiredTimerInfo.getExpiryTimeInMs() < deadline:
            return                              # the batch it was set for is gone
        pending = [tuple(r)[1:] for r in self.records.get()]
        yield from self._closed(key, number, pending, CLOSED_BY_AGE)
        self.records.clear()
        self.batch.update((number + 1, None))

    def close(self) -> None:
        pass


def batches(records: DataFrame, *, max_records: int = MAX_RECORDS, max_age_seconds: float = MAX_AGE_SECONDS,
            slice_by: Column | None = None) -> DataFrame:
    """Streaming log records -> records with ``slice``, ``batch_number`` and ``closed_by``."""
    if max_records < 1 or max_age_seconds <= 0:
        raise ValueError("a batch takes at least one record and some time")
    sliced = records.select(
        "shard_id", (F.lit(0) if slice_by is None else slice_by).cast("long").alias("slice"), *RECORD_SCHEMA.names)
    return sliced.groupBy("shard_id", "slice").transformWithState(
        statefulProcessor=BatchBuilder(max_records, max_age_seconds), outputStructType=BATCH_SCHEMA,
        outputMode="Append", timeMode="ProcessingTime")


def start_batches(spark: SparkSession, log_uri: str, target: str, checkpoint: str, *,
                  max_records: int = MAX_RECORDS, max_age_seconds: float = MAX_AGE_SECONDS,
                  slice_by: Column | None = None, max_files_per_trigger: int | None = None,
                  processing_time: str = "1 second") -> StreamingQuery:
    """Write the closed batches of the log to ``target`` (Parquet) until stopped.

    The state store setting is needed by this query alone; a query keeps the
    settings it starts with, so the session's own value is put back.
    """
    reader = spark.readStream.schema(shard_log.LOG_SCHEMA)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    closed = batches(reader.parquet(log_uri), max_records=max_records, max_age_seconds=max_age_seconds,
                     slice_by=slice_by)
    before = spark.conf.get(STATE_STORE, None)
    spark.conf.set(STATE_STORE, ROCKSDB)
    try:
        return (closed.writeStream.format("parquet").outputMode("append")
                .option("checkpointLocation", checkpoint)
                .trigger(processingTime=processing_time).start(target))
    finally:
        if before is None:
            spark.conf.unset(STATE_STORE)
        else:
            spark.conf.set(STATE_STORE, before)


def drain_batches(spark: SparkSession, log_uri: str, target: str, checkpoint: str, **options) -> None:
    """Run until every record that is in the log now is in a batch, closed or open.

    Timers make the query run a micro-batch at every trigger, new records or
    not, so it is never idle; a micro-batch without input shows that nothing
    was left to read.  The first one does not count: after a restart it may
    repeat one that was planned before the newest files came.
    """
    query = start_batches(spark, log_uri, target, checkpoint, **{"processing_time": DRAIN_TRIGGER, **options})
    first = None
    try:
        while query.isActive:
            progress = query.lastProgress
            if progress is not None:
                first = progress["batchId"] if first is None else first
                if progress["numInputRows"] == 0 and progress["batchId"] > first:
                    break
            query.awaitTermination(POLL_SECONDS)
    finally:
        query.stop()
    if query.exception() is not None:
        raise RuntimeError(str(query.exception()))


def closed_batches(spark: SparkSession, target: str) -> DataFrame:
    return spark.read.schema(BATCH_SCHEMA).parquet(target)


def open_batches(spark: SparkSession, checkpoint: str) -> DataFrame:
    """Records of batches still open at the last commit, from the query's state.

    Columns as ``closed_batches``, with a null ``closed_by``.
    """
    state = (spark.read.format("statestore").option("stateVarName", OPEN_STATE)
             .option("flattenCollectionTypes", True).load(checkpoint))
    return state.select("key.shard_id", "key.slice", "list_element.batch_number",
                        F.lit(None).cast("string").alias("closed_by"),
                        *[F.col(f"list_element.{name}") for name in RECORD_SCHEMA.names])

"""Structured Streaming ingest of the shard log.

``start_ingest`` tails the landed log with the file stream source and
hands every micro-batch to the batch handler through ``foreachBatch``:

* the micro-batch clock is ``current_timestamp()`` taken in the stream
  plan, so a batch replayed from the checkpoint sees the same instant
  and mints the same run id; its files are written under that run's
  folder with dynamic overwrite, so a replay replaces them;
* admission control (``maxFilesPerTrigger``) bounds a micro-batch (R6);
* LATEST keeps records that arrived at or after the query's first start,
  an instant stored beside the checkpoint so a restart keeps it (R4);
* every reader has its own checkpoint, so independent readers of one
  log do not interfere (R9).

``clock`` picks the freshness reference: ``"processing"`` (the batch
clock, as the surveyed handler) or ``"arrival"`` (each record's arrival
time; stable when a backlog is replayed days later).
"""

from __future__ import annotations

import json
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from .. import schema as S
from ..operators.metadata import MetadataTable
from ..plans.batch import ingest
from ..sources import shard_log

PROCESSING = "processing"
ARRIVAL = "arrival"


def _started_at(spark: SparkSession, checkpoint: str) -> datetime:
    """First start instant of this reader, kept in a file beside the checkpoint."""
    jvm = spark._jvm
    conf = spark._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path(checkpoint.rstrip("/") + "_started_at.json")
    fs = path.getFileSystem(conf)
    if fs.exists(path):
        stream = fs.open(path)
        try:
            reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(stream, "UTF-8"))
            text = reader.readLine()
        finally:
            stream.close()
        return datetime.fromisoformat(json.loads(text)["started_at"])
    now = datetime.now(timezone.utc)
    out = fs.create(path, False)
    try:
        out.write(bytearray(json.dumps({"started_at": now.isoformat()}).encode("utf-8")))
    finally:
        out.close()
    return now


def stream_source(spark: SparkSession, log_uri: str, *, checkpoint: str,
                  iterator_type: str = shard_log.TRIM_HORIZON,
                  max_files_per_trigger: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(shard_log.LOG_SCHEMA)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    records = reader.parquet(log_uri)
    if iterator_type == shard_log.LATEST:
        records = records.filter(
            F.col("arrival_ts") >= F.lit(_started_at(spark, checkpoint)).cast("timestamp"))
    elif iterator_type != shard_log.TRIM_HORIZON:
        raise ValueError(f"unknown iterator type {iterator_type!r}")
    # to the second, as the run id and the metadata name it
    return records.withColumn("_batch_ts", F.date_trunc("second", F.current_timestamp()))


def batch_moment(spark: SparkSession, checkpoint: str, batch_id: int) -> datetime:
    """Second of a micro-batch's instant, from the checkpoint's offset log.

    It is what ``current_timestamp()`` gives in that batch, replays
    included, and is known before a record is read.
    """
    text = spark.read.text(f"{checkpoint.rstrip('/')}/offsets/{batch_id}", wholetext=True).first()[0]
    millis = json.loads(text.splitlines()[1])["batchTimestampMs"]
    return datetime.fromtimestamp(millis // 1000, timezone.utc)


def batch_handler(settings: S.LakeSettings, reader_name: str, checkpoint: str, clock: str = PROCESSING,
                  **ingest_options):
    """The ``foreachBatch`` function: one run per micro-batch.

    RUNNING is saved before the batch is read and FAILED with the error
    whatever part of the batch fails (D9); a replay has the same run id.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        table = MetadataTable(spark, settings.metadata)
        now = F.col("arrival_ts") if clock == ARRIVAL else F.col("_batch_ts")
        request_id = f"{reader_name}-{batch_id}"
        moment = batch_moment(spark, checkpoint, batch_id).isoformat()
        known = {"pipeline_name": ingest_options.get("pipeline_name", S.PIPELINE_NAME),
                 "run_id": f"{moment}___{request_id}", "start_ts": moment, "lambda_request_id": request_id}
        table.save_one(run_status=S.STATUS_RUNNING, **known)
        try:
            runs = ingest(batch, settings,
                          now=now, run_ts=F.col("_batch_ts"),
                          request_id=F.lit(request_id),
                          run_partition=True, **ingest_options)
            if runs.isEmpty():
                # a batch without records is a run too: SUCCESS with zero counts
                table.save_one(run_status=S.STATUS_SUCCESS, end_ts=datetime.now(timezone.utc).isoformat(),
                               total_records=0, valid_records=0, quarantine_records=0, **known)
        except Exception as exc:
            table.save_one(run_status=S.STATUS_FAILED, end_ts=datetime.now(timezone.utc).isoformat(),
                           error_message=str(exc), **known)
            raise

    return handle


def start_ingest(spark: SparkSession, log_uri: str, settings: S.LakeSettings, *,
                 reader_name: str = "ingest", clock: str = PROCESSING,
                 iterator_type: str = shard_log.TRIM_HORIZON,
                 max_files_per_trigger: int | None = None,
                 available_now: bool = False, processing_time: str = "10 seconds",
                 checkpoint: str | None = None, **ingest_options) -> StreamingQuery:
    """Start the ingest query; ``available_now`` drains what is there and stops."""
    checkpoint = checkpoint or f"{settings.checkpoints}/{reader_name}"
    source = stream_source(spark, log_uri, checkpoint=checkpoint, iterator_type=iterator_type,
                           max_files_per_trigger=max_files_per_trigger)
    writer = (source.writeStream
              .queryName(reader_name)
              .option("checkpointLocation", checkpoint)
              .foreachBatch(batch_handler(settings, reader_name, checkpoint, clock, **ingest_options)))
    writer = (writer.trigger(availableNow=True) if available_now
              else writer.trigger(processingTime=processing_time))
    return writer.start()

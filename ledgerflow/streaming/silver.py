"""Bronze to Silver as a stream (D1 streaming form, D2).

Bronze NDJSON is read with the file stream source and a fixed schema,
the event time becomes a TIMESTAMP, and duplicates of a transaction id
are dropped within the watermark delay (``dropDuplicatesWithinWatermark``
keeps state only for ids seen within the delay, so state stays bounded).
The result is appended to Silver as Parquet partitioned by event date.
A copy arriving later than the delay is not matched; the batch
``layers.silver_dedup`` handles full history.
"""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from .. import schema as S
from ..operators.layers import MONEY, dedup_stream


def start_silver(spark: SparkSession, settings: S.LakeSettings, *, delay: str = "1 hour",
                 available_now: bool = False, processing_time: str = "1 minute",
                 max_files_per_trigger: int | None = None,
                 checkpoint: str | None = None) -> StreamingQuery:
    schema = T.StructType(list(S.BRONZE_SCHEMA.fields) + [
        T.StructField("run_id", T.StringType()),
        *[T.StructField(c, T.StringType()) for c in ("year", "month", "day")],
    ])
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    bronze = reader.json(settings.bronze)
    typed = bronze.select(
        *[F.col(f) for f in S.TXN_FIELDS if f not in ("transaction_ts", "amount")],
        F.col("amount").cast(MONEY).alias("amount"),
        F.to_timestamp("transaction_ts").alias("event_ts"),
        F.col("run_id"),
    )
    deduped = dedup_stream(typed, event_time="event_ts", delay=delay)
    out = deduped.withColumn("event_date", F.to_date("event_ts"))
    writer = (out.writeStream.format("parquet")
              .option("path", settings.silver)
              .option("checkpointLocation", checkpoint or f"{settings.checkpoints}/silver")
              .partitionBy("event_date")
              .outputMode("append"))
    writer = (writer.trigger(availableNow=True) if available_now
              else writer.trigger(processingTime=processing_time))
    return writer.start()

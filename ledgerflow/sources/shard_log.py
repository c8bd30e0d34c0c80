"""A sharded record log landed as Parquet.

Records of a stream are landed as ``shard_id`` partitions holding
``sequence_number, arrival_ts, partition_key, data``.  The same folder
is read in batch (bounded reads, audits, resumes) and as a file stream
(``streaming.ingest``).  A real stream connector can replace the log
behind the same schema.

Reads are declarative filters: ``shard_id`` prunes partitions, the
position and time filters reach the Parquet scan as pushed filters.
"""

from __future__ import annotations

from typing import Mapping

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

TRIM_HORIZON = "TRIM_HORIZON"
LATEST = "LATEST"

LOG_SCHEMA = T.StructType([
    T.StructField("sequence_number", T.LongType()),
    T.StructField("arrival_ts", T.TimestampType()),
    T.StructField("partition_key", T.StringType()),
    T.StructField("data", T.BinaryType()),
    T.StructField("shard_id", T.StringType()),
])


def land(records: DataFrame, uri: str, mode: str = "append",
         records_per_file: int | None = None) -> None:
    """Append records (``shard_id, sequence_number, arrival_ts,
    partition_key, data``) to the log, one folder per shard.

    Each task sorts its rows by shard and sequence, so every file holds
    one shard's records in order.  Rows are gathered by shard, so the files
    grow with shards plus data, not with shards times tasks; a shard holding
    a large share of the stream is cut and written by many tasks.
    """
    ordered = records.select(*[f.name for f in LOG_SCHEMA.fields]).hint("rebalance", "shard_id") \
        .sortWithinPartitions("shard_id", "sequence_number")
    writer = ordered.write.mode(mode).partitionBy("shard_id")
    if records_per_file:
        writer = writer.option("maxRecordsPerFile", records_per_file)
    writer.parquet(uri)


def read(spark: SparkSession, uri: str) -> DataFrame:
    """Bounded read of everything in the log now (R2 over all shards)."""
    return spark.read.schema(LOG_SCHEMA).parquet(uri)


BROADCAST_SHARDS = 10_000


def shard_ids(log: DataFrame) -> DataFrame:
    """Every shard id."""
    return log.select("shard_id").distinct()


def drain(log: DataFrame, shard_id: str | None = None,
          iterator_type: str = TRIM_HORIZON, started_at=None,
          after: Mapping[str, int] | DataFrame | None = None,
          limit: int | None = None) -> DataFrame:
    """Records of one or all shards.

    ``iterator_type`` LATEST keeps records that arrived at or after
    ``started_at``; ``after`` resumes past a position per shard (a dict or
    a ``shard_id, sequence_number`` frame); ``limit`` keeps the first
    records of each shard in sequence order.
    """
    out = log
    if shard_id is not None:
        out = out.filter(F.col("shard_id") == shard_id)
    if iterator_type == LATEST:
        if started_at is None:
            raise ValueError("LATEST needs the instant the reader started")
        out = out.filter(F.col("arrival_ts") >= F.lit(started_at).cast("timestamp"))
    elif iterator_type != TRIM_HORIZON:
        raise ValueError(f"unknown iterator type {iterator_type!r}")
    if after is not None:
        if isinstance(after, Mapping) and shard_id is not None:
            # one shard: a plain bound that reaches the Parquet row-group stats
            if shard_id in after:
                out = out.filter(F.col("sequence_number") > F.lit(int(after[shard_id])))
        elif isinstance(after, Mapping):
            cond = F.lit(False)
            for shard, seq in after.items():
                cond = cond | ((F.col("shard_id") == shard) & (F.col("sequence_number") > seq))
            known = F.col("shard_id").isin(list(after.keys()))
            out = out.filter(cond | ~known)
        else:
            # one row per shard; sent to the log where it is small, so that a
            # shard with much of the log is not gathered for the join
            pos = after.select("shard_id", F.col("sequence_number").alias("_after"))
            pos = F.broadcast(pos) if pos.count() <= BROADCAST_SHARDS else pos
            out = (out.join(pos, "shard_id", "left")
                   .filter(F.col("_after").isNull() | (F.col("sequence_number") > F.col("_after")))
                   .drop("_after"))
    if limit is not None:
        # row_number <= k is planned as a per-task group limit before the
        # shuffle, so a large shard ships at most k rows per task
        w = Window.partitionBy("shard_id").orderBy("sequence_number")
        out = out.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= limit).drop("_rn")
    return out


def positions(log: DataFrame) -> DataFrame:
    """Last sequence number per shard: a checkpoint to resume from."""
    return log.groupBy("shard_id").agg(F.max("sequence_number").alias("sequence_number"))


def audit(log: DataFrame) -> DataFrame:
    """Records per shard and in total (R10); ``shard_id`` NULL is the total."""
    return log.rollup("shard_id").agg(
        F.count(F.lit(1)).alias("records"),
        F.min("sequence_number").alias("first_sequence"),
        F.max("sequence_number").alias("last_sequence"),
    )

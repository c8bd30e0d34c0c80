"""Bronze / Quarantine sinks (S1-S4) and Silver Parquet.

Zones are day-partitioned NDJSON (``year=YYYY/month=MM/day=DD``) keyed by
processing time.  A micro-batch can also be written under its own
``run_id=`` folder: with dynamic partition overwrite a replayed batch
replaces exactly its own files.  Bulk loads that carry many runs in one
frame keep ``run_id`` as a column instead, so the folder count grows
with days, not with runs.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schema as S
from ..functions import formats as FM

DAY_COLUMNS = ("year", "month", "day")


def with_day_partition(df: DataFrame, now: str = "_now") -> DataFrame:
    return df.select("*", *FM.partition_columns(F.col(now)))


def write_ndjson(df: DataFrame, uri: str, partition_by: Sequence[str] = DAY_COLUMNS,
                 mode: str = "append", rows_per_file: int = 0) -> None:
    """NDJSON with nulls kept, one object per line.

    ``rows_per_file`` starts a new file within a task once one is that
    long (0: never); the write keeps the width of its input.

    Callers skip the call when their count is zero: an empty write would
    still leave a marker file behind.  ``overwrite`` replaces only the
    partitions present in ``df`` (dynamic partition overwrite).
    """
    (df.write.mode(mode)
       .option("partitionOverwriteMode", "dynamic")
       .option("ignoreNullFields", "false")
       .option("compression", "none")
       .option("maxRecordsPerFile", rows_per_file)
       .partitionBy(*partition_by)
       .json(uri))


def read_bronze(spark: SparkSession, uri: str) -> DataFrame:
    """Bronze read-back with a fixed schema; day columns stay text.

    ``_quality_warnings`` is null in rows written without warning rules.
    """
    schema = T.StructType(list(S.BRONZE_SCHEMA.fields) + [
        T.StructField("run_id", T.StringType()),
        T.StructField("_quality_warnings", T.ArrayType(T.StringType())),
    ])
    return _read_zone(spark, uri, schema)


def read_quarantine(spark: SparkSession, uri: str) -> DataFrame:
    schema = T.StructType(list(S.QUARANTINE_SCHEMA.fields) + [
        T.StructField("run_id", T.StringType()),
    ])
    return _read_zone(spark, uri, schema)


def _read_zone(spark: SparkSession, uri: str, schema: T.StructType) -> DataFrame:
    full = T.StructType(list(schema.fields) + [
        T.StructField(c, T.StringType()) for c in DAY_COLUMNS])
    return spark.read.schema(full).json(uri)


def bronze_to_silver_parquet(spark: SparkSession, bronze_uri: str, silver_uri: str) -> None:
    """Bronze NDJSON to typed Parquet, same day layout.

    The days read are replaced, so a second run doubles nothing.
    """
    bronze = read_bronze(spark, bronze_uri)
    typed = bronze.select(
        *[c for c in bronze.columns if c != "transaction_ts"],
        F.to_timestamp("transaction_ts").alias("transaction_ts"),
    )
    (typed.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(*DAY_COLUMNS).parquet(silver_uri))

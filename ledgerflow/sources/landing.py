"""Landing zone for batch files awaiting validation (D5) and the per-file
manifest check (D6).

Landed files hold one record per line as base64 of its bytes, so a record
may hold any byte, line ends included.  ``read_landing`` turns them into
the same raw frame the stream produces (``data`` bytes plus the file
name), so decode and validation are the functions used for the stream;
``encoded=False`` reads files of plain lines that others have landed.  A manifest table written by the sender (file, expected rows,
SHA-256, schema version) is checked against what actually landed: row
counts come from one aggregate over the text read, checksums from the
``binaryFile`` read of the same folder (every file that the read of the
records sees, whatever its name; at most 2 GB each), joined on the file
path.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SCHEMA_VERSION = "txn-v1"


def land_records(records: DataFrame, uri: str, partition_by: str = "shard_id") -> None:
    """Write raw records as text files, one base64 line per record."""
    line = F.regexp_replace(F.base64("data"), r"[\r\n]", "")
    (records.select(line.alias("value"), partition_by)
     .write.mode("append").partitionBy(partition_by).text(uri))


def read_landing(spark: SparkSession, uri: str, encoded: bool = True) -> DataFrame:
    """Raw frame from landed files: ``data`` (bytes) and ``source_file``.

    A line that is not base64 comes back as its own bytes, so decoding
    quarantines it instead of failing the read.
    """
    text = spark.read.option("recursiveFileLookup", "false").text(uri)
    plain = F.col("value").cast("binary")
    data = F.coalesce(F.expr("try_to_binary(value, 'base64')"), plain) if encoded else plain
    return text.select(data.alias("data"), F.col("_metadata.file_path").alias("source_file"),
                       *[c for c in text.columns if c != "value"])


def file_checksums(spark: SparkSession, uri: str) -> DataFrame:
    """``source_file, bytes, sha256`` of every landed file."""
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(uri))
    return files.select(F.col("path").alias("source_file"), F.col("length").alias("bytes"),
                        F.sha2(F.col("content"), 256).alias("sha256"))


def build_manifest(spark: SparkSession, uri: str) -> DataFrame:
    """The sender's manifest of a landed folder: rows, checksum, version."""
    counts = read_landing(spark, uri).groupBy("source_file").agg(
        F.count(F.lit(1)).alias("expected_rows"))
    return (file_checksums(spark, uri).join(counts, "source_file", "left")
            .fillna({"expected_rows": 0})
            .withColumn("schema_version", F.lit(SCHEMA_VERSION)))


def check_manifest(spark: SparkSession, uri: str, manifest: DataFrame,
                   schema_version: str = SCHEMA_VERSION) -> DataFrame:
    """Per manifest entry: actual rows and checksum, and a status."""
    actual_rows = read_landing(spark, uri).groupBy("source_file").agg(
        F.count(F.lit(1)).alias("actual_rows"))
    actual = file_checksums(spark, uri).join(actual_rows, "source_file", "left") \
        .select("source_file", F.col("sha256").alias("actual_sha256"),
                F.coalesce("actual_rows", F.lit(0)).alias("actual_rows"))
    joined = manifest.join(actual, "source_file", "full_outer")
    status = (F.when(F.col("expected_rows").isNull(), F.lit("UNLISTED"))
              .when(F.col("actual_sha256").isNull(), F.lit("MISSING"))
              .when(F.col("schema_version") != schema_version, F.lit("SCHEMA_VERSION"))
              .when(F.col("expected_rows") != F.col("actual_rows"), F.lit("ROW_COUNT"))
              .when(F.col("sha256") != F.col("actual_sha256"), F.lit("CHECKSUM"))
              .otherwise(F.lit("OK")))
    return joined.select("source_file", "expected_rows", "actual_rows", status.alias("status"))

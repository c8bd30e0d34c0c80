"""Small helpers shared by the corpus operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path

# ASCII white space that separates words: space and U+0009..U+000D.
SPACES = " \t\n\x0b\x0c\r"
BATCH_BYTES = 4 << 20
LOCAL_PARTS = 8        # jobs that bring a bounded result to the driver
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back.

    Cuts the lineage: a lost executor costs a re-read of shared files, and
    joins on a hot key see plain exchanges on both sides, which adaptive
    execution can split.  The shuffle files of the write go when it is done:
    nothing reads them again, and otherwise they stay until the driver
    happens to collect its garbage.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key)
    spark.conf.set(key, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(key, before)
    return spark.read.schema(df.schema).parquet(path)


def local_rows(df: DataFrame):
    """Rows of a bounded result, a part of it at a time.

    Every partition is a job of its own, so a few are enough, however many
    the session's shuffles have.
    """
    return df.coalesce(LOCAL_PARTS).toLocalIterator()


def small_batches(spark: SparkSession) -> None:
    """Let batches of texts between Spark and Python hold about 4 MB.

    Spark's default (64 MB a batch, several copies of it a task) takes a
    large part of a small executor.  A setting made by the user stays as it
    is; results do not depend on it.
    """
    key, default = "spark.sql.execution.arrow.maxBytesPerBatch", "67108864b"
    if spark.conf.get(key) == default:
        spark.conf.set(key, str(BATCH_BYTES))


def trimmed(run):
    """``run`` for mapInArrow, giving its free memory back to the system at the end.

    Spark keeps Python workers for later tasks; without this each of them
    keeps the peak of every step it has run.
    """
    def wrapped(batches):
        try:
            yield from run(batches)
        finally:
            release_memory()

    return wrapped


def release_memory() -> None:
    """Collect garbage, then give freed memory back to the system."""
    import gc

    gc.collect()
    trim_memory()


def trim_memory() -> None:
    """Give freed memory of Arrow and of the C library back to the system."""
    import ctypes

    import pyarrow as pa

    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def ascii_lower(column: Column) -> Column:
    """Lower-case A-Z only; other letters stay as they are."""
    return F.translate(column, UPPER, UPPER.lower())


def text_or_empty(column: str = "text") -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def alnum_words(text: Column, lower=ascii_lower) -> Column:
    """Words of letters and digits, lower-cased; every non-ASCII character is a letter.

    A null, blank or separator-only text gives an empty array.
    """
    separators = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
    return F.array_remove(F.split(lower(F.coalesce(text, F.lit(""))), separators), "")

"""Session settings the pipeline relies on, and a shared scratch folder.

``configure`` only sets what the engine needs for correct results
(UTC session zone, last-key-wins JSON objects, string partition values)
plus adaptive execution; it never overrides cluster sizing.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

REQUIRED_CONF = {
    # Instants are stored and rendered in UTC.
    "spark.sql.session.timeZone": "UTC",
    # A JSON object with a repeated key keeps the last value (as a
    # Python dict does) instead of failing the parse.
    "spark.sql.variant.allowDuplicateKeys": "true",
    # month=04 stays the text "04" when partitions are read back.
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
    # A replayed micro-batch replaces only its own run partitions.
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}

# Generated methods larger than the JVM's JIT limit (8000 bytes of
# bytecode) would run interpreted; such stages fall back to per-operator
# code instead, which stays compiled.
PERF_CONF = {
    "spark.sql.codegen.hugeMethodLimit": "8000",
}

ADAPTIVE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    for key, value in {**REQUIRED_CONF, **PERF_CONF, **ADAPTIVE_CONF}.items():
        spark.conf.set(key, value)
    return spark


def build_session(master: str = "local[*]", shuffle_partitions: int = 8,
                  app_name: str = "ledgerflow", extra: dict | None = None) -> SparkSession:
    """Session for tests and local runs; clusters bring their own builder."""
    builder = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "8g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for key, value in {**REQUIRED_CONF, **PERF_CONF, **ADAPTIVE_CONF, **(extra or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Only a local-mode session (tests, single-node runs) gets a folder of
    its own when none is configured; a cluster must name a shared one.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        if not (sc.master == "local" or sc.master.startswith("local[")):
            raise RuntimeError(
                "spark.checkpoint.dir is not set; name a shared folder for this cluster"
            )
        current = tempfile.mkdtemp(prefix="ledgerflow-ckpt-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(current)
    return sc.getCheckpointDir() or current


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared checkpoint folder."""
    base = checkpoint_root(spark).rstrip("/")
    return f"{base}/{name}-{uuid.uuid4().hex[:12]}"


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back.

    Used where a result is needed more than once: it is computed once,
    holds no executor memory, and a lost executor costs a re-read.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(staged: DataFrame) -> None:
    """Delete the files of a staged frame that nothing reads any more."""
    spark = staged.sparkSession
    for folder in {name.rsplit("/", 1)[0] for name in staged.inputFiles()}:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)

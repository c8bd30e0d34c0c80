"""Run-metadata table (S5, D9) and its queries (Q1-Q3).

The table is append-only Parquet partitioned by ``pipeline_name`` and
``start_date`` (the day of ``start_ts``, which never changes for a run); a
save of an existing ``(pipeline_name, run_id)`` adds a newer version and
readers keep the latest one per key (last write wins): an aggregate
(``max_by``, sort-based) with a partial step per task.

A lookup by run id reads the day its id names, a time bound prunes days
before the aggregate, and the newest runs are read from the newest days
on.  ``compact`` rewrites the many small files of finished days.
"""

from __future__ import annotations

import re
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schema as S

RUN_DAY = re.compile(r"\d{4}-\d{2}-\d{2}T")
KEY = ("pipeline_name", "run_id")
_VALUE_COLUMNS = [f.name for f in S.METADATA_SCHEMA.fields if f.name not in KEY]


def metadata_rows(runs: DataFrame, *, pipeline_name: str = S.PIPELINE_NAME,
                  status: Column | None = None, end_ts: Column | None = None,
                  bronze_path: Column | None = None, quarantine_path: Column | None = None,
                  error_message: Column | None = None,
                  saved_at: Column | None = None) -> DataFrame:
    """Metadata rows from per-run counts (``run_id, _now, request_id, total,
    valid, quarantined, run_status``)."""
    null = F.lit(None).cast("string")
    return runs.select(
        F.lit(pipeline_name).alias("pipeline_name"),
        F.col("run_id"),
        (status if status is not None else F.col("run_status")).alias("run_status"),
        F.col("start_ts"),
        (end_ts if end_ts is not None else null).alias("end_ts"),
        F.col("total").cast("long").alias("total_records"),
        F.col("valid").cast("long").alias("valid_records"),
        F.col("quarantined").cast("long").alias("quarantine_records"),
        (bronze_path if bronze_path is not None else null).alias("s3_output_path"),
        (quarantine_path if quarantine_path is not None else null).alias("s3_quarantine_path"),
        (error_message if error_message is not None else null).alias("error_message"),
        F.col("request_id").alias("lambda_request_id"),
        (saved_at if saved_at is not None else F.current_timestamp()).alias("saved_at"),
    )


class MetadataTable:
    """Pipeline-run metadata stored under one URI."""

    def __init__(self, spark: SparkSession, uri: str):
        self.spark = spark
        self.uri = uri.rstrip("/")

    # -- writes -------------------------------------------------------------
    def save(self, rows: DataFrame) -> None:
        """Append rows (S5); a repeated key becomes a newer version."""
        self._write(rows, "append")

    def _write(self, rows: DataFrame, mode: str) -> None:
        (rows.select(*[f.name for f in S.METADATA_SCHEMA.fields], F.substring("start_ts", 1, 10).alias("start_date"))
         .write.mode(mode).option("partitionOverwriteMode", "dynamic")
         .partitionBy("pipeline_name", "start_date").parquet(self.uri))

    def compact(self, pipeline_name: str, before_day: str) -> None:
        """One file per day before ``before_day`` (yyyy-MM-dd), latest versions only.

        For days without running writers; the rows are staged first, as a
        table can't be read while its folders are replaced.
        """
        from ..session import scratch_path

        days = F.col("start_date") < before_day
        staged = scratch_path(self.spark, "metadata-compact")
        self._latest(self._dated().filter(F.col("pipeline_name") == pipeline_name).filter(days)).write.parquet(staged)
        rows = self.spark.read.schema(S.METADATA_SCHEMA).parquet(staged)
        self._write(rows.repartition(F.substring("start_ts", 1, 10)), "overwrite")

    def save_one(self, **values) -> None:
        """Save one run row given as keyword values (small driver-side row)."""
        row = {f.name: values.get(f.name) for f in S.METADATA_SCHEMA.fields}
        row["saved_at"] = values.get("saved_at") or datetime.now(timezone.utc)
        df = self.spark.createDataFrame([row], schema=S.METADATA_SCHEMA)
        self.save(df)

    def saved_at(self, pipeline_name: str, saved_at: datetime) -> DataFrame:
        """Rows of one save call (each call stamps its own instant)."""
        return self.versions().filter(
            (F.col("pipeline_name") == pipeline_name)
            & (F.col("saved_at") == F.lit(saved_at).cast("timestamp")))

    # -- reads --------------------------------------------------------------
    def _dated(self) -> DataFrame:
        """Every saved version with its ``start_date`` (empty before the first save)."""
        schema = T.StructType([*S.METADATA_SCHEMA.fields, T.StructField("start_date", T.StringType())])
        try:
            return self.spark.read.schema(schema).parquet(self.uri)
        except Exception as exc:  # path not created yet
            if "PATH_NOT_FOUND" in str(exc) or "does not exist" in str(exc):
                return self.spark.createDataFrame([], schema)
            raise

    def versions(self) -> DataFrame:
        """Every saved version."""
        return self._dated().drop("start_date")

    @staticmethod
    def _latest(versions: DataFrame) -> DataFrame:
        # saved_at breaks ties; a run's later state (SUCCESS after RUNNING)
        # is always saved later
        newest = versions.groupBy(*KEY).agg(
            F.max_by(F.struct(*_VALUE_COLUMNS), F.col("saved_at")).alias("r"))
        return newest.select(*KEY, *[F.col("r")[c].alias(c) for c in _VALUE_COLUMNS])

    def latest(self, pipeline_name: str | None = None, since: str | None = None) -> DataFrame:
        """One row per key, the most recently saved version, of runs started from ``since`` on."""
        v = self._dated()
        if pipeline_name is not None:
            v = v.filter(F.col("pipeline_name") == pipeline_name)
        if since is not None:
            # start_ts is the same in all versions of a run, so the bound
            # may come before the aggregate
            v = v.filter((F.col("start_date") >= since[:10]) & (F.col("start_ts") >= since))
        return self._latest(v)

    def get(self, pipeline_name: str, run_id: str) -> DataFrame:
        """Point lookup by key (Q1); zero or one row."""
        v = self._dated().filter((F.col("pipeline_name") == pipeline_name) & (F.col("run_id") == run_id))
        if RUN_DAY.match(run_id):       # the id begins with the start time
            v = v.filter(F.col("start_date") == run_id[:10])
        return self._latest(v)

    def last_n(self, pipeline_name: str, n: int) -> DataFrame:
        """The ``n`` newest runs of a pipeline, newest first (Q2).

        ``run_id`` text starts with the run's start time, so text order
        is time order.  Days are taken from the newest on, twice as many
        each time, until they hold ``n`` runs.
        """
        days = self._days(pipeline_name)
        take = 1
        while take < len(days) and self.latest(pipeline_name, since=days[take - 1]).limit(n).count() < n:
            take *= 2
        since = days[take - 1] if take < len(days) else None
        return self.latest(pipeline_name, since=since).orderBy(F.col("run_id").desc()).limit(n)

    def _days(self, pipeline_name: str) -> list[str]:
        """Days that have runs, newest first, from the folder names (one per day)."""
        jvm, conf = self.spark._jvm, self.spark._jsc.hadoopConfiguration()
        folder = jvm.org.apache.hadoop.fs.Path(f"{self.uri}/pipeline_name={pipeline_name}")
        system = folder.getFileSystem(conf)
        if not system.exists(folder):
            return []
        names = [status.getPath().getName() for status in system.listStatus(folder)]
        return sorted((x.split("=", 1)[1] for x in names if x.startswith("start_date=")), reverse=True)

    def by_status(self, status: str, since: str | None = None,
                  pipeline_name: str | None = None) -> DataFrame:
        """Runs in ``status`` ordered by ``start_ts``, optionally since a time (Q3)."""
        runs = self.latest(pipeline_name, since).filter(F.col("run_status") == status)
        return runs.orderBy("start_ts", "run_id")

    def recent(self, status: str = S.STATUS_FAILED, hours: float = 24.0,
               now: datetime | None = None, pipeline_name: str | None = None) -> DataFrame:
        """Runs in ``status`` that started in the last ``hours`` (Q3's stated use)."""
        from datetime import timedelta

        moment = (now or datetime.now(timezone.utc)) - timedelta(hours=hours)
        return self.by_status(status, since=moment.astimezone(timezone.utc).isoformat(),
                              pipeline_name=pipeline_name)

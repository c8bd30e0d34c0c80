"""The batch handler (T8): decode, validate, split, write, record.

``ingest`` works on any frame of raw records holding one run (a
micro-batch) or many runs (a bulk load, each row carrying its run's
clock and request id).  It reads the raw data once: the classified rows
are staged once in the shared scratch folder, counted per run, written to
Bronze and Quarantine from there, and the per-run counts become the
metadata rows, written as a DataFrame.  The staged copy is deleted at the
end.

Order matches the surveyed handler: files first, metadata last, so a
crash in between leaves files and no final row; the replay rewrites the
run.  With ``record_running`` a RUNNING row is saved before any file and
replaced by the final row (D9); a failure saves FAILED rows with the
error text and re-raises.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime, timezone
from typing import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schema as S
from ..functions import decode as D
from ..functions import formats as FM
from ..functions import rules as R
from ..operators import route, sinks
from ..operators.metadata import MetadataTable, metadata_rows
from ..session import discard, stage

_PATH_ESCAPES = [("%", "%25"), ('"', "%22"), ("#", "%23"), ("'", "%27"), ("*", "%2A"),
                 ("/", "%2F"), (":", "%3A"), ("=", "%3D"), ("?", "%3F"), ("\\", "%5C"),
                 ("{", "%7B"), ("[", "%5B"), ("]", "%5D"), ("^", "%5E")]


def escaped_partition(col: Column) -> Column:
    """Partition folder text of a value, as the file writer escapes it."""
    for raw, esc in _PATH_ESCAPES:
        col = F.replace(col, F.lit(raw), F.lit(esc))
    return col


@dataclass(frozen=True)
class RunSummary:
    """The handler's return value for one run."""

    run_id: str
    total: int
    valid: int
    quarantined: int
    bronze_s3_uri: str | None
    quarantine_s3_uri: str | None
    run_status: str


def _utc_now() -> datetime:
    return datetime.now(timezone.utc)


def _iso_now() -> str:
    return _utc_now().isoformat()


def ingest(raw: DataFrame, settings: S.LakeSettings, *,
           now: Column | None = None, run_ts: Column | None = None,
           request_id: Column | None = None, quarantine_ts: Column | None = None,
           run_partition: bool = True, record_running: bool = False,
           data: str = "data", threshold_seconds: int = S.DRIFT_THRESHOLD_SECONDS,
           rules: Sequence[R.Rule] | None = None,
           pipeline_name: str = S.PIPELINE_NAME,
           rows_per_file: int = 1_000_000,
           exact_decode_messages: bool = True) -> DataFrame:
    """Process raw records; return the saved metadata rows (one per run).

    The writes start a new file every ``rows_per_file`` rows.  A bulk load
    (``run_partition=False``) gathers the rows of a day first, a large day in
    several tasks: the files grow with days plus data, not with days times
    tasks.  A run with a folder of its own keeps the width of the input.
    ``exact_decode_messages`` puts the parser's own message in the decode
    reasons of the files (a Python step over the quarantined rows only);
    without it they hold a fixed text.
    """
    spark = raw.sparkSession
    table = MetadataTable(spark, settings.metadata)
    if quarantine_ts is None:
        quarantine_ts = F.current_timestamp()
    classified = route.classify(raw, now=now, run_ts=run_ts, request_id=request_id,
                                quarantine_ts=quarantine_ts, data=data,
                                threshold_seconds=threshold_seconds, rules=rules)
    classified = sinks.with_day_partition(classified, "_run_ts")

    def by_day(rows: DataFrame) -> DataFrame:
        days = [c for c in (*sinks.DAY_COLUMNS, "partition_path") if c in rows.columns]
        return rows if run_partition else rows.hint("rebalance", *days)

    runs = staged = None
    try:
        # stage only what the counts and the two writes read, not the parse
        # intermediates (text copy, payload and field VARIANTs)
        staged = classified = stage(route.routed(
            classified, keep=("run_id", "_run_ts", "request_id", *sinks.DAY_COLUMNS), data=data,
            warnings=any(r.severity == S.SEVERITY_WARNING for r in rules or ())), "routed")
        runs = route.run_counts(classified, keys=("run_id", "_run_ts", "request_id"))
        runs = stage(runs.select(
            "*", FM.iso_offset(F.col("_run_ts")).alias("start_ts"),
            FM.partition_path(F.col("_run_ts")).alias("partition_path"),
        ).transform(by_day), "runs")
        totals = runs.agg(F.sum("valid").alias("valid"),
                          F.sum("quarantined").alias("quarantined")).first()
        n_valid = int(totals["valid"] or 0)
        n_quarantined = int(totals["quarantined"] or 0)

        if record_running:
            table.save(metadata_rows(runs, pipeline_name=pipeline_name,
                                     status=F.lit(S.STATUS_RUNNING),
                                     saved_at=F.lit(_utc_now()).cast("timestamp")))

        layout = [*sinks.DAY_COLUMNS, "run_id"] if run_partition else list(sinks.DAY_COLUMNS)
        # a run's own folder is replaced on replay; shared day folders append
        mode = "overwrite" if run_partition else "append"
        keep = ("run_id", *sinks.DAY_COLUMNS)
        if n_valid > 0:
            bronze = classified.filter(F.col("is_valid")).select(*keep, "_bronze.*")
            sinks.write_ndjson(by_day(bronze), settings.bronze, partition_by=layout, mode=mode,
                               rows_per_file=rows_per_file)
        if n_quarantined > 0:
            quarantine = classified.filter(~F.col("is_valid")).select(*keep, "_quarantine.*")
            if exact_decode_messages:
                quarantine = D.with_exact_decode_messages(quarantine)
            sinks.write_ndjson(by_day(quarantine), settings.quarantine, partition_by=layout, mode=mode,
                               rows_per_file=rows_per_file)

        def run_path(base: str) -> Column:
            path = F.concat(F.lit(base.rstrip("/") + "/"), F.col("partition_path"))
            if run_partition:
                path = F.concat(path, F.lit("/run_id="), escaped_partition(F.col("run_id")))
            return path

        stamp = _utc_now()
        final = metadata_rows(
            runs, pipeline_name=pipeline_name,
            end_ts=F.lit(stamp.isoformat()),
            bronze_path=F.when(F.col("valid") > 0, run_path(settings.bronze)),
            quarantine_path=F.when(F.col("quarantined") > 0, run_path(settings.quarantine)),
            saved_at=F.lit(stamp).cast("timestamp"),
        )
        table.save(final)
        # the rows just saved, read back by their save stamp (lazy, pruned)
        return table.saved_at(pipeline_name, stamp)
    except Exception as exc:
        if runs is not None:
            try:
                table.save(metadata_rows(runs, pipeline_name=pipeline_name,
                                         status=F.lit(S.STATUS_FAILED),
                                         end_ts=F.lit(_iso_now()),
                                         error_message=F.lit(str(exc))))
            except Exception:  # the original error is the one to surface
                pass
        raise
    finally:
        for done in (staged, runs):
            if done is not None:
                discard(done)


def process_batch(spark: SparkSession, raw: DataFrame, request_id: str,
                  settings: S.LakeSettings, now: datetime | None = None,
                  **kwargs) -> RunSummary:
    """One micro-batch with one clock, as the surveyed handler runs it.

    ``now`` defaults to the wall clock; microseconds are cut so the run id
    and the freshness rule use the same second.
    """
    moment = (now or datetime.now(timezone.utc)).astimezone(timezone.utc).replace(microsecond=0)
    when = F.lit(moment).cast("timestamp")
    run_id = f"{moment.isoformat()}___{request_id}"
    known = {"pipeline_name": kwargs.get("pipeline_name", S.PIPELINE_NAME), "run_id": run_id,
             "start_ts": moment.isoformat(), "lambda_request_id": request_id}
    table = MetadataTable(spark, settings.metadata)
    if kwargs.pop("record_running", False):
        table.save_one(run_status=S.STATUS_RUNNING, **known)
    try:
        rows = ingest(raw, settings, now=when, request_id=F.lit(request_id), **kwargs)
    except Exception as exc:
        # from what the driver knows, whatever part of the run failed
        table.save_one(run_status=S.STATUS_FAILED, end_ts=_iso_now(), error_message=str(exc), **known)
        raise
    found = rows.filter(F.col("run_id") == run_id).collect()
    if found:
        r = found[0]
        return RunSummary(run_id=r["run_id"], total=r["total_records"],
                          valid=r["valid_records"], quarantined=r["quarantine_records"],
                          bronze_s3_uri=r["s3_output_path"],
                          quarantine_s3_uri=r["s3_quarantine_path"],
                          run_status=r["run_status"])
    # an empty batch has no rows to count: SUCCESS with zero counts
    table.save_one(run_status=S.STATUS_SUCCESS, end_ts=_iso_now(), total_records=0,
                   valid_records=0, quarantine_records=0, **known)
    return RunSummary(run_id=run_id, total=0, valid=0, quarantined=0,
                      bronze_s3_uri=None, quarantine_s3_uri=None,
                      run_status=S.STATUS_SUCCESS)


def raw_from_payloads(spark: SparkSession, payloads: Sequence[bytes]) -> DataFrame:
    """Small raw frame from a list of byte payloads (tests, one event)."""
    return spark.createDataFrame([(bytearray(p),) for p in payloads], "data binary")


def ingest_landing(spark: SparkSession, landing_uri: str, settings: S.LakeSettings, *,
                   now: datetime | None = None, **kwargs) -> DataFrame:
    """Landed batch files through the same handler (D5): one run per file.

    The run's request id is the file name, the clock is one processing
    instant for the whole load, and Bronze / Quarantine keep ``run_id`` as
    a column under the day folders (a folder per file would not scale).
    """
    from ..sources import landing

    moment = (now or datetime.now(timezone.utc)).astimezone(timezone.utc).replace(microsecond=0)
    raw = landing.read_landing(spark, landing_uri)
    file_name = F.regexp_extract(F.col("source_file"), r"([^/]+)$", 1)
    kwargs.setdefault("run_partition", False)
    return ingest(raw, settings, now=F.lit(moment).cast("timestamp"),
                  request_id=F.concat(F.lit("landing-"), file_name), **kwargs)

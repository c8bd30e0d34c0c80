"""Registered queries: each takes ``(spark, sf_dir)`` and returns a DataFrame.

All of them read the given tables (``events`` through the fixture
records) so their work grows with the data.  The DuckDB counterparts live in ``plans.oracle``.
"""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schema as S
from ..functions import decode as D
from ..functions import formats as FM
from ..operators import route
from ..session import configure
from ..sources.fixture import raw_records


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """One of the given tables, in a session set up for this pipeline."""
    configure(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")


# What is built once per state of the table: analysed frames (only the plan
# is reused, every query still reads its data) and scratch loads.  The key
# holds the application and a fingerprint of the table's files, so a table
# that grows or changes is planned and loaded anew.
_BUILT: dict[tuple[str, str, str, str], object] = {}


def _fingerprint(spark: SparkSession, sf_dir: str) -> str:
    """Checksum of path, size and modification time of the files of ``events``."""
    configure(spark)
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{sf_dir.rstrip('/')}/events.parquet")
    listed = path.getFileSystem(spark._jsc.hadoopConfiguration()).listFiles(path, True)
    found = []
    while listed.hasNext():
        status = listed.next()
        found.append(f"{status.getPath()} {status.getLen()} {status.getModificationTime()}")
    return hashlib.sha256("\n".join(sorted(found)).encode()).hexdigest()


def _once(spark: SparkSession, sf_dir: str, name: str, build, alive=lambda built: True):
    """``build()`` once per application and state of the table; again if not ``alive``."""
    key = (spark.sparkContext.applicationId, sf_dir, name, _fingerprint(spark, sf_dir))
    if key not in _BUILT or not alive(_BUILT[key]):
        _BUILT[key] = build()
    return _BUILT[key]


def _frame(spark: SparkSession, sf_dir: str, name: str, build) -> DataFrame:
    return _once(spark, sf_dir, name, build, alive=lambda frame: frame.sparkSession is spark)


def _exists(spark: SparkSession, uri: str) -> bool:
    """Whether a path is there, on any file system Spark reaches."""
    path = spark._jvm.org.apache.hadoop.fs.Path(uri)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)


def fixture_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _frame(spark, sf_dir, "raw", lambda: raw_records(load(spark, sf_dir, "events")))


def classified(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every fixture record decoded and validated against its batch clock.

    One frame carries all micro-batches: the batch clock and the request
    id are per-row columns, so the result equals running the batch
    handler once per batch.
    """
    return _frame(spark, sf_dir, "classified", lambda: route.classify(
        fixture_raw(spark, sf_dir),
        now=F.col("batch_now"),
        request_id=F.concat(F.lit("batch-"), F.col("batch_id").cast("string")),
        quarantine_ts=F.col("batch_now"),
    ))


def _reason_kind(reason):
    """Reason code with the parser message cut (decode errors only)."""
    return F.regexp_replace(reason, r"^(DECODE_ERROR:(?:utf8|json)):.*$", "$1")


# ---------------------------------------------------------------------------
# Flagship: one summary row per micro-batch
# ---------------------------------------------------------------------------
def batch_run_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = classified(spark, sf_dir)
    counts = route.run_counts(c, keys=("batch_id", "run_id", "_now"))
    return counts.select(
        "batch_id", "run_id",
        FM.iso_offset(F.col("_now")).alias("start_ts"),
        "total", "valid", "quarantined", "run_status",
        FM.partition_path(F.col("_now")).alias("partition_path"),
    )


def decode_outcome_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = D.decode(fixture_raw(spark, sf_dir))
    outcome = F.when(F.col("_decode_kind") == D.KIND_OK, F.lit("ok")).otherwise(
        _reason_kind(F.col("_decode_reason")))
    return c.groupBy(outcome.alias("decode_outcome")).agg(F.count(F.lit(1)).alias("records"))


def decode_errors_b64(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, failed = D.split(fixture_raw(spark, sf_dir))
    return failed.select("event_id", "batch_id", D.raw_b64(F.col("data")).alias("_raw_b64"),
                         F.col("_decode_reason").alias("reasons"),
                         FM.iso_offset(F.col("batch_now")).alias("_quarantine_ts"))


def field_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = classified(spark, sf_dir)
    return (c.select(F.explode("reasons").alias("reason"))
            .groupBy("reason").agg(F.count(F.lit(1)).alias("records")))


def reject_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Outcome of one record per event, over every way a record can fail."""
    from ..sources.faults import raw_variants

    c = route.classify(raw_variants(load(spark, sf_dir, "events")), now=F.col("now"))
    return c.select("event_id", "variant", "is_valid", F.array_join("reasons", "|").alias("reasons"))


# Version 2 of the stored rules, as a change of version 1: a lower limit, a
# currency less, the form of merchant ids, two rules that only warn, one
# that is gone.
def _second_version() -> list[tuple]:
    from ..functions import rule_table as RT

    changed = {
        "TXN_AMOUNT": ({"low": "0", "high": "100"}, S.SEVERITY_ERROR),
        "TXN_CURRENCY": ({"values": json.dumps([c for c in S.CURRENCIES if c != "CAD"])}, S.SEVERITY_ERROR),
        "TXN_CHANNEL": ({"values": json.dumps(S.CHANNELS)}, S.SEVERITY_WARNING),
        "TXN_002": ({"threshold_seconds": "600"}, S.SEVERITY_WARNING),
    }
    rows = [(version, position, rule_id, field, check, *changed.get(rule_id, (arguments, severity)))
            for version, position, rule_id, field, check, arguments, severity in RT.default_rows(2)
            if rule_id != "TXN_MCC"]
    return [*rows, (2, len(rows) + 1, "MERCHANT_FORM", "merchant_id", "pattern",
                    {"pattern": "^MERCH-[0-9A-Ea-e]"}, S.SEVERITY_ERROR)]


def _stored_rules(spark: SparkSession) -> DataFrame:
    """A stored rule table with two versions, read back."""
    from ..functions import rule_table as RT
    from ..session import scratch_path

    configure(spark)
    uri = scratch_path(spark, "rules")
    RT.save_rules(spark, RT.default_rows(1) + _second_version(), uri)
    return RT.read_rules(spark, uri)


def reject_matrix_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``reject_matrix`` with the rules compiled from a stored table."""
    from ..functions import rule_table as RT
    from ..sources.faults import raw_variants

    rules = RT.compile_rules(_stored_rules(spark), 1)
    c = route.classify(raw_variants(load(spark, sf_dir, "events")), now=F.col("now"), rules=rules)
    return c.select("event_id", "variant", "is_valid", F.array_join("reasons", "|").alias("reasons"))


def rule_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records by outcome under two stored rule versions, in one pass."""
    from ..functions import rule_table as RT

    stored = _stored_rules(spark)
    objects, _ = D.split(fixture_raw(spark, sf_dir))
    objects = objects.select("_payload", "batch_now")
    compared = RT.compare_versions(objects, {v: RT.compile_rules(stored, v) for v in (1, 2)}, F.col("batch_now"))
    each = compared.select(F.inline("outcomes"))

    def found(reasons: str, outcome: str):
        return F.transform(reasons, lambda r: F.struct(F.lit(outcome).alias("outcome"), r.alias("reason")))

    accepted = F.when(F.size("errors") == 0, F.array(F.struct(F.lit("ACCEPTED").alias("outcome"),
                                                              F.lit("").alias("reason"))))
    rows = F.concat(found("errors", S.SEVERITY_ERROR), found("warnings", S.SEVERITY_WARNING),
                    F.coalesce(accepted, F.array().cast("array<struct<outcome:string,reason:string>>")))
    return (each.select("version", F.inline(rows)).groupBy("version", "outcome", "reason")
            .agg(F.count(F.lit(1)).alias("records")))


DRIFT_OVERRIDE_SECONDS = 600


def drift_override(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records flagged under a freshness threshold other than the default."""
    c = route.classify(fixture_raw(spark, sf_dir), now=F.col("batch_now"),
                       threshold_seconds=DRIFT_OVERRIDE_SECONDS)
    return c.filter(F.array_contains("reasons", S.TIMESTAMP_DRIFT)).select("event_id", "batch_id")


def shard_resume(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First records of each shard after a stored position."""
    from ..sources import shard_log

    log = shard_log.read(spark, fixture_log(spark, sf_dir))
    stored = log.groupBy("shard_id").agg(
        F.floor((F.min("sequence_number") + F.max("sequence_number")) / 2).alias("sequence_number"))
    after = {row["shard_id"]: row["sequence_number"] for row in stored.collect()}   # one row per shard
    records = shard_log.drain(log, after=after, limit=RESUME_LIMIT)
    return records.select("shard_id", "sequence_number")


RESUME_LIMIT = 25


def drift_flagged(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = classified(spark, sf_dir)
    ts = F.col("_ts_transaction_ts")
    return c.filter(F.array_contains("reasons", S.TIMESTAMP_DRIFT)).select(
        "event_id", "batch_id",
        FM.iso_z(ts).alias("transaction_ts"),
        FM.iso_offset(F.col("_now")).alias("reference_now"),
        (F.unix_micros(F.col("_now")) - F.unix_micros(ts)).alias("drift_us"),
    )


def bronze_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return route.bronze_rows(classified(spark, sf_dir), keep=("event_id", "batch_id", "run_id"))


def quarantine_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    q = route.quarantine_rows(classified(spark, sf_dir), keep=("event_id", "batch_id", "run_id"))
    return q.select(
        "event_id", "batch_id", "run_id", "_raw_b64", "payload_json", *S.TXN_FIELDS,
        F.array_join("_quarantine_reason", "|").alias("reasons"), "_quarantine_ts",
    )


def partition_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = fixture_raw(spark, sf_dir)
    runs = raw.select("batch_id", "batch_now").distinct()
    rid = FM.run_id(F.col("batch_now"), F.concat(F.lit("batch-"), F.col("batch_id").cast("string")))
    return runs.select(
        "batch_id",
        FM.partition_path(F.col("batch_now")).alias("partition_path"),
        F.concat(FM.partition_path(F.col("batch_now")), F.lit("/"), rid,
                 F.lit(".ndjson")).alias("object_key"),
    )


# ---------------------------------------------------------------------------
# Sinks and run metadata (S1-S5, Q1-Q3, D9, D10): a bulk load of the
# fixture into a scratch lake under the shared checkpoint folder.
# ---------------------------------------------------------------------------
def fixture_lake(spark: SparkSession, sf_dir: str) -> "S.LakeSettings":
    """Load every fixture batch through the handler once per state of the table."""
    from ..plans.batch import ingest
    from ..session import scratch_path

    def build() -> "S.LakeSettings":
        lake = S.LakeSettings(root=scratch_path(spark, "lake"))
        ingest(fixture_raw(spark, sf_dir), lake,
               now=F.col("batch_now"),
               request_id=F.concat(F.lit("batch-"), F.col("batch_id").cast("string")),
               quarantine_ts=F.col("batch_now"),
               run_partition=False, record_running=True)
        return lake

    return _once(spark, sf_dir, "lake", build, alive=lambda lake: _exists(spark, lake.metadata))


def _metadata(spark: SparkSession, sf_dir: str):
    from ..operators.metadata import MetadataTable
    return MetadataTable(spark, fixture_lake(spark, sf_dir).metadata)


def bronze_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..operators.sinks import read_bronze
    b = read_bronze(spark, fixture_lake(spark, sf_dir).bronze)
    return b.select("run_id", *S.TXN_FIELDS, "year", "month", "day")


def quarantine_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..operators.sinks import read_quarantine
    q = read_quarantine(spark, fixture_lake(spark, sf_dir).quarantine)
    return q.select("run_id", "_raw_b64", *S.TXN_FIELDS,
                    F.array_join("_quarantine_reason", "|").alias("reasons"),
                    "_quarantine_ts", "year", "month", "day")


def _metadata_view(df: DataFrame) -> DataFrame:
    return df.select(
        "pipeline_name", "run_id", "run_status", "start_ts",
        "total_records", "valid_records", "quarantine_records",
        F.coalesce(F.regexp_extract("s3_output_path", r"(year=.*)$", 1),
                   F.lit("")).alias("bronze_partition"),
        F.coalesce(F.regexp_extract("s3_quarantine_path", r"(year=.*)$", 1),
                   F.lit("")).alias("quarantine_partition"),
    )


def metadata_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _metadata_view(_metadata(spark, sf_dir).latest())


def metadata_get(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Point lookup of the run of the earliest fixture batch (Q1)."""
    table = _metadata(spark, sf_dir)
    raw = fixture_raw(spark, sf_dir)
    first = raw.agg(F.min_by("batch_now", "batch_id").alias("t"),
                    F.min("batch_id").alias("b")).first()
    run_key = f"{first['t'].strftime('%Y-%m-%dT%H:%M:%S')}+00:00___batch-{first['b']}"
    return _metadata_view(table.get(S.PIPELINE_NAME, run_key))


def metadata_last_n(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _metadata_view(_metadata(spark, sf_dir).last_n(S.PIPELINE_NAME, 5))


def metadata_by_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _metadata_view(_metadata(spark, sf_dir).by_status(
        S.STATUS_SUCCESS, since="2024-01-15T00:00:00+00:00"))


# ---------------------------------------------------------------------------
# Shard log and streaming ingest (R1-R10, T8 in a stream)
# ---------------------------------------------------------------------------
LOG_RECORDS_PER_FILE = 100_000


def fixture_log(spark: SparkSession, sf_dir: str) -> str:
    """The fixture records landed as a sharded log (arrival = batch clock)."""
    from ..session import scratch_path
    from ..sources import shard_log

    def build() -> str:
        uri = scratch_path(spark, "shard-log")
        shard_log.land(fixture_raw(spark, sf_dir).select(
            "shard_id",
            F.col("event_id").alias("sequence_number"),
            F.col("batch_now").alias("arrival_ts"),
            F.lit(None).cast("string").alias("partition_key"),
            "data"), uri, records_per_file=LOG_RECORDS_PER_FILE)
        return uri

    return _once(spark, sf_dir, "log", build, alive=lambda uri: _exists(spark, uri))


def shard_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records per shard and in total over a bounded read of the log."""
    from ..sources import shard_log
    log = shard_log.read(spark, fixture_log(spark, sf_dir))
    return shard_log.audit(log)


def stream_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Drain the log with an availableNow stream; return the Bronze read-back."""
    from ..operators.sinks import read_bronze
    from ..session import scratch_path
    from ..streaming.ingest import ARRIVAL, start_ingest

    log_uri = fixture_log(spark, sf_dir)
    lake = S.LakeSettings(root=scratch_path(spark, "stream-lake"))
    query = start_ingest(spark, log_uri, lake, reader_name="fixture_reader",
                         clock=ARRIVAL, max_files_per_trigger=16, available_now=True)
    query.awaitTermination()
    if query.exception() is not None:
        raise RuntimeError(str(query.exception()))
    return read_bronze(spark, lake.bronze).select(*S.TXN_FIELDS)


def run_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """States of a streamed run in the order they were saved (D9): the first
    attempt asks for a column that the records lack and fails before its
    counts, the restarted query replays the batch."""
    from pyspark.errors import StreamingQueryException
    from pyspark.sql import Window

    from ..operators.metadata import MetadataTable
    from ..session import scratch_path
    from ..streaming.ingest import ARRIVAL, start_ingest

    log_uri = fixture_log(spark, sf_dir)
    lake = S.LakeSettings(root=scratch_path(spark, "states-lake"))
    for options in ({"data": "no_such_column"}, {}):
        query = start_ingest(spark, log_uri, lake, reader_name="states_reader", clock=ARRIVAL,
                             available_now=True, **options)
        try:
            query.awaitTermination()
        except StreamingQueryException:
            if not options:
                raise
    order = Window.partitionBy("run_id").orderBy("saved_at")
    return MetadataTable(spark, lake.metadata).versions().select(
        F.row_number().over(order).cast("long").alias("step"), "run_status", "total_records",
        "valid_records", "quarantine_records", F.col("error_message").isNotNull().alias("has_error"))


MICRO_BATCH_SLICES = 3
MICRO_BATCH_FILES = 16             # a trigger reads at most so many files: a key's rows of it pass Python at once
DRAIN_AGE_SECONDS = 24 * 3600      # a drain closes by size; what stays open is reported as such


def micro_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batches of at most 100 records that a stateful drain of the log forms."""
    from ..session import scratch_path
    from ..streaming import batches as B

    log_uri = fixture_log(spark, sf_dir)
    target, checkpoint = scratch_path(spark, "batches"), scratch_path(spark, "batches-checkpoint")
    B.drain_batches(spark, log_uri, target, checkpoint, max_age_seconds=DRAIN_AGE_SECONDS,
                    max_files_per_trigger=MICRO_BATCH_FILES,
                    slice_by=F.floor(F.col("sequence_number") / 10) % MICRO_BATCH_SLICES)
    formed = B.closed_batches(spark, target).unionByName(B.open_batches(spark, checkpoint))
    return formed.groupBy("shard_id", "slice", "batch_number").agg(
        F.count(F.lit(1)).alias("records"), F.coalesce(F.max("closed_by"), F.lit("open")).alias("closed_by"))


# ---------------------------------------------------------------------------
# Producer (S6-S10, S14) over the fixture's valid transactions
# ---------------------------------------------------------------------------
def fixture_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Valid fixture transactions in Bronze form, keyed by ``event_id``."""
    return route.bronze_rows(classified(spark, sf_dir), keep=("event_id",))


def reject_cards_ending_in_7(batch):
    """Deterministic stand-in for a throttled put: cards ending in 7 fail."""
    return [("ProvisionedThroughputExceededException", "Rate exceeded for shard")
            if str(key).endswith("7") else None for key in batch["partition_key"]]


def producer_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..operators.producer import to_stream_records
    recs = to_stream_records(fixture_transactions(spark, sf_dir))
    return recs.select("event_id", "partition_key", F.col("data").cast("string").alias("record"))


def producer_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..operators.producer import batch_sizes, number_batches, to_stream_records
    recs = to_stream_records(fixture_transactions(spark, sf_dir))
    return batch_sizes(number_batches(recs.select("event_id", "data", "partition_key"),
                                      ["event_id"]))


def fixture_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Outcomes of one send of the valid transactions, made once per state of the table."""
    from ..operators import producer as P
    from ..session import scratch_path

    def build() -> DataFrame:
        recs = P.to_stream_records(fixture_transactions(spark, sf_dir))
        return P.send_records(recs, reject_cards_ending_in_7, order=["event_id"],
                              outcomes_uri=scratch_path(spark, "send-outcomes"))

    return _frame(spark, sf_dir, "outcomes", build)


def send_result(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..operators import producer as P
    return P.send_result(fixture_outcomes(spark, sf_dir))


def send_failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..operators import producer as P
    outcomes = fixture_outcomes(spark, sf_dir)
    return P.failed_entries(outcomes).select("ErrorCode", "ErrorMessage", "record")


def send_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..operators import producer as P
    return P.sent_out_of_order(fixture_outcomes(spark, sf_dir), ["event_id"])


def record_preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..operators.producer import preview
    return preview(fixture_transactions(spark, sf_dir), ["event_id"])


# ---------------------------------------------------------------------------
# Generators (G1-G6): one seeded transaction per event, validated
# ---------------------------------------------------------------------------
GENERATOR_SEED = 42


def generated_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..operators import generate as G
    ids = load(spark, sf_dir, "events").select(
        F.col("event_id").alias("id"), F.col("ts").cast("timestamp").alias("gen_now"))
    return G.generate_valid(
        ids,
        build=lambda pending, attempt: G.transactions(
            pending, GENERATOR_SEED, now=F.col("gen_now"), attempt=attempt),
        validate=lambda txns: G.validate_transactions(txns, now=F.col("gen_now")),
    )


def generated_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = generated_transactions(spark, sf_dir)
    return g.groupBy("currency", "auth_status", "channel").agg(
        F.count(F.lit(1)).alias("records"),
        F.count_if(F.col("amount") >= 100).alias("records_100_plus"),
        F.countDistinct("card_id").alias("cards"),
        F.countDistinct("merchant_id").alias("merchants"),
    )


# ---------------------------------------------------------------------------
# Declared layers
# ---------------------------------------------------------------------------
def replayed_lake(spark: SparkSession, sf_dir: str) -> "S.LakeSettings":
    """Every fixture batch ingested twice (a retry under a new request id)."""
    from ..plans.batch import ingest
    from ..session import scratch_path

    def build() -> "S.LakeSettings":
        lake = S.LakeSettings(root=scratch_path(spark, "replayed-lake"))
        raw = fixture_raw(spark, sf_dir)
        # the original batches and their retries, loaded in one pass
        copies = raw.withColumn("_copy", F.lit("")).unionByName(
            raw.withColumn("_copy", F.lit("-retry")))
        ingest(copies, lake, now=F.col("batch_now"),
               request_id=F.concat(F.lit("batch-"), F.col("batch_id").cast("string"),
                                   F.col("_copy")),
               quarantine_ts=F.col("batch_now"), run_partition=False)
        return lake

    return _once(spark, sf_dir, "replayed", build, alive=lambda lake: _exists(spark, lake.metadata))


def _silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..operators.layers import silver_dedup
    from ..operators.sinks import read_bronze
    bronze = read_bronze(spark, replayed_lake(spark, sf_dir).bronze)
    return silver_dedup(bronze.select("run_id", *S.TXN_FIELDS))


def silver_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _silver(spark, sf_dir)


def gold_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..operators.layers import gold_daily as gold
    return gold(_silver(spark, sf_dir))


def card_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..operators.layers import card_rollup as rollup
    return rollup(_silver(spark, sf_dir))


def warnings_tagged(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..operators.layers import warning_rules
    raw = fixture_raw(spark, sf_dir)
    c = route.classify(raw, now=F.col("batch_now"),
                       request_id=F.concat(F.lit("batch-"), F.col("batch_id").cast("string")),
                       rules=warning_rules())
    return c.filter(F.size("warnings") > 0).select(
        "event_id", "is_valid", F.array_join("warnings", "|").alias("_quality_warnings"))


def bronze_warnings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze rows that passed with a warning, read back from the zone."""
    from ..operators.layers import warning_rules
    from ..operators.sinks import read_bronze
    from ..plans.batch import ingest
    from ..session import scratch_path

    def build() -> "S.LakeSettings":
        lake = S.LakeSettings(root=scratch_path(spark, "warned-lake"))
        ingest(fixture_raw(spark, sf_dir), lake, now=F.col("batch_now"),
               request_id=F.concat(F.lit("batch-"), F.col("batch_id").cast("string")),
               quarantine_ts=F.col("batch_now"), run_partition=False, rules=warning_rules())
        return lake

    lake = _once(spark, sf_dir, "warned", build, alive=lambda lake: _exists(spark, lake.metadata))
    tagged = read_bronze(spark, lake.bronze).filter(F.size("_quality_warnings") > 0)
    return tagged.select("transaction_id", "run_id", F.array_join("_quality_warnings", "|").alias("warnings"))


def bronze_day_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..operators.layers import day_range
    from ..operators.sinks import read_bronze
    bronze = read_bronze(spark, fixture_lake(spark, sf_dir).bronze)
    return (day_range(bronze, "2024-01-10", "2024-01-20")
            .groupBy("year", "month", "day").agg(F.count(F.lit(1)).alias("records")))


# ---------------------------------------------------------------------------
# Dead letter (S11): a downstream load that rejects some records
# ---------------------------------------------------------------------------
POISON_PREFIX = "00"


def reject_poison_ids(batch) -> None:
    """Stand-in for a downstream load that refuses a whole batch."""
    if batch["transaction_id"].str.startswith(POISON_PREFIX).any():
        raise ValueError("downstream rejected record")


def dead_letter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Load valid transactions into a sink that rejects ids starting with
    ``00``; the rejected records end in the dead-letter table."""
    from ..operators.deadletter import process_with_bisect
    from ..session import scratch_path

    txns = fixture_transactions(spark, sf_dir).select("event_id", "transaction_id", "amount")
    dead = process_with_bisect(txns, reject_poison_ids, max_retries=1,
                               dead_letter_uri=scratch_path(spark, "dead-letter"))
    return dead.select("event_id", "transaction_id", "error_message")


# ---------------------------------------------------------------------------
# Landing zone, manifest (D5, D6) and incremental file copy
# ---------------------------------------------------------------------------
def fixture_landing(spark: SparkSession, sf_dir: str) -> tuple[str, str]:
    """Fixture records landed as text files plus the sender's manifest."""
    from ..session import scratch_path
    from ..sources import landing

    def build() -> tuple[str, str]:
        uri, manifest_uri = scratch_path(spark, "landing"), scratch_path(spark, "manifest")
        landing.land_records(fixture_raw(spark, sf_dir), uri)
        landing.build_manifest(spark, uri).write.parquet(manifest_uri)
        return uri, manifest_uri

    return _once(spark, sf_dir, "landing", build, alive=lambda found: _exists(spark, found[1]))


def landing_decode_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..sources import landing
    uri, _ = fixture_landing(spark, sf_dir)
    c = D.decode(landing.read_landing(spark, uri))
    outcome = F.when(F.col("_decode_kind") == D.KIND_OK, F.lit("ok")).otherwise(
        _reason_kind(F.col("_decode_reason")))
    return c.groupBy(outcome.alias("decode_outcome")).agg(F.count(F.lit(1)).alias("records"))


def manifest_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..sources import landing
    uri, manifest_uri = fixture_landing(spark, sf_dir)
    checked = landing.check_manifest(spark, uri, spark.read.parquet(manifest_uri))
    shard = F.regexp_extract("source_file", r"shard_id=([^/]+)", 1)
    return checked.groupBy(shard.alias("shard_id"), "status").agg(
        F.sum("expected_rows").alias("expected_rows"),
        F.sum("actual_rows").alias("actual_rows"))


def file_copy_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Copy the landed files with a file stream; compare target checksums."""
    from ..session import scratch_path
    from ..sources import landing
    from ..streaming.filecopy import start_copy

    uri, _ = fixture_landing(spark, sf_dir)
    target = scratch_path(spark, "copy-target")
    manifest_uri = scratch_path(spark, "copy-manifest")
    query = start_copy(spark, uri, target, manifest_uri,
                       checkpoint=scratch_path(spark, "copy-checkpoint"),
                       pattern="*.txt", available_now=True)
    query.awaitTermination()
    if query.exception() is not None:
        raise RuntimeError(str(query.exception()))
    copied = spark.read.parquet(manifest_uri)
    targets = landing.file_checksums(spark, target).select(
        F.col("source_file").alias("target_file"), F.col("sha256").alias("target_sha256"))
    return (copied.join(targets, F.regexp_replace("target", "^file:", "")
                        == F.regexp_replace("target_file", "^file:", ""), "left")
            .select(F.regexp_extract("source", r"(shard_id=.*)$", 1).alias("relative_path"),
                    "bytes", (F.col("sha256") == F.col("target_sha256")).alias("same_content")))


def card_sequence(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..operators.layers import card_sequence as sequence
    return sequence(_silver(spark, sf_dir).drop("copies"))

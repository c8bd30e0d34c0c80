"""Batch handler, sinks, partition paths and run metadata."""
import json
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from conftest import NOW, as_bytes, txn
from ledgerflow import schema as S
from ledgerflow.functions import formats as FM
from ledgerflow.operators import sinks
from ledgerflow.operators.metadata import MetadataTable
from ledgerflow.plans.batch import process_batch, raw_from_payloads


@pytest.mark.parametrize("moment, expected", [
    (datetime(2026, 1, 5, 23, 59, tzinfo=timezone.utc), "year=2026/month=01/day=05"),
    (datetime(2026, 12, 25, 0, 0, tzinfo=timezone.utc), "year=2026/month=12/day=25"),
])
def test_partition_path(spark, moment, expected):
    [row] = spark.range(1).select(FM.partition_path(F.lit(moment).cast("timestamp")).alias("p")).collect()
    assert row["p"] == expected
    assert not row["p"].startswith("/") and not row["p"].endswith("/")


def run(spark, root, payloads, request_id="req-1", now=NOW, **kw):
    lake = S.LakeSettings(root=root)
    raw = raw_from_payloads(spark, [as_bytes(p) for p in payloads])
    return lake, process_batch(spark, raw, request_id, lake, now=now, **kw)


def test_all_valid(spark, tmp_root):
    lake, out = run(spark, tmp_root, [txn(), txn(), txn()])
    assert (out.total, out.valid, out.quarantined, out.run_status) == (3, 3, 0, "SUCCESS")
    assert out.run_id == "2026-04-28T14:00:00+00:00___req-1"
    assert out.quarantine_s3_uri is None
    assert "year=2026/month=04/day=28" in out.bronze_s3_uri
    assert sinks.read_bronze(spark, lake.bronze).count() == 3


def test_mixed_batch(spark, tmp_root):
    lake, out = run(spark, tmp_root, [txn(), txn(), b"\xff\xfe", txn(amount=-1)])
    assert (out.total, out.valid, out.quarantined, out.run_status) == (4, 2, 2, "PARTIAL")
    q = sinks.read_quarantine(spark, lake.quarantine).collect()
    kinds = sorted(r["_raw_b64"] is not None for r in q)
    assert kinds == [False, True]
    assert out.bronze_s3_uri.rsplit("/", 1)[0] == out.quarantine_s3_uri.rsplit("/", 1)[0].replace(
        "quarantine", "bronze")


def test_all_bad_writes_no_bronze(spark, tmp_root):
    import os
    lake, out = run(spark, tmp_root, [b"x", b"[1]"])
    assert (out.valid, out.quarantined, out.bronze_s3_uri) == (0, 2, None)
    assert not os.path.exists(lake.bronze)


def test_empty_batch_is_success(spark, tmp_root):
    import os
    lake, out = run(spark, tmp_root, [])
    assert (out.total, out.valid, out.quarantined, out.run_status) == (0, 0, 0, "SUCCESS")
    assert not os.path.exists(lake.bronze) and not os.path.exists(lake.quarantine)
    [row] = MetadataTable(spark, lake.metadata).latest().collect()
    assert row["run_status"] == "SUCCESS" and row["total_records"] == 0


def test_drift_two_hours_quarantined(spark, tmp_root):
    _, out = run(spark, tmp_root, [txn(transaction_ts="2026-04-28T12:00:00Z")])
    assert out.quarantined == 1 and out.run_status == "PARTIAL"


def test_bronze_ndjson_keeps_nulls_and_canonical_values(spark, tmp_root):
    lake, _ = run(spark, tmp_root, [txn(transaction_id="{12345678-ABCD-4DEF-8ABC-1234567890AB}",
                                        transaction_ts="2026-04-28T16:00:00+02:00",
                                        amount="12.5")])
    lines = spark.read.text(lake.bronze).collect()
    assert len(lines) == 1
    line = lines[0]["value"]
    assert '"transaction_id":"12345678-abcd-4def-8abc-1234567890ab"' in line
    assert '"transaction_ts":"2026-04-28T14:00:00Z"' in line and '"amount":12.5' in line
    q_lake, _ = run(spark, tmp_root + "/q", [b"[1]"])
    [qline] = spark.read.text(q_lake.quarantine).collect()
    assert '"payload_json":null' in qline["value"]


def test_replayed_batch_replaces_its_files(spark, tmp_root):
    lake, first = run(spark, tmp_root, [txn(), txn()])
    _, again = run(spark, tmp_root, [txn(), txn()])
    assert first.run_id == again.run_id
    assert sinks.read_bronze(spark, lake.bronze).count() == 2
    assert MetadataTable(spark, lake.metadata).latest().count() == 1


def test_running_then_final_row(spark, tmp_root):
    lake, out = run(spark, tmp_root, [txn()], record_running=True)
    table = MetadataTable(spark, lake.metadata)
    assert table.versions().count() == 2
    [row] = table.get(S.PIPELINE_NAME, out.run_id).collect()
    assert row["run_status"] == "SUCCESS"


def test_metadata_queries(spark, tmp_root):
    table = MetadataTable(spark, tmp_root + "/meta")
    runs = [("2026-04-28T10:00:00+00:00___a", "SUCCESS"), ("2026-04-28T12:00:00+00:00___c", "FAILED"),
            ("2026-04-28T11:00:00+00:00___b", "FAILED"), ("2026-04-28T09:00:00+00:00___d", "PARTIAL")]
    for run_id, status in runs:
        table.save_one(pipeline_name=S.PIPELINE_NAME, run_id=run_id, run_status=status,
                       start_ts=run_id.split("___")[0], total_records=1, valid_records=1,
                       quarantine_records=0)
    [got] = table.get(S.PIPELINE_NAME, "2026-04-28T10:00:00+00:00___a").collect()
    assert got["run_status"] == "SUCCESS"
    newest = [r["run_id"] for r in table.last_n(S.PIPELINE_NAME, 2).collect()]
    assert newest == ["2026-04-28T12:00:00+00:00___c", "2026-04-28T11:00:00+00:00___b"]
    failed = [r["run_id"] for r in table.by_status("FAILED").collect()]
    assert failed == ["2026-04-28T11:00:00+00:00___b", "2026-04-28T12:00:00+00:00___c"]
    since = [r["run_id"] for r in table.by_status("FAILED", since="2026-04-28T11:30:00+00:00").collect()]
    assert since == ["2026-04-28T12:00:00+00:00___c"]
    # saving the same key again replaces it
    table.save_one(pipeline_name=S.PIPELINE_NAME, run_id="2026-04-28T11:00:00+00:00___b",
                   run_status="SUCCESS", start_ts="2026-04-28T11:00:00+00:00",
                   saved_at=datetime.now(timezone.utc) + timedelta(seconds=1))
    assert [r["run_id"] for r in table.by_status("FAILED").collect()] == [
        "2026-04-28T12:00:00+00:00___c"]


def test_landing_files_go_through_the_handler(spark, tmp_root):
    from ledgerflow.plans.batch import ingest_landing
    from ledgerflow.sources import landing
    rows = [("shard-0", bytearray(as_bytes(txn()))), ("shard-0", bytearray(b"[1]")),
            ("shard-1", bytearray(as_bytes(txn())))]
    raw = spark.createDataFrame(rows, "shard_id string, data binary")
    landing.land_records(raw, tmp_root + "/landing")
    lake = S.LakeSettings(root=tmp_root + "/lake")
    runs = ingest_landing(spark, tmp_root + "/landing", lake, now=NOW).collect()
    assert sum(r["total_records"] for r in runs) == 3
    assert sum(r["valid_records"] for r in runs) == 2
    assert all(r["run_id"].startswith("2026-04-28T14:00:00+00:00___landing-part-") for r in runs)
    assert sinks.read_bronze(spark, lake.bronze).count() == 2


def test_failure_records_failed_run_and_reraises(spark, tmp_root):
    lake = S.LakeSettings(root=tmp_root)
    import os
    os.makedirs(os.path.dirname(lake.bronze), exist_ok=True)
    with open(lake.bronze, "w") as blocker:          # a file where the zone folder should be
        blocker.write("not a folder")
    raw = raw_from_payloads(spark, [as_bytes(txn())])
    with pytest.raises(Exception):
        process_batch(spark, raw, "req-f", lake, now=NOW)
    table = MetadataTable(spark, lake.metadata)
    [row] = table.latest().collect()
    assert row["run_status"] == "FAILED" and row["error_message"]
    recent = table.recent(hours=1, now=NOW + timedelta(minutes=5)).collect()
    assert [r["run_id"] for r in recent] == [row["run_id"]]
    assert table.recent(hours=1, now=NOW + timedelta(hours=3)).count() == 0


def test_landing_keeps_records_that_hold_line_ends(spark, tmp_root):
    from ledgerflow.sources import landing

    payloads = [as_bytes(txn()), json.dumps(txn(), indent=1).encode(), b"\xff\xfe\n\x00", b"", b"a\r\nb"]
    raw = raw_from_payloads(spark, payloads).withColumn("shard_id", F.lit("shard-0"))
    landing.land_records(raw, tmp_root + "/landing")
    assert sorted(bytes(r["data"]) for r in landing.read_landing(spark, tmp_root + "/landing").collect()) == sorted(payloads)


def test_manifest_statuses(spark, tmp_root):
    from ledgerflow.sources import landing

    uri = tmp_root + "/landing"
    raw = spark.range(60).select(F.col("id").cast("string").cast("binary").alias("data"),
                                 F.concat(F.lit("shard-"), F.col("id") % 6).alias("shard_id"))
    landing.land_records(raw.coalesce(1), uri)
    shard = F.regexp_extract("source_file", r"shard_id=shard-(\d)", 1)
    manifest = landing.build_manifest(spark, uri).withColumn("s", shard).filter("s <> '1'")
    manifest = manifest.withColumns({
        "expected_rows": F.when(F.col("s") == "2", 99).otherwise(F.col("expected_rows")),
        "sha256": F.when(F.col("s") == "3", F.lit("0")).otherwise(F.col("sha256")),
        "schema_version": F.when(F.col("s") == "4", F.lit("txn-v0")).otherwise(F.col("schema_version")),
        "source_file": F.when(F.col("s") == "5", F.concat("source_file", F.lit(".gone"))).otherwise(F.col("source_file")),
    }).drop("s")
    import os
    with open(f"{uri}/shard_id=shard-0/late.ndjson", "w") as late:     # another name, not in the manifest
        late.write("YQ==\nYg==\n")
    got = sorted((r["status"], r["actual_rows"]) for r in landing.check_manifest(spark, uri, manifest).collect())
    assert got == [("CHECKSUM", 10), ("MISSING", None), ("OK", 10), ("ROW_COUNT", 10), ("SCHEMA_VERSION", 10),
                   ("UNLISTED", 2), ("UNLISTED", 10), ("UNLISTED", 10)]
    assert os.path.exists(uri)


def test_metadata_days_compaction_and_newest_runs(spark, tmp_root):
    table = MetadataTable(spark, tmp_root + "/meta")
    for day in range(1, 6):
        for hour in (1, 2):
            start = f"2026-04-0{day}T0{hour}:00:00+00:00"
            for status in ("RUNNING", "SUCCESS"):
                table.save_one(pipeline_name="p", run_id=f"{start}___r", run_status=status, start_ts=start)
    newest = [r["run_id"][:13] for r in table.last_n("p", 3).collect()]
    assert newest == ["2026-04-05T02", "2026-04-05T01", "2026-04-04T02"]
    assert table.last_n("p", 100).count() == 10 and table.last_n("other", 3).count() == 0
    assert table.versions().count() == 20
    table.compact("p", before_day="2026-04-05")
    assert table.versions().count() == 8 + 4
    assert {r["run_status"] for r in table.latest("p").collect()} == {"SUCCESS"}
    assert len(table.by_status("SUCCESS", since="2026-04-04T02:00:00+00:00").collect()) == 3
    plan = table.get("p", "2026-04-03T01:00:00+00:00___r")
    assert plan.count() == 1
    assert "start_date" in plan._jdf.queryExecution().executedPlan().toString().split("PartitionFilters:")[1].split("]")[0]


def test_failed_run_before_any_count(spark, tmp_root):
    lake = S.LakeSettings(root=tmp_root)
    broken = spark.range(3).select(F.raise_error(F.lit("source is gone")).cast("binary").alias("data"))
    with pytest.raises(Exception):
        process_batch(spark, broken, "req-9", lake, now=NOW, record_running=True)
    [row] = MetadataTable(spark, lake.metadata).latest().collect()
    assert row["run_status"] == "FAILED" and "source is gone" in row["error_message"]
    assert row["lambda_request_id"] == "req-9"
    statuses = {r["run_status"] for r in MetadataTable(spark, lake.metadata).versions().collect()}
    assert statuses == {"RUNNING", "FAILED"}


def test_bulk_load_writes_a_day_together(spark, tmp_root):
    """Files of a bulk load grow with days, not with days times tasks."""
    import glob

    from ledgerflow.plans.batch import ingest
    days, per_day = 12, 40
    rows = [(NOW + timedelta(days=i % days), bytearray(as_bytes(txn() if i % 2 else b"no json")))
            for i in range(days * per_day)]
    raw = spark.createDataFrame(rows, "t timestamp, data binary").repartition(8)
    lake = S.LakeSettings(root=tmp_root)
    ingest(raw, lake, now=F.col("t"), request_id=F.date_format("t", "dd"), run_partition=False)
    for zone in (lake.bronze, lake.quarantine):
        files = glob.glob(f"{zone}/*/*/*/*.json")
        assert len(files) == len({f.rsplit("/", 1)[0] for f in files}) <= days
    saved = glob.glob(f"{lake.metadata}/*/*/*.parquet")
    assert len(saved) == days

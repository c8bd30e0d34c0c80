"""Shard log reads, audit, streaming ingest with restart."""
from datetime import datetime, timedelta, timezone

from conftest import as_bytes, txn
from ledgerflow import schema as S
from ledgerflow.operators import sinks
from ledgerflow.operators.metadata import MetadataTable
from ledgerflow.sources import shard_log
from ledgerflow.streaming import ingest as SI

T0 = datetime(2026, 4, 28, 14, 0, tzinfo=timezone.utc)


def land_fixture(spark, uri, n=20, shards=3, start=T0):
    rows = []
    for i in range(n):
        rows.append((f"shard-{i % shards}", i, start + timedelta(seconds=i), "k",
                     bytearray(as_bytes(txn(transaction_ts=(start + timedelta(seconds=i)).isoformat())))))
    df = spark.createDataFrame(rows, "shard_id string, sequence_number long, arrival_ts timestamp, "
                                     "partition_key string, data binary")
    shard_log.land(df, uri)


def test_shards_drain_limit_resume(spark, tmp_root):
    uri = tmp_root + "/log"
    land_fixture(spark, uri)
    log = shard_log.read(spark, uri)
    assert sorted(r[0] for r in shard_log.shard_ids(log).collect()) == ["shard-0", "shard-1", "shard-2"]
    assert shard_log.drain(log).count() == 20
    assert shard_log.drain(log, "shard-1").count() == 7
    limited = shard_log.drain(log, limit=3).groupBy("shard_id").count().collect()
    assert all(r["count"] == 3 for r in limited)
    pos = {"shard-0": 9, "shard-1": 10}
    rest = shard_log.drain(log, after=pos)
    assert rest.count() == 3 + 3 + 6
    pos_df = shard_log.positions(shard_log.drain(log, limit=3))
    assert shard_log.drain(log, after=pos_df).count() == 11
    late = shard_log.drain(log, iterator_type=shard_log.LATEST, started_at=T0 + timedelta(seconds=15))
    assert late.count() == 5
    audit = {r["shard_id"]: r["records"] for r in shard_log.audit(log).collect()}
    assert audit == {"shard-0": 7, "shard-1": 7, "shard-2": 6, None: 20}


def test_stream_ingest_restart_reads_nothing_new(spark, tmp_root):
    uri = tmp_root + "/log"
    now = datetime.now(timezone.utc).replace(microsecond=0)
    land_fixture(spark, uri, n=12, start=now)
    lake = S.LakeSettings(root=tmp_root + "/lake")
    q = SI.start_ingest(spark, uri, lake, reader_name="r1", available_now=True,
                        max_files_per_trigger=2)
    q.awaitTermination()
    assert q.exception() is None
    assert sinks.read_bronze(spark, lake.bronze).count() == 12
    runs = MetadataTable(spark, lake.metadata).latest().collect()
    assert sum(r["total_records"] for r in runs) == 12 and len(runs) >= 2
    q2 = SI.start_ingest(spark, uri, lake, reader_name="r1", available_now=True)
    q2.awaitTermination()
    assert sinks.read_bronze(spark, lake.bronze).count() == 12
    # an independent reader with its own checkpoint sees everything again
    other = S.LakeSettings(root=tmp_root + "/lake2")
    q3 = SI.start_ingest(spark, uri, other, reader_name="r2", available_now=True)
    q3.awaitTermination()
    assert sinks.read_bronze(spark, other.bronze).count() == 12


def test_unreadable_file_leaves_a_failed_run(spark, tmp_root):
    """An error of the source itself, before any count, ends in FAILED under the batch's run id."""
    import os

    import pytest
    from pyspark.errors import StreamingQueryException

    uri = tmp_root + "/log"
    land_fixture(spark, uri, n=6, start=datetime.now(timezone.utc).replace(microsecond=0))
    with open(f"{uri}/shard_id=shard-0/broken.parquet", "wb") as out:
        out.write(b"not a parquet file")
    lake = S.LakeSettings(root=tmp_root + "/lake")
    for _ in range(2):                               # the replay fails under the same run id
        with pytest.raises(StreamingQueryException):
            SI.start_ingest(spark, uri, lake, reader_name="r", available_now=True).awaitTermination()
    table = MetadataTable(spark, lake.metadata)
    [run] = table.latest().collect()
    assert run["run_status"] == S.STATUS_FAILED and run["error_message"] and run["total_records"] is None
    assert run["run_id"] == f"{run['start_ts']}___r-0"
    assert [r["run_status"] for r in table.versions().orderBy("saved_at").collect()] == [
        S.STATUS_RUNNING, S.STATUS_FAILED] * 2
    assert not os.path.exists(lake.bronze)


def test_stream_latest_skips_old_records(spark, tmp_root):
    uri = tmp_root + "/log"
    land_fixture(spark, uri, n=6, start=T0)
    lake = S.LakeSettings(root=tmp_root + "/lake")
    q = SI.start_ingest(spark, uri, lake, reader_name="tail", available_now=True,
                        iterator_type=shard_log.LATEST)
    q.awaitTermination()
    import os
    assert not os.path.exists(lake.bronze)


def test_silver_stream_drops_copies(spark, tmp_root):
    from ledgerflow.plans.batch import process_batch, raw_from_payloads
    from ledgerflow.streaming.silver import start_silver
    lake = S.LakeSettings(root=tmp_root + "/lake")
    now = datetime.now(timezone.utc).replace(microsecond=0)
    payloads = [as_bytes(txn(transaction_ts=now.isoformat())) for _ in range(3)]
    # the same three records arrive twice (a retried batch under a new request id)
    for request in ("r1", "r1-retry"):
        process_batch(spark, raw_from_payloads(spark, payloads), request, lake, now=now)
    assert sinks.read_bronze(spark, lake.bronze).count() == 6
    q = start_silver(spark, lake, available_now=True)
    q.awaitTermination()
    assert q.exception() is None
    silver = spark.read.parquet(lake.silver)
    assert silver.count() == 3
    assert dict(silver.dtypes)["amount"] == "decimal(18,2)"


def test_bronze_to_silver_parquet(spark, tmp_root):
    from ledgerflow.plans.batch import process_batch, raw_from_payloads
    lake = S.LakeSettings(root=tmp_root + "/lake")
    process_batch(spark, raw_from_payloads(spark, [as_bytes(txn(transaction_ts=T0.isoformat()))]),
                  "r", lake, now=T0)
    for _ in range(2):                               # a rerun replaces its days
        sinks.bronze_to_silver_parquet(spark, lake.bronze, lake.silver)
    [row] = spark.read.parquet(lake.silver).collect()
    assert row["transaction_ts"] == T0.replace(tzinfo=None) or row["transaction_ts"].year == 2026
    assert (row["year"], row["month"], row["day"]) == ("2026", "04", "28")


def test_land_gathers_a_shard(spark, tmp_root):
    """Files grow with shards and data, not with shards times tasks."""
    import glob

    rows = [(f"shard-{i % 3}", i, T0 + timedelta(seconds=i), "k", bytearray(b"r")) for i in range(240)]
    df = spark.createDataFrame(rows, "shard_id string, sequence_number long, arrival_ts timestamp, "
                                     "partition_key string, data binary").repartition(8)
    shard_log.land(df, tmp_root + "/log", records_per_file=50)
    files = glob.glob(tmp_root + "/log/*/*.parquet")
    assert len(files) == 6                           # 80 records of a shard: 50 and 30
    assert max(spark.read.parquet(f).count() for f in files) == 50
    assert shard_log.read(spark, tmp_root + "/log").count() == 240


def test_micro_batches_read_a_bounded_number_of_files(spark, tmp_root, monkeypatch):
    from ledgerflow.plans import queries as Q
    from ledgerflow.streaming import batches as B

    asked = {}
    drain = B.drain_batches

    def drain_batches(*args, **options):
        asked.update(options)
        drain(*args, **options)

    land_fixture(spark, tmp_root + "/log", n=36)
    monkeypatch.setattr(Q, "fixture_log", lambda spark, sf_dir: tmp_root + "/log")
    monkeypatch.setattr(Q, "MICRO_BATCH_FILES", 1, raising=False)
    monkeypatch.setattr(B, "drain_batches", drain_batches)
    assert sum(r["records"] for r in Q.micro_batches(spark, "").collect()) == 36
    assert asked["max_files_per_trigger"] == 1

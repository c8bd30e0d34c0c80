"""Batches by size or age: numbering, the timer, a restart, a hot shard in slices."""
import time
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from ledgerflow.sources import shard_log
from ledgerflow.streaming import batches as B

T0 = datetime(2026, 4, 28, 14, 0, tzinfo=timezone.utc)
LONG = 3600


def land(spark, uri, first, n, shard="shard-0"):
    rows = [(shard, i, T0 + timedelta(seconds=i), f"card-{i % 7}", bytearray(b"r%d" % i))
            for i in range(first, first + n)]
    shard_log.land(spark.createDataFrame(rows, "shard_id string, sequence_number long, arrival_ts timestamp, "
                                               "partition_key string, data binary").coalesce(1), uri)


def sizes(df):
    rows = df.groupBy("shard_id", "slice", "batch_number").count().collect()
    return {(r["shard_id"], r["slice"], r["batch_number"]): r["count"] for r in rows}


def test_size_closes_batches_and_a_restart_goes_on_with_the_open_one(spark, tmp_root):
    log, target, checkpoint = (f"{tmp_root}/{name}" for name in ("log", "out", "ckpt"))
    store = spark.conf.get(B.STATE_STORE)
    land(spark, log, 0, 25)
    land(spark, log, 100, 3, shard="shard-1")
    B.drain_batches(spark, log, target, checkpoint, max_records=10, max_age_seconds=LONG)
    assert spark.conf.get(B.STATE_STORE) == store
    assert sizes(B.closed_batches(spark, target)) == {("shard-0", 0, 0): 10, ("shard-0", 0, 1): 10}
    assert sizes(B.open_batches(spark, checkpoint)) == {("shard-0", 0, 2): 5, ("shard-1", 0, 0): 3}

    land(spark, log, 25, 7)                                # 5 + 7: closes batch 2, leaves 2 open
    B.drain_batches(spark, log, target, checkpoint, max_records=10, max_age_seconds=LONG)
    closed = B.closed_batches(spark, target)
    assert sizes(closed) == {("shard-0", 0, n): 10 for n in range(3)}
    assert sizes(B.open_batches(spark, checkpoint)) == {("shard-0", 0, 3): 2, ("shard-1", 0, 0): 3}
    everything = closed.unionByName(B.open_batches(spark, checkpoint)).collect()
    assert sorted(r["sequence_number"] for r in everything) == list(range(32)) + [100, 101, 102]
    assert all(bytes(r["data"]) == b"r%d" % r["sequence_number"] for r in everything)
    assert {r["closed_by"] for r in closed.select("closed_by").collect()} == {B.CLOSED_BY_SIZE}


def test_age_closes_a_batch_that_does_not_fill(spark, tmp_root):
    log, target, checkpoint = (f"{tmp_root}/{name}" for name in ("log", "out", "ckpt"))
    land(spark, log, 0, 12)
    query = B.start_batches(spark, log, target, checkpoint, max_records=10, max_age_seconds=1,
                            processing_time="200 milliseconds")
    try:
        end = time.time() + 60
        found = {}
        while time.time() < end and len(found) < 2:
            time.sleep(1)
            assert query.exception() is None
            if query.lastProgress is not None:
                found = sizes(B.closed_batches(spark, target))
    finally:
        query.stop()
    assert found == {("shard-0", 0, 0): 10, ("shard-0", 0, 1): 2}
    closed = B.closed_batches(spark, target).select("batch_number", "closed_by").distinct().collect()
    assert {tuple(r) for r in closed} == {(0, B.CLOSED_BY_SIZE), (1, B.CLOSED_BY_AGE)}
    # numbering goes on after a batch closed by age
    land(spark, log, 12, 4)
    B.drain_batches(spark, log, target, checkpoint, max_records=10, max_age_seconds=LONG)
    assert sizes(B.open_batches(spark, checkpoint)) == {("shard-0", 0, 2): 4}


def test_slices_keep_a_card_together(spark, tmp_root):
    log, target, checkpoint = (f"{tmp_root}/{name}" for name in ("log", "out", "ckpt"))
    land(spark, log, 0, 60)
    B.drain_batches(spark, log, target, checkpoint, max_records=5, max_age_seconds=LONG,
                    slice_by=F.pmod(F.xxhash64("partition_key"), F.lit(4)))
    rows = B.closed_batches(spark, target).unionByName(B.open_batches(spark, checkpoint))
    assert rows.count() == 60 and rows.select("slice").distinct().count() > 1
    assert rows.groupBy("partition_key").agg(F.countDistinct("slice").alias("n")).filter("n > 1").isEmpty()


def test_bounds_are_checked(spark, tmp_root):
    records = spark.readStream.schema(shard_log.LOG_SCHEMA).parquet(tmp_root)
    with pytest.raises(ValueError):
        B.batches(records, max_records=0)
    with pytest.raises(ValueError):
        B.batches(records, max_age_seconds=0)

"""Skew-safe per-card sequence against a plain computation."""
from datetime import datetime, timedelta, timezone

from pyspark.sql import functions as F

from ledgerflow.operators.layers import card_sequence


def test_hot_card_spans_tasks(spark):
    base = datetime(2026, 4, 28, tzinfo=timezone.utc)
    rows = []
    for i in range(3000):                       # one card holds most of the rows
        rows.append(("hot", f"h{i:05d}", base + timedelta(seconds=7 * i), 1.25))
    for c in range(20):
        for i in range(10):
            rows.append((f"c{c:02d}", f"c{c:02d}-{i}", base + timedelta(seconds=60 * i), 2.0))
    df = spark.createDataFrame(
        [(card, tid, (ts.isoformat().replace("+00:00", "Z")), amt) for card, tid, ts, amt in rows],
        "card_id string, transaction_id string, transaction_ts string, amount double")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        out = card_sequence(df.repartition(8))
        tasks_of_hot = (df.repartition(8).orderBy("card_id", "transaction_ts", "transaction_id")
                        .filter(F.col("card_id") == "hot")
                        .select(F.spark_partition_id().alias("p")).distinct().count())
        got = {r["transaction_id"]: r for r in out.collect()}
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert tasks_of_hot > 1                     # the hot card is spread over tasks
    assert len(got) == len(rows)
    last = got["h02999"]
    assert last["seq_no"] == 3000 and last["gap_us"] == 7_000_000
    assert float(last["running_amount"]) == 3000 * 1.25
    first = got["h00000"]
    assert first["seq_no"] == 1 and first["prev_ts"] is None
    assert got["c05-9"]["seq_no"] == 10 and float(got["c05-9"]["running_amount"]) == 20.0
    seq = sorted(r["seq_no"] for r in got.values() if r["card_id"] == "hot")
    assert seq == list(range(1, 3001))


def test_records_are_cut_into_tasks_by_rows(spark):
    """A record costs far more than its bytes: no task may hold a share that grows with the table."""
    from ledgerflow.sources.fixture import raw_records

    events = spark.range(2000).selectExpr("id AS event_id", "id % 7 AS user_id", "CAST(id AS DOUBLE) AS value",
                                          "timestamp_seconds(1700000000 + id) AS ts")
    raw = raw_records(events, rows_per_task=100)
    per_task = raw.groupBy(F.spark_partition_id().alias("p")).count().collect()
    assert raw.rdd.getNumPartitions() == 20 and sum(r["count"] for r in per_task) == 2000
    assert raw_records(events).rdd.getNumPartitions() == 1
    assert raw.groupBy("batch_id").agg(F.countDistinct("batch_now").alias("n")).filter("n > 1").isEmpty()

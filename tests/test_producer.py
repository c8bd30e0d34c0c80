"""Producer: serialisation, key routing, batches of 500, outcomes, preview."""
import json

from pyspark.sql import functions as F

from ledgerflow.operators import producer as P


def txns(spark, n):
    return spark.range(n).select(
        F.col("id").alias("seq"),
        F.format_string("00000000-0000-4000-8000-%012d", "id").alias("transaction_id"),
        F.lpad((F.col("id") % 13).cast("string"), 16, "4").alias("card_id"),
        F.lit("MERCH-ABCDEF12").alias("merchant_id"),
        (F.col("id") + F.lit(0.5)).alias("amount"),
        F.lit("USD").alias("currency"),
        F.lit("2026-04-28T14:00:00Z").alias("transaction_ts"),
        F.lit("5411").alias("mcc_code"), F.lit("APPROVED").alias("auth_status"),
        F.lit("POS").alias("channel"))


def test_record_shape(spark):
    [row] = P.to_stream_records(txns(spark, 1)).collect()
    body = json.loads(bytes(row["data"]))
    assert list(body) == ["transaction_id", "card_id", "merchant_id", "amount", "currency",
                          "transaction_ts", "mcc_code", "auth_status", "channel"]
    assert row["partition_key"] == row["card_id"]


def test_batches_of_500(spark):
    recs = P.to_stream_records(txns(spark, 1234)).repartition(7)
    sizes = P.batch_sizes(P.number_batches(recs, ["seq"])).orderBy("batch_no").collect()
    assert [r["records"] for r in sizes] == [500, 500, 234]


def test_send_once_in_order_with_failures(spark, tmp_root):
    import glob
    import uuid

    log = tmp_root + "/calls"

    def put(batch):
        import os
        os.makedirs(log, exist_ok=True)
        with open(f"{log}/{uuid.uuid4().hex}", "w") as out:
            out.write(str(len(batch)))
        return [("InternalFailure", "boom") if i == 1 else None for i in range(len(batch))]

    recs = P.to_stream_records(txns(spark, 1200)).repartition(5)
    outcomes = P.send_records(recs, put, ["seq"], tmp_root + "/outcomes")
    calls = [int(open(f).read()) for f in glob.glob(log + "/*")]
    assert sum(calls) == 1200 and max(calls) <= 500
    [res] = P.send_result(outcomes).collect()
    failed = P.failed_entries(outcomes).collect()
    assert (res["total"], res["failed_count"]) == (1200, len(failed)) == (1200, len(calls))
    assert res["success_count"] == 1200 - len(calls)
    assert failed[0]["ErrorCode"] == "InternalFailure" and json.loads(failed[0]["record"])["currency"] == "USD"
    assert len(glob.glob(log + "/*")) == len(calls)            # reading results sends nothing
    [order] = P.sent_out_of_order(outcomes, ["seq"]).collect()
    assert (order["total"], order["out_of_order"]) == (1200, 0)


def test_hot_card_goes_out_in_order_over_tasks(spark, tmp_root):
    """A card with a third of the rows spans parts; its calls never overlap or step back."""
    import glob
    import uuid

    log = tmp_root + "/calls"

    def put(batch):
        import os
        import time
        os.makedirs(log, exist_ok=True)
        start = time.time_ns()
        time.sleep(0.01)
        by_card = {}
        for key, data in zip(batch["partition_key"], batch["data"]):
            by_card.setdefault(key, []).append(json.loads(bytes(data))["amount"])
        with open(f"{log}/{uuid.uuid4().hex}", "w") as out:
            json.dump([start, time.time_ns(), by_card], out)
        return [None] * len(batch)

    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        hot = txns(spark, 3000).withColumn("card_id", F.when(F.col("seq") % 3 == 0, F.lit("4" * 16))
                                           .otherwise(F.col("card_id")))
        outcomes = P.send_records(P.to_stream_records(hot).repartition(5), put, ["seq"],
                                  tmp_root + "/outcomes", batch_size=50)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    [order] = P.sent_out_of_order(outcomes, ["seq"]).collect()
    assert (order["total"], order["out_of_order"]) == (3000, 0)
    assert outcomes.agg(F.max("wave")).first()[0] >= 1 and outcomes.select("record").distinct().count() == 3000
    calls = sorted(json.load(open(f)) for f in glob.glob(log + "/*"))
    for card in {card for call in calls for card in call[2]}:
        mine = [(start, end, call[card]) for start, end, call in calls if card in call]
        sent = [amount for _, _, amounts in mine for amount in amounts]
        assert sent == sorted(sent)                             # the amount grows with the number
        assert all(a[1] <= b[0] for a, b in zip(mine, mine[1:]))


def test_broken_orders_are_seen(spark):
    def late(rows):
        sent = spark.createDataFrame(rows, "partition_key string, wave int, task int, batch_no long, "
                                           "position int, seq long")
        [found] = P.sent_out_of_order(sent, ["seq"]).collect()
        return found["total"], found["out_of_order"]

    assert late([("a", 0, 0, 0, 0, 1), ("a", 0, 0, 0, 1, 2), ("a", 1, 0, 0, 0, 3), ("b", 0, 1, 0, 0, 9)]) == (4, 0)
    # stepped back within a task, not next to the later record
    assert late([("a", 0, 0, 0, 0, 5), ("b", 0, 0, 0, 1, 1), ("a", 0, 0, 1, 0, 4)]) == (3, 1)
    # two tasks at the same time
    assert late([("a", 0, 0, 0, 0, 1), ("a", 0, 1, 0, 0, 2), ("a", 0, 1, 0, 1, 3)]) == (3, 2)
    # a later wave with earlier records
    assert late([("a", 0, 0, 0, 0, 5), ("a", 1, 0, 0, 0, 4)]) == (2, 1)
    assert late([]) == (0, 0)


def test_null_key_over_parts(spark, tmp_root):
    recs = P.to_stream_records(txns(spark, 300)).withColumn(
        "partition_key", F.when(F.col("seq") % 2 == 0, F.col("partition_key")))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        outcomes = P.send_records(recs, lambda b: [None] * len(b), ["seq"], tmp_root + "/outcomes", batch_size=20)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    [order] = P.sent_out_of_order(outcomes, ["seq"]).collect()
    assert (order["total"], order["out_of_order"]) == (300, 0)


def test_empty_send(spark, tmp_root):
    recs = P.to_stream_records(txns(spark, 0))
    outcomes = P.send_records(recs, lambda b: [None] * len(b), ["seq"], tmp_root + "/outcomes")
    [res] = P.send_result(outcomes).collect()
    assert (res["total"], res["success_count"], res["failed_count"]) == (0, 0, 0)


def test_routing_same_card_same_shard(spark):
    routed = P.route_by_key(P.to_stream_records(txns(spark, 200)), 4)
    per_card = routed.groupBy("card_id").agg(F.countDistinct("shard_id").alias("n")).collect()
    assert all(r["n"] == 1 for r in per_card)


def test_preview_line(spark):
    [row] = P.preview(txns(spark, 1), ["seq"]).collect()
    assert row["line"] == ("[0001] 00000000-0000-4000-8000-000000000000 $     0.50 USD "
                           "APPROVED  POS        card=44444444… mcc=5411")


def test_send_makes_each_record_once(spark, tmp_root):
    """The sample of the range partitioning does not make the records again."""
    made = spark.sparkContext.accumulator(0)

    @F.udf("binary")
    def counted(data):
        made.add(1)
        return data

    recs = P.to_stream_records(txns(spark, 300)).repartition(5).withColumn("data", counted.asNondeterministic()("data"))
    outcomes = P.send_records(recs, lambda batch: [None] * len(batch), ["seq"], tmp_root + "/outcomes")
    assert outcomes.count() == 300 and made.value == 300

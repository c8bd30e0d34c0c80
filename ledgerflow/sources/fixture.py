"""Raw stream records derived from the ``events`` table.

Every 100 events form one micro-batch; the batch clock is the latest
event time of the batch, cut to whole seconds.  Fault injection is a
pure function of ``event_id`` (see FIXTURES.md section 3), so the same
records come out of any engine.

Scale: the batch clock is a window max over ``batch_id``.  A batch holds
at most ``batch_size`` rows by construction, so the window partitions
are bounded and cannot be skewed; the rest is a narrow projection.  What
follows (decoding, validation) costs far more than the bytes shuffled
here, so the tasks are cut by rows (``rows_per_task``), not by bytes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BATCH_SIZE = 100
ROWS_PER_TASK = 100_000
MIN_ROWS_PER_TASK = 10_000      # small tables: as many tasks as cores, but none smaller


def _when_mod(k: Column, m: int) -> Column:
    return (k % m) == 0


def _hex_uuid(h: Column) -> Column:
    return F.concat(F.substring(h, 1, 8), F.lit("-"), F.substring(h, 9, 4), F.lit("-"),
                    F.substring(h, 13, 4), F.lit("-"), F.substring(h, 17, 4), F.lit("-"),
                    F.substring(h, 21, 12))


def _tasks(events: DataFrame, rows_per_task: int) -> int:
    rows = events.count()                   # from the file footers
    cores = events.sparkSession.sparkContext.defaultParallelism
    return max(-(-rows // rows_per_task), min(cores, -(-rows // MIN_ROWS_PER_TASK)), 1)


def raw_records(events: DataFrame, batch_size: int = BATCH_SIZE,
                rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """``event_id, batch_id, batch_now, shard_id, data`` from ``events``."""
    event_id = F.col("event_id")
    b = events.select(
        "event_id", "user_id", "value",
        F.col("ts").cast("timestamp").alias("ts"),
        F.floor(event_id / batch_size).cast("long").alias("batch_id"),
    ).repartition(_tasks(events, rows_per_task), "batch_id")
    batch_id = F.col("batch_id")
    k = (F.when(batch_id % 4 == 0, F.lit(1).cast("long"))
         .when(batch_id % 10 == 3, F.lit(31).cast("long"))
         .otherwise(event_id))
    per_batch = Window.partitionBy("batch_id")
    t = b.select(
        "event_id", "batch_id", "user_id", "value",
        k.alias("k"),
        F.date_trunc("second", F.max("ts").over(per_batch)).alias("batch_now"),
    )
    k = F.col("k")
    h = F.md5(F.concat(F.lit("txn-"), event_id.cast("string")))
    card_id = F.lpad(F.col("user_id").cast("string"), 16, "0")
    merchant_id = F.concat(
        F.lit("MERCH-"),
        # hex digits only: ``upper`` maps every text by Unicode rules, at many times the cost
        F.translate(F.substring(F.md5(F.concat(F.lit("m-"), (event_id % 200).cast("string"))), 1, 8),
                    "abcdef", "ABCDEF"))
    value = F.col("value")
    amount = (F.when(_when_mod(k, 17), value + 50000)
              .when(_when_mod(k, 19), -value).otherwise(value))
    currency = (F.when(_when_mod(k, 23), F.lit("ZZZ"))
                .when(event_id % 10 < 7, F.lit("USD"))
                .when(event_id % 10 == 7, F.lit("EUR")).otherwise(F.lit("JPY")))
    shifted = F.timestamp_micros(
        F.unix_micros(F.col("batch_now")) - ((k * 37) % 4000) * F.lit(1_000_000))
    ts_text = F.date_format(shifted, "yyyy-MM-dd'T'HH:mm:ss")
    mcc = F.when(_when_mod(k, 43), F.lit("123")).otherwise(F.lit("5411"))

    obj = F.concat(
        F.lit('{"transaction_id":"'), _hex_uuid(h), F.lit('"'),
        F.when(_when_mod(k, 29), F.lit("")).otherwise(
            F.concat(F.lit(',"card_id":"'), card_id, F.lit('"'))),
        F.lit(',"merchant_id":'),
        F.when(_when_mod(k, 53), F.lit("null")).otherwise(
            F.concat(F.lit('"'), merchant_id, F.lit('"'))),
        F.lit(',"amount":'),
        F.when(_when_mod(k, 59), F.lit('"12.5"')).otherwise(amount.cast("string")),
        F.lit(',"currency":"'), currency,
        F.lit('","transaction_ts":"'), ts_text,
        F.when(_when_mod(k, 47), F.lit("")).otherwise(F.lit("Z")),
        F.lit('","mcc_code":"'), mcc,
        F.lit('","auth_status":"APPROVED","channel":"POS"'),
        F.when(_when_mod(k, 71), F.lit(',"note":"extra"')).otherwise(F.lit("")),
        F.lit("}"),
        F.when(_when_mod(k, 61), F.lit(" x")).otherwise(F.lit("")),
    )
    payload_text = (F.when(_when_mod(k, 31), F.lit("this is not json"))
                    .when(_when_mod(k, 37), F.lit("[1, 2]"))
                    .otherwise(obj))
    data = F.when(_when_mod(k, 41), F.unhex(F.lit("FFFEFF"))).otherwise(
        payload_text.cast("binary"))
    return t.select(
        "event_id", "batch_id", "batch_now",
        F.concat(F.lit("shard-"), (event_id % 4).cast("string")).alias("shard_id"),
        data.alias("data"),
    )

"""Downstream layers named by the surveyed design.

The survey gives these only a sentence each; the choices here are ours:

* Silver (D1): Bronze deduplicated on ``transaction_id``, keeping the
  version from the earliest run (retries repeat records); copies within
  that run are told apart by their other values, smallest first.  A
  sort-based aggregate with a partial step per task, so one id repeated
  millions of times still ships one row per task.  For a stream,
  ``dedup_stream`` keeps the first copy within a watermark.
* Gold (D3): daily totals by currency, channel and status.  An amount is
  money here: it is rounded half up to cents, DECIMAL(18,2), once, and the
  rounded amounts are summed without further error.  Bronze and the
  deduplicated rows keep the amount as it came.
* Card rollup (D4): per-card totals and time span, with a partial step too.
* Warnings (D7): a registry where freshness is a WARNING lets the record
  through with ``_quality_warnings``.
* Pruned reads (D10): day filters on the text partition columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import schema as S
from ..functions import formats as FM
from ..functions import rules as R
from ..session import stage

MONEY = "decimal(18,2)"
MONEY_TOTAL = "decimal(38,2)"


def silver_dedup(bronze: DataFrame, key: str = "transaction_id",
                 order: str = "run_id") -> DataFrame:
    """One row per ``key``: the copy with the smallest ``order`` value, then
    the smallest other values, so the choice never depends on row order."""
    others = [order, *[c for c in bronze.columns if c not in (key, order)]]
    kept = bronze.groupBy(key).agg(
        F.min(F.struct(*others)).alias("_row"),
        F.count(F.lit(1)).alias("copies"),
    )
    return kept.select(key, *[F.col("_row")[c].alias(c) for c in bronze.columns if c != key], "copies")


def dedup_stream(bronze_stream: DataFrame, event_time: str = "event_ts",
                 delay: str = "1 hour", key: str = "transaction_id") -> DataFrame:
    """Streaming dedup: first copy of ``key`` within the watermark delay."""
    return bronze_stream.withWatermark(event_time, delay).dropDuplicatesWithinWatermark([key])


def typed_silver(silver: DataFrame) -> DataFrame:
    """Silver with the event time as TIMESTAMP and the amount as money."""
    return silver.select(
        *[c for c in silver.columns if c not in ("transaction_ts", "amount")],
        F.to_timestamp("transaction_ts").alias("transaction_ts"),
        F.col("amount").cast(MONEY).alias("amount"),
    )


def gold_daily(silver: DataFrame) -> DataFrame:
    """Daily totals per currency, channel and status (by event date)."""
    typed = typed_silver(silver)
    return typed.groupBy(
        F.date_format("transaction_ts", "yyyy-MM-dd").alias("event_date"),
        "currency", "channel", "auth_status",
    ).agg(
        F.count(F.lit(1)).alias("transactions"),
        F.sum("amount").cast(MONEY_TOTAL).alias("total_amount"),
        F.min("amount").alias("min_amount"),
        F.max("amount").alias("max_amount"),
    )


def card_rollup(silver: DataFrame) -> DataFrame:
    """Per-card activity: count, total, first and last event, merchants."""
    typed = typed_silver(silver)
    return typed.groupBy("card_id").agg(
        F.count(F.lit(1)).alias("transactions"),
        F.sum("amount").cast(MONEY_TOTAL).alias("total_amount"),
        FM.iso_z(F.min("transaction_ts")).alias("first_ts"),
        FM.iso_z(F.max("transaction_ts")).alias("last_ts"),
        F.countDistinct("merchant_id").alias("merchants"),
    )


def warning_rules() -> list[R.Rule]:
    """Registry with the freshness rule as a WARNING."""
    return R.with_severity(R.default_rules(), "TXN_002", S.SEVERITY_WARNING)


def day_range(zone: DataFrame, first_day: str, last_day: str) -> DataFrame:
    """Rows whose day partition lies in ``[first_day, last_day]`` (yyyy-MM-dd).

    The filter is on the partition columns: Spark lists the folders, drops
    those outside the range and reads the rest.
    """
    day = F.concat_ws("-", "year", "month", "day")
    return zone.filter((day >= first_day) & (day <= last_day))


def card_sequence(silver: DataFrame, card: str = "card_id",
                  tiebreak: str = "transaction_id") -> DataFrame:
    """Per-card ordered view (D4): sequence number, previous event time,
    gap and running amount of every transaction of a card.

    ``Window.partitionBy(card)`` would put a card holding a third of all
    rows into one task.  Instead the rows are range-sorted on (card, time)
    -- a hot card is spread over many tasks -- and the window runs per
    (task, card), a group no larger than one task's share.  What a card
    carries in from earlier tasks (count, amount, last time) comes from a
    summary with one row per (task, card); its window per card is bounded
    by the number of tasks.
    """
    typed = stage(typed_silver(silver).select(card, tiebreak, "transaction_ts", "amount"), "sequence-input")
    ordered = stage(typed.orderBy(card, "transaction_ts", tiebreak).select(
        "*", F.spark_partition_id().alias("_task")), "sequence-sorted")

    local_w = Window.partitionBy("_task", card).orderBy("transaction_ts", tiebreak)
    local = ordered.select(
        "*",
        F.row_number().over(local_w).alias("_n_local"),
        F.lag("transaction_ts").over(local_w).alias("_prev_local"),
        F.sum("amount").over(local_w.rowsBetween(Window.unboundedPreceding, 0))
        .alias("_sum_local"),
    )
    summary = ordered.groupBy("_task", card).agg(
        F.count(F.lit(1)).alias("_n"), F.sum("amount").alias("_sum"),
        F.max("transaction_ts").alias("_last"))
    before = Window.partitionBy(card).orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    carry = summary.select(
        "_task", card,
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_carry_n"),
        F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_carry_sum"),
        F.max("_last").over(before).alias("_carry_last"),
    )
    joined = local.join(carry, ["_task", card])
    prev = F.coalesce(F.col("_prev_local"), F.col("_carry_last"))
    return joined.select(
        card, tiebreak,
        FM.iso_z(F.col("transaction_ts")).alias("transaction_ts"),
        (F.col("_carry_n") + F.col("_n_local")).cast("long").alias("seq_no"),
        FM.iso_z(prev).alias("prev_ts"),
        (F.unix_micros("transaction_ts") - F.unix_micros(prev)).alias("gap_us"),
        (F.col("_carry_sum") + F.col("_sum_local")).cast(MONEY_TOTAL).alias("running_amount"),
    )

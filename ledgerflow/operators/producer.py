"""Producer side (S6-S10, S14): serialise, route by key, send in batches.

* ``to_stream_records`` (S6): compact JSON bytes of the nine fields plus
  the card id as partition key.
* ``route_by_key`` (S7): shard id from a hash of the key; every record of
  a card goes to the same shard, ordered by time within each task.
* ``send_records`` (S8-S10): records are range-partitioned on (key, order)
  and each task hands its records, in that order, in batches of at most
  500 to an injected ``put_batch`` function.  The outcomes are written once
  to a table and read from there, so totals and failures come from one
  send.  Nothing is retried (as in the surveyed producer).  Delivery is at
  least once: a task that Spark runs again sends its records again.  A
  card's records go out in order: a card with more records than a part
  takes is cut by time, and its pieces go out in waves, one after the
  other; all other records go out in the first wave.
* ``sent_out_of_order``: records that broke the order of their card, over
  all tasks and waves of a send.
* ``send_result`` (S9): totals and failed entries from the outcome rows.
* ``preview`` (S14): numbered one-line rendering of each record.

``put_batch(batch: pandas.DataFrame) -> list[tuple[str, str] | None]``
receives ``data`` (bytes) and ``partition_key`` and returns, per record
and in order, ``None`` on success or ``(error_code, error_message)``.
"""

from __future__ import annotations

from typing import Callable, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schema as S
from ..functions import formats as FM
from ..functions.indexing import with_dense_index
from ..session import discard, stage

OUTCOME_COLUMNS = (
    "wave int, task int,batch_no long, position int, partition_key string, record string, "
    "error_code string, error_message string"
)


def to_stream_records(txns: DataFrame) -> DataFrame:
    """``data`` (JSON bytes, fields in declaration order) and ``partition_key``.

    A TIMESTAMP ``transaction_ts`` is written as ISO text ending in ``Z``.
    """
    ts_type = dict(txns.dtypes).get("transaction_ts")
    fields = [
        FM.iso_z(F.col(f)).alias(f) if f == "transaction_ts" and ts_type == "timestamp"
        else F.col(f)
        for f in S.TXN_FIELDS
    ]
    body = F.to_json(F.struct(*fields))
    return txns.select("*", body.cast("binary").alias("data"),
                       F.col("card_id").alias("partition_key"))


def shard_of(key: Column, shard_count: int) -> Column:
    """``shard-<n>`` from the key: the same key always lands on one shard."""
    return F.concat(F.lit("shard-"), F.pmod(F.xxhash64(key), F.lit(shard_count)).cast("string"))


def route_by_key(records: DataFrame, shard_count: int, order: str = "transaction_ts") -> DataFrame:
    """Shard id per record (S7) and per-task order by shard, key and time."""
    routed = records.withColumn("shard_id", shard_of(F.col("partition_key"), shard_count))
    return routed.sortWithinPartitions("shard_id", "partition_key", order)


def number_batches(records: DataFrame, order: Sequence[str],
                   batch_size: int = S.PUT_BATCH_LIMIT) -> DataFrame:
    """``row_index`` in ``order`` and ``batch_no = row_index // batch_size``."""
    if batch_size < 1:
        raise ValueError(f"batch_size must be >= 1, got {batch_size}")
    indexed = with_dense_index(records, order, "row_index")
    return indexed.withColumn("batch_no", F.floor(F.col("row_index") / batch_size).cast("long"))


def send_records(records: DataFrame, put_batch: Callable[[pd.DataFrame], list],
                 order: Sequence[str], outcomes_uri: str,
                 batch_size: int = S.PUT_BATCH_LIMIT) -> DataFrame:
    """Send now, write one outcome row per record to ``outcomes_uri``
    and return that table.  ``records`` holds ``data``, ``partition_key`` and
    the ``order`` columns, which the outcomes repeat; an empty input calls
    nothing.

    The records are staged, as the range partitioning reads them twice (a
    sample, then the rows), and so are its parts.  A key that stands in
    several parts waits in each but the first until the wave of the part
    before is through; every other record belongs to the first wave.  There
    are as many waves as the most frequent key has parts, and each later one
    reads its own parts only."""
    if batch_size < 1:
        raise ValueError(f"batch_size must be >= 1, got {batch_size}")
    spark = records.sparkSession
    keys = ("partition_key", *order)
    order_fields = ", ".join(f"{f.name} {f.dataType.simpleString()}"
                             for f in records.select(*order).schema.fields)
    schema = f"{OUTCOME_COLUMNS}, {order_fields}"

    def send(frames):
        from pyspark import TaskContext

        task, batch_no, held = TaskContext.get().partitionId(), 0, None

        def put(batch: pd.DataFrame) -> pd.DataFrame:
            batch = batch.reset_index(drop=True)
            results = list(put_batch(batch[["data", "partition_key"]]))
            if len(results) != len(batch):
                raise ValueError("put_batch must return one result per record")
            return pd.DataFrame({
                "wave": batch["_wave"], "task": task, "batch_no": batch_no, "position": range(len(batch)),
                "partition_key": batch["partition_key"],
                "record": [bytes(d).decode("utf-8", errors="replace") for d in batch["data"]],
                "error_code": [r[0] if r else None for r in results],
                "error_message": [(r[1] or "") if r else None for r in results],
                **{c: batch[c] for c in order},
            })

        for frame in frames:
            held = frame if held is None else pd.concat((held, frame))
            while len(held) >= batch_size:
                yield put(held.iloc[:batch_size])
                held, batch_no = held.iloc[batch_size:], batch_no + 1
        if held is not None and len(held):
            yield put(held)

    made = stage(records.select("data", *keys), "send-input")
    parts = stage(made.repartitionByRange(*keys).withColumn("_part", F.spark_partition_id()), "send")
    discard(made)
    ends = _part_ends(parts).collect()          # at most two rows per part
    waiting = [(row["_part"], row["partition_key"], row["wave"]) for row in ends if row["wave"] > 0]
    for wave in range(1 + max((w for _, _, w in waiting), default=0)):
        if wave == 0:
            slots, mine = 1 + max((row["_part"] for row in ends), default=0), waiting
            rows = parts.withColumn("_slot", F.col("_part"))
        else:
            mine = [piece for piece in waiting if piece[2] == wave]
            slots = len(mine)
            rows = parts.filter(F.col("_part").isin([part for part, _, _ in mine]))
        if mine:
            listed = F.broadcast(spark.createDataFrame(
                [(*piece[:2], slot) for slot, piece in enumerate(mine)],
                "_its_part int, _its_key string, _slot int"))
            same = (F.col("_part") == F.col("_its_part")) & F.col("partition_key").eqNullSafe(F.col("_its_key"))
            rows = rows.join(listed.drop("_slot") if wave == 0 else listed, same,
                             "left_anti" if wave == 0 else "inner")
        (rows.select("data", *keys, "_slot", F.lit(wave).alias("_wave"))
         .repartitionById(slots, "_slot").sortWithinPartitions(*keys)
         .mapInPandas(send, schema).write.mode("append").parquet(outcomes_uri))
    discard(parts)
    return spark.read.schema(schema).parquet(outcomes_uri)


def _part_ends(parts: DataFrame) -> DataFrame:
    """First and last key of every part and the number of earlier parts that
    hold the key too (``wave``).  Parts follow the order of keys, so no other
    key stands in two parts."""
    from pyspark.sql import Window

    key = F.struct("partition_key")             # a null key counts as one
    held = parts.groupBy("_part").agg(F.min(key).alias("low"), F.max(key).alias("high")).select(
        "_part", F.explode(F.array_distinct(F.array("low", "high"))).alias("end"))
    earlier = F.row_number().over(Window.partitionBy("end").orderBy("_part")) - 1
    return held.select("_part", F.col("end.partition_key"), earlier.alias("wave"))


def send_result(outcomes: DataFrame) -> DataFrame:
    """Totals of one send (S9): one row; failed entries stay as rows
    (``failed_entries``) so they never pass through the driver whole."""
    failed = F.col("error_code").isNotNull()
    return outcomes.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(~failed).alias("success_count"),
        F.count_if(failed).alias("failed_count"),
    )


def failed_entries(outcomes: DataFrame) -> DataFrame:
    """``ErrorCode, ErrorMessage, record`` of every failed record."""
    return outcomes.filter(F.col("error_code").isNotNull()).select(
        F.col("error_code").alias("ErrorCode"),
        F.col("error_message").alias("ErrorMessage"),
        "record", "task", "batch_no", "position",
    )


def sent_out_of_order(outcomes: DataFrame, order: Sequence[str]) -> DataFrame:
    """Records of a send and those that broke the order of their card; one row.

    Late is a record that its task sent after a later one of the card, and
    every record of a piece (the card's records of one task and wave) that
    went out beside an earlier piece, in the same wave, or after later
    records.  The first window holds what a task sent of a card, the second
    the pieces of a card.
    """
    from pyspark.sql import Window

    at = F.struct(*order)
    task = Window.partitionBy("wave", "task", "partition_key").orderBy("batch_no", "position")
    card = Window.partitionBy("partition_key").orderBy("wave", "task")

    def before(value, window):
        return F.max(value).over(window.rowsBetween(Window.unboundedPreceding, -1))

    records = outcomes.select(F.lit(1).alias("sent"), (before(at, task) > at).cast("int").alias("late"))
    pieces = outcomes.groupBy("partition_key", "wave", "task").agg(
        F.min(at).alias("low"), F.max(at).alias("high"), F.count(F.lit(1)).alias("sent"))
    beside = (before("wave", card) == F.col("wave")) | (before("high", card) > F.col("low"))
    pieces = pieces.select(F.lit(0).alias("sent"), F.when(beside, F.col("sent")).alias("late"))
    return records.unionByName(pieces).agg(
        F.coalesce(F.sum("sent"), F.lit(0)).alias("total"),
        F.coalesce(F.sum("late"), F.lit(0)).alias("out_of_order"))


def batch_sizes(numbered: DataFrame) -> DataFrame:
    """Records per put batch."""
    return numbered.groupBy("batch_no").agg(F.count(F.lit(1)).alias("records"))


def preview(txns: DataFrame, order: Sequence[str], start: int = 1) -> DataFrame:
    """``[0001] <id> $    12.34 USD APPROVED  POS        card=41111111… mcc=5411``"""
    indexed = with_dense_index(txns, order, "_i")
    line = F.format_string(
        "[%04d] %s $%9.2f %s %-9s %-10s card=%s… mcc=%s",
        (F.col("_i") + start), F.col("transaction_id"), F.col("amount"), F.col("currency"),
        F.col("auth_status"), F.col("channel"), F.substring("card_id", 1, 8), F.col("mcc_code"),
    )
    return indexed.select((F.col("_i") + start).alias("line_no"), line.alias("line"))

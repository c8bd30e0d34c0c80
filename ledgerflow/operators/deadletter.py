"""Retry, bisect on error, dead-letter the rest.

``process_with_bisect(df, handle)`` hands the rows to ``handle`` in batches
of at most ``batch_size`` rows, inside the tasks that hold them.  A batch
that keeps failing is cut in two and both halves are tried again, down to
single rows; a row that fails alone goes to the dead-letter table with the
error's whole text and the number of calls that had it in hand.  One pass
over the data, no shuffle, nothing per row on the driver.

``handle(batch: pandas.DataFrame)`` has side effects and is called at least
once for every row: again after a failure of its batch, and again when
Spark runs a task a second time.  The outcomes are therefore written once,
to ``dead_letter_uri``, and read from there.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import types as T

BATCH_SIZE = 100


def _tried(batch: pd.DataFrame, handle: Callable, tries: int) -> tuple[str | None, int]:
    """(error of the last try, calls made); the error is None once a call succeeds."""
    error = None
    for call in range(1, tries + 1):
        try:
            handle(batch)
            return None, call
        except Exception as exc:  # the sink's failure is data here
            error = str(exc) or repr(exc)
    return error, tries


def _bisect(batch: pd.DataFrame, handle: Callable, tries: int, before: int) -> Iterator[pd.DataFrame]:
    error, calls = _tried(batch, handle, tries)
    if error is None:
        return
    if len(batch) == 1:
        yield batch.assign(error_message=error, attempts=before + calls)
        return
    half = len(batch) // 2
    for part in (batch.iloc[:half], batch.iloc[half:]):
        yield from _bisect(part, handle, tries, before + calls)


def process_with_bisect(df: DataFrame, handle: Callable[[pd.DataFrame], object], *,
                        dead_letter_uri: str, max_retries: int = 3,
                        batch_size: int = BATCH_SIZE) -> DataFrame:
    """Run ``handle`` over ``df``; the rows that keep failing, with
    ``error_message`` and ``attempts``, from the dead-letter table."""
    if batch_size < 1:
        raise ValueError(f"batch_size must be >= 1, got {batch_size}")
    tries = 1 + max_retries
    schema = T.StructType([*df.schema.fields, T.StructField("error_message", T.StringType()),
                           T.StructField("attempts", T.IntegerType())])

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for at in range(0, len(frame), batch_size):
                yield from _bisect(frame.iloc[at:at + batch_size], handle, tries, 0)

    df.mapInPandas(run, schema).write.mode("append").parquet(dead_letter_uri)
    return df.sparkSession.read.schema(schema).parquet(dead_letter_uri)

"""Text renderings of instants, run ids and partition paths."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def iso_z(ts: Column) -> Column:
    """``2026-04-28T14:00:00Z``; six fraction digits only when non-zero."""
    whole = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")
    frac = F.date_format(ts, "SSSSSS")
    return F.concat(whole, F.when(frac == "000000", F.lit("")).otherwise(
        F.concat(F.lit("."), frac)), F.lit("Z"))


def iso_offset(ts: Column) -> Column:
    """Python ``isoformat()`` of a UTC instant: ``...T14:00:00+00:00``."""
    whole = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")
    frac = F.date_format(ts, "SSSSSS")
    return F.concat(whole, F.when(frac == "000000", F.lit("")).otherwise(
        F.concat(F.lit("."), frac)), F.lit("+00:00"))


def run_id(now: Column, request_id: Column) -> Column:
    """``<iso seconds>___<request id>``; text order is time order."""
    return F.concat(iso_offset(F.date_trunc("second", now)), F.lit("___"), request_id)


def partition_columns(now: Column) -> list[Column]:
    """``year``, ``month``, ``day`` text columns (zero-padded)."""
    return [
        F.date_format(now, "yyyy").alias("year"),
        F.date_format(now, "MM").alias("month"),
        F.date_format(now, "dd").alias("day"),
    ]


def partition_path(now: Column) -> Column:
    """``year=YYYY/month=MM/day=DD`` with no slash at either end."""
    return F.concat(F.lit("year="), F.date_format(now, "yyyy"),
                    F.lit("/month="), F.date_format(now, "MM"),
                    F.lit("/day="), F.date_format(now, "dd"))

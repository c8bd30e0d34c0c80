"""Split a decoded batch into Bronze and Quarantine rows.

``classify`` is the single row-level pass: decode, validate, reason list,
run identity.  Everything after it is a projection (Bronze, Quarantine)
or a per-run count; the counts use a partial aggregate per task, so a
run holding a large share of the rows still ships one row per task to
the final aggregate.
"""

from __future__ import annotations

import uuid
from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schema as S
from ..functions import decode as D
from ..functions import formats as FM
from ..functions import rules as R


def classify(raw: DataFrame, now: Column | None = None,
             request_id: Column | None = None, quarantine_ts: Column | None = None,
             data: str = "data", threshold_seconds: int = S.DRIFT_THRESHOLD_SECONDS,
             rules: Sequence[R.Rule] | None = None,
             run_ts: Column | None = None) -> DataFrame:
    """Decode and validate every raw record of one or many runs.

    ``now`` (reference clock of the freshness rule, cut to seconds),
    ``run_ts`` (the run's processing time: run id, start time and day
    partition; defaults to ``now``) and ``request_id`` may be literals
    (one run) or per-row columns (many runs in one frame, each row
    carrying its run's values).  Adds ``_now``, ``_run_ts``,
    ``request_id``, ``run_id``, ``_quarantine_ts``, ``is_valid``,
    ``reasons``, ``warnings`` and the typed ``txn`` struct.
    """
    if now is None:
        now = F.current_timestamp()
    if request_id is None:
        request_id = F.lit("local")
    now = F.date_trunc("second", now.cast("timestamp"))
    staged = raw.select(
        "*",
        now.alias("_now"),
        request_id.alias("request_id"),
    )
    run_ts = (F.col("_now") if run_ts is None
              else F.date_trunc("second", run_ts.cast("timestamp")))
    staged = staged.select("*", run_ts.alias("_run_ts"))
    staged = staged.select(
        "*",
        FM.run_id(F.col("_run_ts"), F.col("request_id")).alias("run_id"),
        FM.iso_offset(quarantine_ts if quarantine_ts is not None else F.col("_run_ts"))
        .alias("_quarantine_ts"),
    )
    decoded = D.decode(staged, data)
    validated = R.validate(decoded, now=F.col("_now"),
                           threshold_seconds=threshold_seconds, rules=rules)
    decode_ok = F.col("_decode_kind") == D.KIND_OK
    result = validated.select(
        *[c for c in validated.columns if c not in ("is_valid", "_reasons", "_warnings")],
        (decode_ok & F.col("is_valid")).alias("is_valid"),
        F.when(decode_ok, F.col("_reasons"))
        .otherwise(F.array(F.col("_decode_reason"))).alias("reasons"),
        F.when(decode_ok, F.col("_warnings"))
        .otherwise(F.array().cast("array<string>")).alias("warnings"),
    )
    return observe_counts(result)


def observe_counts(classified: DataFrame, name: str | None = None) -> DataFrame:
    """Attach record / valid counts as observed metrics (T5 without a pass).

    The metrics node also keeps later filters (``is_valid``, or the one
    ``explode`` implies) above the classification: pushed below it, a
    filter would have every rule expression substituted into it, which
    grows the plan far faster than the rules themselves.
    """
    name = name or f"classify_{uuid.uuid4().hex[:12]}"
    return classified.observe(
        name,
        F.count(F.lit(1)).alias("records"),
        F.count_if(F.col("is_valid")).alias("valid"),
    )


def bronze_columns() -> list[Column]:
    """Canonical Bronze fields (T1): nine fields, extras dropped."""
    t = F.col("txn")
    return [
        t["transaction_id"].alias("transaction_id"),
        t["card_id"].alias("card_id"),
        t["merchant_id"].alias("merchant_id"),
        t["amount"].alias("amount"),
        t["currency"].alias("currency"),
        FM.iso_z(t["transaction_ts"]).alias("transaction_ts"),
        t["mcc_code"].alias("mcc_code"),
        t["auth_status"].alias("auth_status"),
        t["channel"].alias("channel"),
    ]


def bronze_rows(classified: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Canonical Bronze projection (T1) of the valid rows."""
    return classified.filter(F.col("is_valid")).select(*keep, *bronze_columns())


def _value_text(name: str, data: str) -> Column:
    """A payload field as text: strings as they are, numbers as they were
    written, containers as JSON text; NULL for an absent or null field."""
    ref = R.FieldRef(name)
    text = F.replace(F.try_variant_get(ref.value, "$", "string"), F.lit(D.LONE_SURROGATE), F.lit("\ufffd"))
    # The last number written under this key, if it has the parsed value.
    written = F.regexp_extract(F.col(data).cast("string"), rf'(?s).*"{name}"\s*:\s*(-?[0-9][0-9.eE+-]*)', 1)
    same = written.try_cast("double") == F.try_variant_get(ref.value, "$", "double")
    return F.when(ref.is_number & same, written).otherwise(text)


def quarantine_columns(data: str = "data") -> list[Column]:
    """Quarantine fields (T2, T3): one fixed shape for both failure paths.

    Decode failures carry ``_raw_b64``; validation failures carry the
    payload: ``payload_json`` is the decoded text as it arrived (key order,
    number text, extra keys), and each known field is repeated as text for
    filtering.  Our two
    ``_quarantine_*`` columns sit beside the payload, so a payload key of
    the same name never overrides them.
    """
    decoded = F.col("_decode_kind") == D.KIND_OK
    return [
        F.when(~decoded, D.raw_b64(F.col(data))).alias("_raw_b64"),
        F.when(decoded, F.col(data).cast("string")).alias("payload_json"),
        *[F.when(decoded, _value_text(f, data)).alias(f) for f in S.TXN_FIELDS],
        F.col("reasons").alias("_quarantine_reason"),
        F.col("_quarantine_ts").alias("_quarantine_ts"),
    ]


def quarantine_rows(classified: DataFrame, data: str = "data",
                    keep: Sequence[str] = ()) -> DataFrame:
    """Quarantine projection of the rejected rows."""
    return classified.filter(~F.col("is_valid")).select(*keep, *quarantine_columns(data))


def routed(classified: DataFrame, keep: Sequence[str], data: str = "data",
           warnings: bool = False) -> DataFrame:
    """The narrow result of a batch: ``keep`` columns, ``is_valid`` and one
    struct per destination (``_bronze`` for valid rows, ``_quarantine``
    otherwise).  This is what a handler stages: about the size of the
    input, without the parse intermediates.  With ``warnings`` the Bronze
    struct ends in ``_quality_warnings``, the codes of the rules that warn."""
    valid = F.col("is_valid")
    tags = [F.col("warnings").alias("_quality_warnings")] if warnings else []
    return classified.select(
        *keep, "is_valid",
        F.when(valid, F.struct(*bronze_columns(), *tags)).alias("_bronze"),
        F.when(~valid, F.struct(*quarantine_columns(data))).alias("_quarantine"),
    )


def run_counts(classified: DataFrame, keys: Sequence[str] = ("run_id",)) -> DataFrame:
    """Per-run counts and status (T5, T6); ``total = valid + quarantined``."""
    counted = classified.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.col("is_valid")).alias("valid"),
    )
    quarantined = F.col("total") - F.col("valid")
    return counted.select(
        *keys, "total", "valid",
        quarantined.alias("quarantined"),
        F.when(quarantined == 0, F.lit(S.STATUS_SUCCESS))
        .otherwise(F.lit(S.STATUS_PARTIAL)).alias("run_status"),
    )

"""Validation rules kept as a table and compiled into Columns.

One row of the table is one rule: ``version, position, rule_id, field,
check, arguments, severity``.  ``compile_rules`` turns the rows of a version
into the rule objects ``validate`` takes, so that rules can be changed, kept
and compared without a release.  Everything about the table is checked on
the driver before a record is read; all faults are reported together.

Arguments are texts: numbers as such, lists as JSON arrays.  Rules report
in the order of ``position``.

Scale: a version has at most ``MAX_RULES`` rows (a larger one is refused),
and they become expressions of one projection, not a join.  Several versions
side by side read, parse and extract each record once.
"""

from __future__ import annotations

import json
import math
import uuid
from dataclasses import dataclass, field, replace
from typing import Any, Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schema as S
from . import rules as R

MAX_RULES = 1000

RULE_TABLE_SCHEMA = T.StructType([
    T.StructField("version", T.IntegerType()),
    T.StructField("position", T.IntegerType()),
    T.StructField("rule_id", T.StringType()),
    T.StructField("field", T.StringType()),
    T.StructField("check", T.StringType()),
    T.StructField("arguments", T.MapType(T.StringType(), T.StringType())),
    T.StructField("severity", T.StringType()),
])

SEVERITIES = (S.SEVERITY_ERROR, S.SEVERITY_WARNING)


class RuleTableError(ValueError):
    """The rule table can't be used; the message lists every fault."""


# ---------------------------------------------------------------------------
# Arguments
# ---------------------------------------------------------------------------
def _count(text: str) -> int:
    value = int(text)
    if value < 0:
        raise ValueError("is negative")
    return value


def _number(text: str) -> float:
    value = float(text)
    if not math.isfinite(value):
        raise ValueError("is not finite")
    return value


def _texts(text: str) -> list[str]:
    values = json.loads(text)
    if not isinstance(values, list) or not values or not all(isinstance(v, str) for v in values):
        raise ValueError("is not a JSON array of texts")
    return values


def _pattern(text: str) -> str:
    compiler = SparkSession.active()._jvm.java.util.regex.Pattern
    try:
        compiler.compile(text)
    except Exception as fault:
        raise ValueError("is not a regular expression") from fault
    return text


# ---------------------------------------------------------------------------
# Checks
# ---------------------------------------------------------------------------
@dataclass(frozen=True)
class Check:
    """What a row may ask for: a builder, its arguments and where it applies."""

    build: Callable[..., Callable[[R.RuleContext], Column]]
    stage: str = R.STAGE_SCHEMA
    fields: tuple[str, ...] = S.TXN_FIELDS
    required: Mapping[str, Callable[[str], Any]] = field(default_factory=dict)
    optional: Mapping[str, Callable[[str], Any]] = field(default_factory=dict)
    bounds: tuple[str, str] | None = None        # arguments that must be in order


def _pattern_rule(name: str, pattern: str) -> Callable[[R.RuleContext], Column]:
    """A text that doesn't hold the pattern; absent and other values are left to other checks."""
    def build(ctx: R.RuleContext) -> Column:
        f = ctx.field(name)
        return F.when(f.is_string & ~f.text.rlike(pattern), f.invalid("string_pattern_mismatch"))
    return build


def _drift_rule(name: str, threshold_seconds: int | None = None) -> Callable[[R.RuleContext], Column]:
    def build(ctx: R.RuleContext) -> Column:
        own = ctx if threshold_seconds is None else replace(ctx, threshold_seconds=threshold_seconds)
        return R.drift_rule(name)(own)
    return build


CHECKS: dict[str, Check] = {
    "uuid": Check(R.uuid_rule),
    "text": Check(R.text_rule, optional={"min_length": _count, "max_length": _count},
                  bounds=("min_length", "max_length")),
    "pattern": Check(_pattern_rule, required={"pattern": _pattern}),
    "one_of": Check(R.enum_rule, required={"values": _texts}),
    # only these fields have a typed number / instant
    "number_range": Check(R.amount_rule, fields=("amount",), required={"low": _number, "high": _number},
                          bounds=("low", "high")),
    "datetime": Check(R.datetime_rule, fields=("transaction_ts",)),
    "has_timezone": Check(R.naive_timestamp_rule, stage=R.STAGE_POST, fields=("transaction_ts",)),
    "freshness": Check(_drift_rule, stage=R.STAGE_POST, fields=("transaction_ts",),
                       optional={"threshold_seconds": _count}),
}


def _arguments(check: Check, given: Mapping[str, str]) -> tuple[dict[str, Any], list[str]]:
    """Parsed arguments and the faults found in them."""
    known = {**check.required, **check.optional}
    faults = [f"argument {name!r} is unknown" for name in sorted(set(given) - set(known))]
    faults += [f"argument {name!r} is missing" for name in check.required if given.get(name) is None]
    parsed: dict[str, Any] = {}
    for name, text in given.items():
        if name in known and text is not None:
            try:
                parsed[name] = known[name](text)
            except ValueError as fault:
                faults.append(f"argument {name!r}: {fault}")
    if check.bounds and all(name in parsed for name in check.bounds):
        low, high = (parsed[name] for name in check.bounds)
        if low > high:
            faults.append(f"{check.bounds[0]} is above {check.bounds[1]}")
    return parsed, faults


def _compile(row) -> tuple[R.Rule | None, list[str]]:
    check = CHECKS.get(row["check"])
    faults = []
    if not row["rule_id"]:
        faults.append("rule_id is empty")
    if row["position"] is None:
        faults.append("position is empty")
    if row["severity"] not in SEVERITIES:
        faults.append(f"severity {row['severity']!r} is unknown")
    if row["field"] not in S.TXN_FIELDS:
        faults.append(f"field {row['field']!r} is unknown")
    if check is None:
        return None, [*faults, f"check {row['check']!r} is unknown"]
    if row["field"] in S.TXN_FIELDS and row["field"] not in check.fields:
        faults.append(f"check {row['check']!r} can't judge field {row['field']!r}")
    parsed, wrong = _arguments(check, row["arguments"] or {})
    faults += wrong
    if faults:
        return None, faults
    return R.Rule(row["rule_id"], row["field"], check.stage, row["severity"],
                  check.build(row["field"], **parsed)), []


def compile_rules(table: DataFrame, version: int) -> list[R.Rule]:
    """The rules of one version, in report order.

    Raises ``RuleTableError`` for a version without rows or with more than
    ``MAX_RULES``, repeated rule ids or positions, and any row whose check,
    field, severity or arguments can't be used.
    """
    rows = (table.filter(F.col("version") == version)
            .orderBy(F.col("position").asc_nulls_first(), "rule_id").limit(MAX_RULES + 1).collect())
    if not rows:
        raise RuleTableError(f"version {version} has no rules")
    if len(rows) > MAX_RULES:
        raise RuleTableError(f"version {version} has more than {MAX_RULES} rules")
    compiled, faults = [], []
    for row in rows:
        rule, wrong = _compile(row)
        faults += [f"{row['rule_id']}: {fault}" for fault in wrong]
        compiled.append(rule)
    for name in ("rule_id", "position"):
        values = [row[name] for row in rows if row[name] is not None]
        faults += [f"{name} {value!r} is repeated" for value in sorted({v for v in values if values.count(v) > 1})]
    if faults:
        raise RuleTableError(f"version {version}: " + "; ".join(faults))
    return compiled


def default_rows(version: int = 1) -> list[tuple]:
    """The built-in rules as rows of the table."""
    err = S.SEVERITY_ERROR
    rules = [
        ("TXN_ID", "transaction_id", "uuid", {}, err),
        ("TXN_CARD", "card_id", "text", {"min_length": "1"}, err),
        ("TXN_MERCHANT", "merchant_id", "text", {"min_length": "1"}, err),
        ("TXN_AMOUNT", "amount", "number_range", {"low": str(S.AMOUNT_MIN), "high": str(S.AMOUNT_MAX)}, err),
        ("TXN_CURRENCY", "currency", "one_of", {"values": json.dumps(S.CURRENCIES)}, err),
        ("TXN_TS", "transaction_ts", "datetime", {}, err),
        ("TXN_MCC", "mcc_code", "text", {"min_length": str(S.MCC_LENGTH), "max_length": str(S.MCC_LENGTH)}, err),
        ("TXN_AUTH", "auth_status", "one_of", {"values": json.dumps(S.AUTH_STATUSES)}, err),
        ("TXN_CHANNEL", "channel", "one_of", {"values": json.dumps(S.CHANNELS)}, err),
        ("TXN_TS_TZ", "transaction_ts", "has_timezone", {}, err),
        ("TXN_002", "transaction_ts", "freshness", {}, err),
    ]
    return [(version, position, *rule) for position, rule in enumerate(rules)]


def save_rules(spark: SparkSession, rows: Sequence[tuple], uri: str) -> None:
    """Append rows to a stored rule table, one folder per version."""
    table = spark.createDataFrame(list(rows), RULE_TABLE_SCHEMA)
    table.coalesce(1).write.mode("append").partitionBy("version").parquet(uri)


def read_rules(spark: SparkSession, uri: str) -> DataFrame:
    return spark.read.schema(RULE_TABLE_SCHEMA).parquet(uri)


# ---------------------------------------------------------------------------
# Versions side by side
# ---------------------------------------------------------------------------
def compare_versions(decoded: DataFrame, versions: Mapping[int, Sequence[R.Rule]], now: Column,
                     threshold_seconds: int = S.DRIFT_THRESHOLD_SECONDS,
                     payload: str = "_payload") -> DataFrame:
    """``decoded`` plus ``outcomes``: one struct ``version, errors, warnings`` per version.

    Fields are extracted and typed once for all versions; the outcome of a
    version is what ``validate`` gives with its rules alone.  The observed
    counts are boundaries: neither a later step nor a filter or ``inline``
    over the outcomes may copy the rules of all versions into itself.
    """
    ctx = R.RuleContext(now=now, threshold_seconds=threshold_seconds)
    none = F.array().cast("array<string>")

    def reasons(rules: Sequence[R.Rule], stage: str, severity: str) -> Column:
        return R._collect([r.build(ctx) for r in rules if r.stage == stage and r.severity == severity])

    def bounded(df: DataFrame) -> DataFrame:
        return df.observe(f"versions-{uuid.uuid4().hex}", F.count(F.lit(1)).alias("records"))

    staged = bounded(R._typed_values(R.extract_fields(decoded, payload)))
    staged = bounded(staged.select("*", *[
        reasons(rules, R.STAGE_SCHEMA, severity).alias(f"_{severity}_{version}")
        for version, rules in versions.items() for severity in SEVERITIES]))

    def outcome(version: int, rules: Sequence[R.Rule]) -> Column:
        errors, warnings = (F.col(f"_{severity}_{version}") for severity in SEVERITIES)
        typed_ok = F.size(errors) == 0
        return F.struct(
            F.lit(version).alias("version"),
            F.when(typed_ok, reasons(rules, R.STAGE_POST, S.SEVERITY_ERROR)).otherwise(errors).alias("errors"),
            F.concat(warnings, F.when(typed_ok, reasons(rules, R.STAGE_POST, S.SEVERITY_WARNING))
                     .otherwise(none)).alias("warnings"))

    return bounded(staged.select(*decoded.columns, F.array(
        *[outcome(version, rules) for version, rules in versions.items()]).alias("outcomes")))

"""Per-field validation rules as Column factories.

A rule is data: an id, the field it reports on, a stage and a severity,
plus a function building one nullable reason-string Column.  ``validate``
evaluates every rule of the registry in one projection, collects the
non-null reasons in registry order and routes by severity:

* ``schema`` rules run on every decoded object; their reasons follow the
  transaction field order (one reason per field, first failing check).
* ``post`` rules (naive timestamp, freshness) run only when no schema
  rule failed, as the freshness check only runs on a typed record.

Coercion follows lax JSON validation: numbers given as text are read as
numbers, ``true`` is 1.0, a digit string or number is an epoch time
(seconds up to 2e10, otherwise milliseconds).  The JSON type of every
field comes from its VARIANT value, so ``"5411"`` and ``5411`` differ.
"""

from __future__ import annotations

from dataclasses import dataclass, replace
from typing import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schema as S
from .decode import LONE_SURROGATE

# ---------------------------------------------------------------------------
# Fixed text patterns (accepted input shapes).
# ---------------------------------------------------------------------------
_HEX = "[0-9a-fA-F]"
_UUID_HYPHENATED = f"{_HEX}{{8}}-{_HEX}{{4}}-{_HEX}{{4}}-{_HEX}{{4}}-{_HEX}{{12}}"
# 32 hex digits, hyphenated, braced hyphenated, or urn:uuid: hyphenated.
UUID_PATTERN = (
    f"^(?:{_HEX}{{32}}|{_UUID_HYPHENATED}|\\{{{_UUID_HYPHENATED}\\}}"
    f"|urn:uuid:{_UUID_HYPHENATED})\\z"
)
# Decimal text with optional exponent; underscores only between digits;
# inf / infinity / nan in any case; surrounding white space allowed, which
# is every character Unicode calls white space.
_WS = r"[\s\u0085\u00A0\u1680\u2000-\u200A\u2028\u2029\u202F\u205F\u3000]"
_DIGITS = r"\d+(?:_\d+)*"
FLOAT_TEXT_PATTERN = (
    rf"^{_WS}*[+-]?(?:(?:{_DIGITS}(?:\.(?:{_DIGITS})?)?|\.{_DIGITS})"
    rf"(?:[eE][+-]?{_DIGITS})?|(?i:inf|infinity|nan)){_WS}*\z"
)
# Date, optional time (seconds and fraction optional) and offset.
# Groups: 1 year 2 month 3 day 4 hour 5 minute 6 second 7 fraction
#         8 Z/z 9 sign 10 offset hours 11 offset minutes
ISO_TS_PATTERN = (
    r"^(\d{4})-(\d{2})-(\d{2})"
    r"(?:[Tt _](\d{2}):(\d{2})(?::(\d{2})(?:[.,](\d+))?)?"
    r"(?:([Zz])|([+\-\u2212])(\d{2}):?(\d{2}))?)?\z"
)
EPOCH_TEXT_PATTERN = r"^[+-]?\d+(?:\.\d+)?\z"
# The calendar has no year 0: a well-formed date in it is its own error.
YEAR_ZERO_PATTERN = r"^0000-(?:0[1-9]|1[0-2])-(?:0[1-9]|[12]\d|3[01])(?:[Tt _]|\z)"
# Epoch values above this magnitude are milliseconds.
EPOCH_MS_THRESHOLD = 2e10
# Instants representable as a calendar date in years 1..9999.
MIN_EPOCH_SECONDS = -62135596800
MAX_EPOCH_SECONDS = 253402300799

_NUMERIC_TYPES = ("BIGINT", "INT", "SMALLINT", "TINYINT", "DOUBLE", "FLOAT")

# JSON kind of a field value, decided once per field from its VARIANT type.
KIND_STRING = "s"
KIND_NUMBER = "n"
KIND_BOOL = "b"
KIND_OTHER = "o"                     # null, array, object

STAGE_SCHEMA = "schema"
STAGE_POST = "post"


class FieldRef:
    """Columns describing one payload field after extraction."""

    def __init__(self, name: str):
        self.name = name
        self.value = F.col(f"_f_{name}")          # VARIANT, NULL if absent
        self.kind = F.col(f"_t_{name}")           # JSON kind code (KIND_*)
        self.text = F.col(f"_s_{name}")           # value if a JSON string

    @property
    def absent(self) -> Column:
        return self.value.isNull()

    @property
    def is_string(self) -> Column:
        return self.kind == KIND_STRING

    @property
    def is_number(self) -> Column:
        return self.kind == KIND_NUMBER

    @property
    def is_bool(self) -> Column:
        return self.kind == KIND_BOOL

    def missing(self) -> Column:
        return F.lit(f"{S.MISSING_FIELD}:{self.name}")

    def invalid(self, error_type: str) -> Column:
        return F.lit(f"{S.INVALID_FIELD}:{self.name}:{error_type}")


@dataclass(frozen=True)
class RuleContext:
    now: Column
    threshold_seconds: int

    def field(self, name: str) -> FieldRef:
        return FieldRef(name)


@dataclass(frozen=True)
class Rule:
    rule_id: str
    field: str | None
    stage: str
    severity: str
    build: Callable[[RuleContext], Column]


# ---------------------------------------------------------------------------
# Rule builders
# ---------------------------------------------------------------------------
def uuid_rule(name: str) -> Callable[[RuleContext], Column]:
    def build(ctx: RuleContext) -> Column:
        f = ctx.field(name)
        return (
            F.when(f.absent, f.missing())
            .when(~f.is_string, f.invalid("uuid_type"))
            .when(~f.text.rlike(UUID_PATTERN), f.invalid("uuid_parsing"))
        )
    return build


def text_rule(name: str, min_length: int = 1,
              max_length: int | None = None) -> Callable[[RuleContext], Column]:
    def build(ctx: RuleContext) -> Column:
        f = ctx.field(name)
        rule = (
            F.when(f.absent, f.missing())
            .when(~f.is_string, f.invalid("string_type"))
            .when(F.contains(f.text, F.lit(LONE_SURROGATE)), f.invalid("string_unicode"))
            .when(F.char_length(f.text) < min_length, f.invalid("string_too_short"))
        )
        if max_length is not None:
            rule = rule.when(F.char_length(f.text) > max_length,
                             f.invalid("string_too_long"))
        return rule
    return build


def amount_rule(name: str, low: float, high: float) -> Callable[[RuleContext], Column]:
    def build(ctx: RuleContext) -> Column:
        f = ctx.field(name)
        number = F.col(f"_n_{name}")
        # upper bound is checked first, so NaN reports less_than_equal
        return (
            F.when(f.absent, f.missing())
            .when(~(f.is_number | f.is_bool | f.is_string), f.invalid("float_type"))
            .when(number.isNull(), f.invalid("float_parsing"))
            .when(~(number <= F.lit(high)), f.invalid("less_than_equal"))
            .when(~(number >= F.lit(low)), f.invalid("greater_than_equal"))
        )
    return build


def enum_rule(name: str, values: Sequence[str]) -> Callable[[RuleContext], Column]:
    def build(ctx: RuleContext) -> Column:
        f = ctx.field(name)
        return (
            F.when(f.absent, f.missing())
            .when(~(f.is_string & f.text.isin(*values)), f.invalid("enum"))
        )
    return build


def datetime_rule(name: str) -> Callable[[RuleContext], Column]:
    def build(ctx: RuleContext) -> Column:
        f = ctx.field(name)
        ts = F.col(f"_ts_{name}")
        epoch_like = f.is_number | (f.is_string & f.text.rlike(EPOCH_TEXT_PATTERN))
        return (
            F.when(f.absent, f.missing())
            .when(~(f.is_number | f.is_string), f.invalid("datetime_type"))
            .when(ts.isNotNull(), F.lit(None).cast("string"))
            .when(epoch_like | (f.is_string & f.text.rlike(YEAR_ZERO_PATTERN)),
                  f.invalid("datetime_parsing"))
            .otherwise(f.invalid("datetime_from_date_parsing"))
        )
    return build


def naive_timestamp_rule(name: str) -> Callable[[RuleContext], Column]:
    def build(ctx: RuleContext) -> Column:
        return F.when(F.col(f"_naive_{name}"), F.lit(S.TIMEZONE_MISSING))
    return build


def drift_rule(name: str) -> Callable[[RuleContext], Column]:
    def build(ctx: RuleContext) -> Column:
        ts = F.col(f"_ts_{name}")
        drift_us = F.abs(F.unix_micros(ctx.now) - F.unix_micros(ts))
        limit_us = F.lit(int(ctx.threshold_seconds) * 1_000_000)
        # a naive time has no instant to compare, so only its own code applies
        return F.when(~F.col(f"_naive_{name}") & (drift_us > limit_us),
                      F.lit(S.TIMESTAMP_DRIFT))
    return build


def default_rules() -> list[Rule]:
    """The transaction rule registry, in report order."""
    err = S.SEVERITY_ERROR
    return [
        Rule("TXN_ID", "transaction_id", STAGE_SCHEMA, err, uuid_rule("transaction_id")),
        Rule("TXN_CARD", "card_id", STAGE_SCHEMA, err, text_rule("card_id")),
        Rule("TXN_MERCHANT", "merchant_id", STAGE_SCHEMA, err, text_rule("merchant_id")),
        Rule("TXN_AMOUNT", "amount", STAGE_SCHEMA, err,
             amount_rule("amount", S.AMOUNT_MIN, S.AMOUNT_MAX)),
        Rule("TXN_CURRENCY", "currency", STAGE_SCHEMA, err, enum_rule("currency", S.CURRENCIES)),
        Rule("TXN_TS", "transaction_ts", STAGE_SCHEMA, err, datetime_rule("transaction_ts")),
        Rule("TXN_MCC", "mcc_code", STAGE_SCHEMA, err,
             text_rule("mcc_code", S.MCC_LENGTH, S.MCC_LENGTH)),
        Rule("TXN_AUTH", "auth_status", STAGE_SCHEMA, err,
             enum_rule("auth_status", S.AUTH_STATUSES)),
        Rule("TXN_CHANNEL", "channel", STAGE_SCHEMA, err, enum_rule("channel", S.CHANNELS)),
        Rule("TXN_TS_TZ", "transaction_ts", STAGE_POST, err,
             naive_timestamp_rule("transaction_ts")),
        Rule("TXN_002", "transaction_ts", STAGE_POST, err, drift_rule("transaction_ts")),
    ]


def with_severity(rules: Sequence[Rule], rule_id: str, severity: str) -> list[Rule]:
    """Registry copy with one rule moved to another severity."""
    return [replace(r, severity=severity) if r.rule_id == rule_id else r for r in rules]


# ---------------------------------------------------------------------------
# Field extraction and typed values
# ---------------------------------------------------------------------------
def _string_value(v: Column, kind: Column) -> Column:
    return F.when(kind == KIND_STRING, F.try_variant_get(v, "$", "string"))


def _float_value(f: FieldRef) -> Column:
    stripped = F.regexp_replace(F.regexp_replace(f.text, rf"^{_WS}+|{_WS}+\z", ""), "_", "")
    return (
        F.when(f.is_number | f.is_bool, F.try_variant_get(f.value, "$", "double"))
        .when(f.is_string & f.text.rlike(FLOAT_TEXT_PATTERN), stripped.try_cast("double"))
    )


def _timestamp_value(f: FieldRef) -> tuple[Column, Column]:
    """(instant as TIMESTAMP, naive flag) for a datetime field.

    One ``regexp_replace`` rewrites a matching text into its eleven parts
    joined by ``|`` (a group that did not take part becomes empty) and one
    ``split`` reads them, instead of one regular-expression pass per part.
    """
    iso = f.is_string & f.text.rlike(ISO_TS_PATTERN)
    parts = F.split(F.regexp_replace(f.text, ISO_TS_PATTERN,
                                     "$1|$2|$3|$4|$5|$6|$7|$8|$9|$10|$11"), r"\|")
    g = [None] + [F.element_at(parts, i) for i in range(1, 12)]

    def part(i: int, default: str) -> Column:
        return F.when(g[i] == "", F.lit(default)).otherwise(g[i])

    fraction = F.rpad(F.substring(g[7], 1, 6), 6, "0")
    local_text = F.concat(g[1], F.lit("-"), g[2], F.lit("-"), g[3], F.lit(" "),
                          part(4, "00"), F.lit(":"), part(5, "00"), F.lit(":"),
                          part(6, "00"), F.lit("."), fraction)
    local = F.try_to_timestamp(local_text, F.lit("yyyy-MM-dd HH:mm:ss.SSSSSS"))
    has_sign = g[9] != ""
    offset_ok = ~has_sign | ((g[10].cast("int") < 24) & (g[11].cast("int") < 60))
    sign = F.when(g[9].isin("-", "\u2212"), F.lit(-1)).otherwise(F.lit(1))
    offset_us = F.when(has_sign, sign * (g[10].cast("long") * 3600 + g[11].cast("long") * 60)
                       ).otherwise(F.lit(0)) * F.lit(1_000_000)
    iso_ts = F.when(iso & offset_ok & (g[1] != "0000") & local.isNotNull(),
                    F.timestamp_micros(F.unix_micros(local) - offset_us))
    naive = iso & ((g[8] == "") & ~has_sign)

    epoch = (
        F.when(f.is_number, F.try_variant_get(f.value, "$", "double"))
        .when(f.is_string & f.text.rlike(EPOCH_TEXT_PATTERN), f.text.try_cast("double"))
    )
    seconds = F.when(F.abs(epoch) > F.lit(EPOCH_MS_THRESHOLD), epoch / 1000).otherwise(epoch)
    in_range = (seconds >= MIN_EPOCH_SECONDS) & (seconds <= MAX_EPOCH_SECONDS)
    epoch_ts = F.when(in_range, F.timestamp_micros(F.round(seconds * 1_000_000).cast("long")))

    instant = F.when(iso, iso_ts).otherwise(epoch_ts)
    return instant, F.coalesce(naive & instant.isNotNull(), F.lit(False))


def extract_fields(df: DataFrame, payload: str = "_payload",
                   fields: Sequence[str] = S.TXN_FIELDS) -> DataFrame:
    """One projection pulling every field out of the payload VARIANT."""
    p = F.col(payload)
    out = df.select(
        "*",
        *[F.variant_get(p, f"$.{name}", "variant").alias(f"_f_{name}") for name in fields],
    )
    out = out.select(
        "*",
        *[_kind(F.schema_of_variant(F.col(f"_f_{name}"))).alias(f"_t_{name}")
          for name in fields],
    )
    return out.select(
        "*",
        *[_string_value(F.col(f"_f_{n}"), F.col(f"_t_{n}")).alias(f"_s_{n}") for n in fields],
    )


def _kind(vtype: Column) -> Column:
    return (F.when(vtype == "STRING", F.lit(KIND_STRING))
            .when(vtype.isin(*_NUMERIC_TYPES) | vtype.startswith("DECIMAL"), F.lit(KIND_NUMBER))
            .when(vtype == "BOOLEAN", F.lit(KIND_BOOL))
            .when(vtype.isNotNull(), F.lit(KIND_OTHER)))


def _typed_values(df: DataFrame) -> DataFrame:
    amount = FieldRef("amount")
    ts, naive = _timestamp_value(FieldRef("transaction_ts"))
    return df.select(
        "*",
        _float_value(amount).alias("_n_amount"),
        ts.alias("_ts_transaction_ts"),
        naive.alias("_naive_transaction_ts"),
    )


def canonical_uuid(text: Column) -> Column:
    hexes = F.lower(F.regexp_replace(text, r"^urn:uuid:|[{}-]", ""))
    return F.concat_ws("-", F.substring(hexes, 1, 8), F.substring(hexes, 9, 4),
                       F.substring(hexes, 13, 4), F.substring(hexes, 17, 4),
                       F.substring(hexes, 21, 12))


def _collect(columns: list[Column]) -> Column:
    """Non-null reasons in order; ``concat`` of one-element arrays keeps the
    whole expression inside generated code (a lambda would not be)."""
    empty = F.array().cast("array<string>")
    if not columns:
        return empty
    return F.concat(*[F.when(c.isNotNull(), F.array(c)).otherwise(empty) for c in columns])


def validate(df: DataFrame, now: Column | None = None,
             threshold_seconds: int = S.DRIFT_THRESHOLD_SECONDS,
             rules: Sequence[Rule] | None = None,
             payload: str = "_payload") -> DataFrame:
    """Add ``_reasons`` (errors), ``_warnings``, ``is_valid`` and ``txn``.

    ``now`` is the reference instant of the freshness rule: one value per
    micro-batch (a literal or a per-batch column).  It defaults to the
    query start time cut to whole seconds.
    """
    rules = list(default_rules() if rules is None else rules)
    if now is None:
        now = F.date_trunc("second", F.current_timestamp())
    ctx = RuleContext(now=now, threshold_seconds=threshold_seconds)

    staged = _typed_values(extract_fields(df, payload))

    def stage_reasons(stage: str, severity: str) -> Column:
        return _collect([r.build(ctx) for r in rules
                         if r.stage == stage and r.severity == severity])

    schema_err = stage_reasons(STAGE_SCHEMA, S.SEVERITY_ERROR)
    staged = staged.select(
        "*",
        schema_err.alias("_schema_reasons"),
        stage_reasons(STAGE_SCHEMA, S.SEVERITY_WARNING).alias("_schema_warnings"),
    )
    typed_ok = F.size("_schema_reasons") == 0
    empty = F.array().cast("array<string>")
    post_err = stage_reasons(STAGE_POST, S.SEVERITY_ERROR)
    post_warn = stage_reasons(STAGE_POST, S.SEVERITY_WARNING)
    staged = staged.select(
        "*",
        F.when(typed_ok, post_err).otherwise(F.col("_schema_reasons")).alias("_reasons"),
        F.concat(F.col("_schema_warnings"),
                 F.when(typed_ok, post_warn).otherwise(empty)).alias("_warnings"),
    )
    txn = F.struct(
        canonical_uuid(F.col("_s_transaction_id")).alias("transaction_id"),
        F.col("_s_card_id").alias("card_id"),
        F.col("_s_merchant_id").alias("merchant_id"),
        F.col("_n_amount").alias("amount"),
        F.col("_s_currency").alias("currency"),
        F.col("_ts_transaction_ts").alias("transaction_ts"),
        F.col("_s_mcc_code").alias("mcc_code"),
        F.col("_s_auth_status").alias("auth_status"),
        F.col("_s_channel").alias("channel"),
    )
    return staged.select(
        "*",
        (F.size("_reasons") == 0).alias("is_valid"),
        F.when(F.size("_reasons") == 0, txn).alias("txn"),
    )


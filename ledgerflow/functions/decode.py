"""Decode raw record bytes into a JSON object.

All checks are column expressions evaluated in the JVM:

1. UTF-8: ``is_valid_utf8`` on the bytes read as text.
2. JSON: the text must be exactly one JSON value.  ``try_parse_json``
   stops at the end of the first value and ignores what follows, so the
   text is parsed wrapped as ``[t]`` (exactly one element, and trailing
   text becomes a syntax error); text holding a ``]`` is also parsed as
   ``{"r": t}`` which rejects a stray ``]`` that could close the array
   early.
   Two things Python's parser accepts and the JVM's does not are rewritten
   first, in rows that hold them: the bare literals NaN and Infinity
   become numbers beyond every range, and an escape of half a surrogate
   pair becomes a marker that the text rules report.
3. Object shape: the first non-blank character of a valid JSON text
   names its type, so no second walk over the value is needed.

The first failing check wins, every input row lands in exactly one
outcome, and the payload VARIANT is parsed once per row.
"""

from __future__ import annotations

import uuid

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schema as S

KIND_OK = "ok"
KIND_UTF8 = "utf8"
KIND_JSON = "json"
KIND_NOT_DICT = "not_dict"


# Two noncharacters stand for an unpaired surrogate, which no text column
# can hold.
LONE_SURROGATE = "\ufffe\uffff"
_LONE_ESCAPE = r"\\ufffe\\uffff"
_HIGH, _LOW = r"\\u[dD][89aAbB][0-9a-fA-F]{2}", r"\\u[dD][c-fC-F][0-9a-fA-F]{2}"
_MARK = "\x01"      # never valid in JSON text, so free to mark a literal


def parseable(text: Column) -> Column:
    """``text`` with the literals and escapes only Python's parser accepts rewritten."""
    # A backslash pair before the escape is a literal backslash, not its start.
    lead = r"(?<!\\)((?:\\\\)*+)"
    whole = F.regexp_replace(
        F.regexp_replace(text, rf"{lead}{_HIGH}(?!{_LOW})", f"$1{_LONE_ESCAPE}"),
        rf"{lead}(?<!{_HIGH}){_LOW}", f"$1{_LONE_ESCAPE}")
    text = F.when(text.rlike(r"\\u[dD][89a-fA-F]"), whole).otherwise(text)
    # Strings are matched whole and kept, so only bare literals are marked.
    marked = F.regexp_replace(text, r'("(?:[^"\\]++|\\.)*+")|NaN|Infinity', f"$1{_MARK}")
    numbers = F.replace(F.replace(marked, F.lit(f'"{_MARK}'), F.lit('"')), F.lit(_MARK), F.lit("1e999"))
    bare = text.rlike("NaN|Infinity") & ~text.rlike(f"{_MARK}|-NaN")
    return F.when(bare, numbers).otherwise(text)


def json_value(text: Column) -> Column:
    """VARIANT holding the single JSON value of ``text``; NULL if invalid."""
    wrapped = F.try_parse_json(F.concat(F.lit("["), text, F.lit("]")))
    first = F.variant_get(wrapped, "$[0]", "variant")
    only_one = F.variant_get(wrapped, "$[1]", "variant").isNull()
    # A ']' inside the text could end the wrapping array early; the object
    # wrapper turns such text into a syntax error instead.
    strict = (F.instr(text, "]") == 0) | F.try_parse_json(
        F.concat(F.lit('{"r":'), text, F.lit("}"))).isNotNull()
    return F.when(only_one & strict, first)


def python_type_name(text: Column) -> Column:
    """Python type name of a valid JSON text (dict, list, str, ...)."""
    first = F.regexp_extract(text, r"^[ \t\r\n]*(.)", 1)
    return (
        F.when(first == "{", F.lit("dict"))
        .when(first == "[", F.lit("list"))
        .when(first == '"', F.lit("str"))
        .when(first.isin("t", "f"), F.lit("bool"))
        .when(first == "n", F.lit("NoneType"))
        .when(text.rlike("[.eE]"), F.lit("float"))
        .otherwise(F.lit("int"))
    )


def decode(df: DataFrame, data: str = "data") -> DataFrame:
    """Add ``_payload`` (VARIANT object), ``_decode_kind`` and
    ``_decode_reason`` (NULL when the row decoded to an object)."""
    text = F.col(data).cast("string")
    staged = df.withColumn("_text", text).withColumn(
        "_utf8_ok", F.is_valid_utf8(F.col("_text"))
    )
    staged = staged.withColumn("_text", F.when(F.col("_utf8_ok"), parseable(F.col("_text"))))
    staged = staged.withColumn(
        "_value", F.when(F.col("_utf8_ok"), json_value(F.col("_text")))
    )
    type_name = python_type_name(F.col("_text"))
    kind = (
        F.when(~F.col("_utf8_ok"), F.lit(KIND_UTF8))
        .when(F.col("_value").isNull(), F.lit(KIND_JSON))
        .when(type_name != "dict", F.lit(KIND_NOT_DICT))
        .otherwise(F.lit(KIND_OK))
    )
    staged = staged.withColumn("_decode_kind", kind)
    reason = (
        F.when(F.col("_decode_kind") == KIND_UTF8,
               F.lit(f"{S.DECODE_UTF8}:{S.UTF8_FIXED_MESSAGE}"))
        .when(F.col("_decode_kind") == KIND_JSON,
              F.lit(f"{S.DECODE_JSON}:{S.JSON_FIXED_MESSAGE}"))
        .when(F.col("_decode_kind") == KIND_NOT_DICT,
              F.concat(F.lit(f"{S.DECODE_NOT_DICT}:"), type_name))
    )
    return (
        staged.withColumn("_decode_reason", reason)
        .withColumn("_payload",
                    F.when(F.col("_decode_kind") == KIND_OK, F.col("_value")))
        # the text copy is only needed here; later stages read ``_payload``
        .drop("_utf8_ok", "_value", "_text")
    )


def split(df: DataFrame, data: str = "data") -> tuple[DataFrame, DataFrame]:
    """(decoded, errors) of raw records: every record is in one of them.

    The observed count is a boundary the optimizer does not push filters
    through; below it a filter on the outcome would copy the whole parse
    into the filter's condition.
    """
    parsed = decode(df, data).observe(f"decoded-{uuid.uuid4().hex}", F.count(F.lit(1)).alias("records"))
    failed = F.col("_decode_kind") != KIND_OK
    return parsed.filter(~failed), parsed.filter(failed)


def raw_b64(data: Column) -> Column:
    """Base64 of the exact bytes on one line (Spark's encoder wraps lines)."""
    return F.regexp_replace(F.base64(data), r"[\r\n]", "")


def _python_decode_message(raw: bytes | None) -> str | None:
    """The reason code Python's decoder gives for ``raw`` (None if it decodes)."""
    import json

    if raw is None:
        return None
    raw = bytes(raw)
    try:
        text = raw.decode("utf-8")
    except UnicodeDecodeError as exc:
        return f"{S.DECODE_UTF8}:{exc.reason}"
    try:
        value = json.loads(text)
    except json.JSONDecodeError as exc:
        return f"{S.DECODE_JSON}:{exc.msg}"
    except RecursionError:
        return f"{S.DECODE_JSON}:maximum recursion depth exceeded"
    if not isinstance(value, dict):
        return f"{S.DECODE_NOT_DICT}:{type(value).__name__}"
    return None


def exact_decode_reason(raw: Column) -> Column:
    """Arrow-batched UDF giving the parser's own message for a decode failure.

    Apply it only to rows already known to have failed decoding (for
    example Quarantine rows with ``_raw_b64``): it runs Python per row.
    """
    @F.pandas_udf("string")
    def reason(values: pd.Series) -> pd.Series:
        return values.map(_python_decode_message)

    return reason(raw)


def with_exact_decode_messages(quarantine: DataFrame) -> DataFrame:
    """Quarantine rows with the fixed decode text replaced by the parser's
    message (decode failures only; validation reasons are unchanged)."""
    raw = F.when(F.col("_raw_b64").isNotNull(), F.unbase64(F.col("_raw_b64")))
    exact = exact_decode_reason(raw)
    return quarantine.withColumn(
        "_quarantine_reason",
        F.when(F.col("_raw_b64").isNotNull(),
               F.array(F.coalesce(exact, F.get("_quarantine_reason", 0))))
        .otherwise(F.col("_quarantine_reason")))

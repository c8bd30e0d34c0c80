"""DuckDB reference SQL for the registered queries.

The SQL decodes and validates the fixture records on its own (DuckDB
JSON functions and regular expressions), independently of the Spark
column expressions, and is used by the correctness check only.

DuckDB evaluates both sides of AND, and its JSON functions raise on
invalid text, so JSON access is guarded by ``CASE`` on ``json_valid``.
"""

from __future__ import annotations

# Accepted input shapes, written for DuckDB's engine and kept apart from the
# rules under test.
UUID_PATTERN = (r"\A(?:[[:xdigit:]]{32}|(?:urn:uuid:)?[[:xdigit:]]{8}(?:-[[:xdigit:]]{4}){3}-[[:xdigit:]]{12}"
                r"|\{[[:xdigit:]]{8}(?:-[[:xdigit:]]{4}){3}-[[:xdigit:]]{12}\})\z")
FLOAT_TEXT_PATTERN = (r"(?i)\A[\s\x{85}\p{Z}]*[-+]?(?:inf|infinity|nan"
                      r"|(?:[0-9]+(?:_[0-9]+)*\.?|(?:[0-9]+(?:_[0-9]+)*)?\.[0-9]+(?:_[0-9]+)*)"
                      r"(?:e[-+]?[0-9]+(?:_[0-9]+)*)?)[\s\x{85}\p{Z}]*\z")
ISO_TS_PATTERN = (r"\A([0-9]{4})-([0-9]{2})-([0-9]{2})(?:[Tt _]([0-9]{2}):([0-9]{2})"
                  r"(?::([0-9]{2})(?:[.,]([0-9]+))?)?(?:([Zz])|([-+\x{2212}])([0-9]{2}):?([0-9]{2}))?)?\z")
EPOCH_TEXT_PATTERN = r"\A[-+]?[0-9]+(?:\.[0-9]+)?\z"

# FIXTURES.md section 3: raw records from `events`, 100 per batch.
FIXTURE_CTE = r"""
b AS (
  SELECT event_id, user_id, value, ts, CAST(floor(event_id / 100) AS BIGINT) AS batch_id FROM events
), f AS (
  SELECT *, CASE WHEN batch_id % 4 = 0 THEN 1 WHEN batch_id % 10 = 3 THEN 31 ELSE event_id END AS k FROM b
), n AS (
  SELECT batch_id, date_trunc('second', max(ts)) AS batch_now FROM b GROUP BY batch_id
), t AS (
  SELECT b.event_id, b.batch_id, b.k, n.batch_now,
    md5(concat('txn-', CAST(b.event_id AS STRING))) AS h,
    lpad(CAST(b.user_id AS STRING), 16, '0') AS card_id,
    concat('MERCH-', upper(substr(md5(concat('m-', CAST(b.event_id % 200 AS STRING))), 1, 8))) AS merchant_id,
    CASE WHEN b.k % 17 = 0 THEN b.value + 50000
         WHEN b.k % 19 = 0 THEN -b.value ELSE b.value END AS amount,
    CASE WHEN b.k % 23 = 0 THEN 'ZZZ' WHEN b.event_id % 10 < 7 THEN 'USD'
         WHEN b.event_id % 10 = 7 THEN 'EUR' ELSE 'JPY' END AS currency,
    replace(CAST(n.batch_now - INTERVAL 1 SECOND * ((b.k * 37) % 4000) AS STRING), ' ', 'T') AS ts_text,
    CASE WHEN b.k % 43 = 0 THEN '123' ELSE '5411' END AS mcc_code
  FROM f b JOIN n ON b.batch_id = n.batch_id
), p AS (
  SELECT event_id, batch_id, k, batch_now,
    CASE WHEN k % 31 = 0 THEN 'this is not json'
         WHEN k % 37 = 0 THEN '[1, 2]'
         ELSE concat('{"transaction_id":"', substr(h,1,8),'-',substr(h,9,4),'-',substr(h,13,4),'-',substr(h,17,4),'-',substr(h,21,12), '"',
           CASE WHEN k % 29 = 0 THEN '' ELSE concat(',"card_id":"', card_id, '"') END,
           ',"merchant_id":', CASE WHEN k % 53 = 0 THEN 'null' ELSE concat('"', merchant_id, '"') END,
           ',"amount":', CASE WHEN k % 59 = 0 THEN '"12.5"' ELSE CAST(amount AS STRING) END,
           ',"currency":"', currency,
           '","transaction_ts":"', ts_text, CASE WHEN k % 47 = 0 THEN '' ELSE 'Z' END,
           '","mcc_code":"', mcc_code,
           '","auth_status":"APPROVED","channel":"POS"',
           CASE WHEN k % 71 = 0 THEN ',"note":"extra"' ELSE '' END,
           '}', CASE WHEN k % 61 = 0 THEN ' x' ELSE '' END)
    END AS payload_text
  FROM t
), raw AS (
  SELECT event_id, batch_id, batch_now, concat('shard-', CAST(event_id % 4 AS STRING)) AS shard_id,
    CASE WHEN k % 41 = 0 THEN unhex('FFFEFF') ELSE CAST(payload_text AS BINARY) END AS data
  FROM p
)"""


def _sql_str(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


_FIELDS = ("transaction_id", "card_id", "merchant_id", "amount", "currency",
           "transaction_ts", "mcc_code", "auth_status", "channel")
_NUM_TYPES = "('BIGINT','UBIGINT','HUGEINT','DOUBLE')"


def _field_cols() -> str:
    cols = []
    for f in _FIELDS:
        cols.append(f"CASE WHEN decode_kind = 'ok' THEN json_extract(j, '$.{f}') END AS f_{f}")
        cols.append(f"CASE WHEN decode_kind = 'ok' THEN json_type(j, '$.{f}') END AS t_{f}")
        cols.append(f"CASE WHEN decode_kind = 'ok' AND json_type(j, '$.{f}') = 'VARCHAR' "
                    f"THEN json_extract_string(j, '$.{f}') END AS s_{f}")
    return ",\n    ".join(cols)


def _enum(f: str, values: tuple[str, ...]) -> str:
    vals = ", ".join(_sql_str(v) for v in values)
    return (f"CASE WHEN f_{f} IS NULL THEN 'MISSING_FIELD:{f}' "
            f"WHEN t_{f} = 'VARCHAR' AND s_{f} IN ({vals}) THEN NULL "
            f"ELSE 'INVALID_FIELD:{f}:enum' END")


def _text(f: str, lo: int, hi: int | None) -> str:
    hi_sql = (f"WHEN length(s_{f}) > {hi} THEN 'INVALID_FIELD:{f}:string_too_long' "
              if hi is not None else "")
    return (f"CASE WHEN f_{f} IS NULL THEN 'MISSING_FIELD:{f}' "
            f"WHEN t_{f} <> 'VARCHAR' THEN 'INVALID_FIELD:{f}:string_type' "
            f"WHEN length(s_{f}) < {lo} THEN 'INVALID_FIELD:{f}:string_too_short' "
            f"{hi_sql}END")


PIPELINE_CTE = FIXTURE_CTE + rf""",
d AS (
  SELECT *, TRY(decode(data)) AS txt FROM raw
), k0 AS (
  SELECT *, CASE WHEN txt IS NOT NULL AND json_valid(txt) THEN txt END AS j FROM d
), k1 AS (
  SELECT *,
    CASE WHEN txt IS NULL THEN 'utf8'
         WHEN j IS NULL THEN 'json'
         WHEN json_type(j) <> 'OBJECT' THEN 'not_dict'
         ELSE 'ok' END AS decode_kind,
    CASE json_type(j) WHEN 'OBJECT' THEN 'dict' WHEN 'ARRAY' THEN 'list' WHEN 'VARCHAR' THEN 'str'
         WHEN 'BOOLEAN' THEN 'bool' WHEN 'NULL' THEN 'NoneType' WHEN 'DOUBLE' THEN 'float'
         ELSE 'int' END AS py_type
  FROM k0
), k2 AS (
  SELECT *,
    {_field_cols()}
  FROM k1
), k3 AS (
  SELECT *,
    CASE WHEN t_amount IN {_NUM_TYPES} THEN CAST(f_amount AS DOUBLE)
         WHEN t_amount = 'BOOLEAN' THEN CASE WHEN CAST(f_amount AS VARCHAR) = 'true' THEN 1.0 ELSE 0.0 END
         WHEN t_amount = 'VARCHAR' AND regexp_matches(s_amount, {_sql_str(FLOAT_TEXT_PATTERN)})
           THEN TRY_CAST(replace(trim(s_amount), '_', '') AS DOUBLE) END AS n_amount,
    regexp_matches(s_transaction_ts, {_sql_str(ISO_TS_PATTERN)}) AS ts_iso,
    regexp_extract(s_transaction_ts, {_sql_str(ISO_TS_PATTERN)},
      ['y','mo','d','h','mi','s','fr','z','sg','oh','om']) AS ts_g,
    CASE WHEN t_transaction_ts IN {_NUM_TYPES} THEN CAST(f_transaction_ts AS DOUBLE)
         WHEN t_transaction_ts = 'VARCHAR' AND regexp_matches(s_transaction_ts, {_sql_str(EPOCH_TEXT_PATTERN)})
           THEN TRY_CAST(s_transaction_ts AS DOUBLE) END AS ts_epoch
  FROM k2
), k4 AS (
  SELECT *,
    CASE WHEN ts_iso AND ts_g.y <> '0000'
          AND coalesce(TRY_CAST(nullif(ts_g.h, '') AS INTEGER), 0) < 24
          AND coalesce(TRY_CAST(nullif(ts_g.mi, '') AS INTEGER), 0) < 60
          AND coalesce(TRY_CAST(nullif(ts_g.s, '') AS INTEGER), 0) < 60
          AND (ts_g.sg = '' OR (TRY_CAST(ts_g.oh AS INTEGER) < 24 AND TRY_CAST(ts_g.om AS INTEGER) < 60))
         THEN TRY(make_timestamp(
            CAST(ts_g.y AS BIGINT), CAST(ts_g.mo AS BIGINT), CAST(ts_g.d AS BIGINT),
            coalesce(TRY_CAST(nullif(ts_g.h, '') AS BIGINT), 0),
            coalesce(TRY_CAST(nullif(ts_g.mi, '') AS BIGINT), 0),
            CAST(coalesce(TRY_CAST(nullif(ts_g.s, '') AS BIGINT), 0) AS DOUBLE)
              + CAST(rpad(substr(ts_g.fr, 1, 6), 6, '0') AS BIGINT) / 1000000.0))
            - INTERVAL 1 SECOND * (CASE WHEN ts_g.sg = '-' THEN -1 ELSE 1 END)
              * (CASE WHEN ts_g.sg = '' THEN 0
                      ELSE TRY_CAST(ts_g.oh AS BIGINT) * 3600 + TRY_CAST(ts_g.om AS BIGINT) * 60 END)
    END AS ts_from_iso,
    CASE WHEN abs(ts_epoch) > 2e10 THEN ts_epoch / 1000 ELSE ts_epoch END AS ts_seconds
  FROM k3
), k5 AS (
  SELECT *,
    CASE WHEN ts_iso THEN ts_from_iso
         WHEN ts_seconds BETWEEN -62135596800 AND 253402300799
           THEN make_timestamp(CAST(round(ts_seconds * 1000000) AS BIGINT)) END AS ts_value,
    coalesce(ts_iso AND ts_g.z = '' AND ts_g.sg = '', false) AS ts_naive
  FROM k4
), v AS (
  SELECT *,
    list_filter([
      CASE WHEN f_transaction_id IS NULL THEN 'MISSING_FIELD:transaction_id'
           WHEN t_transaction_id <> 'VARCHAR' THEN 'INVALID_FIELD:transaction_id:uuid_type'
           WHEN NOT regexp_matches(s_transaction_id, {_sql_str(UUID_PATTERN)})
             THEN 'INVALID_FIELD:transaction_id:uuid_parsing' END,
      {_text('card_id', 1, None)},
      {_text('merchant_id', 1, None)},
      CASE WHEN f_amount IS NULL THEN 'MISSING_FIELD:amount'
           WHEN t_amount NOT IN {_NUM_TYPES} AND t_amount NOT IN ('BOOLEAN', 'VARCHAR')
             THEN 'INVALID_FIELD:amount:float_type'
           WHEN n_amount IS NULL THEN 'INVALID_FIELD:amount:float_parsing'
           WHEN NOT (n_amount <= 50000) OR isnan(n_amount) THEN 'INVALID_FIELD:amount:less_than_equal'
           WHEN NOT (n_amount >= 0) THEN 'INVALID_FIELD:amount:greater_than_equal' END,
      {_enum('currency', ('USD', 'EUR', 'GBP', 'CNY', 'JPY', 'CAD'))},
      CASE WHEN f_transaction_ts IS NULL THEN 'MISSING_FIELD:transaction_ts'
           WHEN t_transaction_ts NOT IN {_NUM_TYPES} AND t_transaction_ts <> 'VARCHAR'
             THEN 'INVALID_FIELD:transaction_ts:datetime_type'
           WHEN ts_value IS NOT NULL THEN NULL
           WHEN ts_epoch IS NOT NULL THEN 'INVALID_FIELD:transaction_ts:datetime_parsing'
           ELSE 'INVALID_FIELD:transaction_ts:datetime_from_date_parsing' END,
      {_text('mcc_code', 4, 4)},
      {_enum('auth_status', ('APPROVED', 'DECLINED', 'PENDING'))},
      {_enum('channel', ('POS', 'ECOM', 'ATM', 'PHONE', 'RECURRING'))}
    ], lambda x: x IS NOT NULL) AS schema_reasons
  FROM k5
), c AS (
  SELECT *,
    CASE WHEN decode_kind = 'utf8' THEN ['DECODE_ERROR:utf8:invalid utf-8']
         WHEN decode_kind = 'json' THEN ['DECODE_ERROR:json:invalid json']
         WHEN decode_kind = 'not_dict' THEN ['DECODE_ERROR:not_dict:' || py_type]
         WHEN len(schema_reasons) > 0 THEN schema_reasons
         WHEN ts_naive THEN ['INVALID_FIELD:transaction_ts:timezone_missing']
         WHEN abs(epoch_us(batch_now) - epoch_us(ts_value)) > CAST(3600 AS BIGINT) * 1000000 THEN ['TIMESTAMP_DRIFT']
         ELSE [] END AS reasons,
    strftime(batch_now, '%Y-%m-%dT%H:%M:%S') || '+00:00___batch-' || CAST(batch_id AS VARCHAR) AS run_id,
    strftime(batch_now, '%Y-%m-%dT%H:%M:%S') || '+00:00' AS quarantine_ts
  FROM v
), classified AS (
  SELECT *, len(reasons) = 0 AS is_valid,
    CASE WHEN decode_kind = 'ok' THEN
      lower(substr(replace(replace(replace(replace(s_transaction_id, 'urn:uuid:', ''), '{{', ''), '}}', ''), '-', ''), 1, 8))
      || '-' || lower(substr(replace(replace(replace(replace(s_transaction_id, 'urn:uuid:', ''), '{{', ''), '}}', ''), '-', ''), 9, 4))
      || '-' || lower(substr(replace(replace(replace(replace(s_transaction_id, 'urn:uuid:', ''), '{{', ''), '}}', ''), '-', ''), 13, 4))
      || '-' || lower(substr(replace(replace(replace(replace(s_transaction_id, 'urn:uuid:', ''), '{{', ''), '}}', ''), '-', ''), 17, 4))
      || '-' || lower(substr(replace(replace(replace(replace(s_transaction_id, 'urn:uuid:', ''), '{{', ''), '}}', ''), '-', ''), 21, 12))
    END AS txn_id,
    strftime(ts_value, '%Y-%m-%dT%H:%M:%S')
      || CASE WHEN microsecond(ts_value) % 1000000 = 0 THEN ''
              ELSE '.' || lpad(CAST(microsecond(ts_value) % 1000000 AS VARCHAR), 6, '0') END
      || 'Z' AS ts_text
  FROM c
)"""


def with_pipeline(select_sql: str) -> str:
    return "WITH " + PIPELINE_CTE + "\n" + select_sql


_BRONZE_COLS = ("txn_id AS transaction_id, s_card_id AS card_id, s_merchant_id AS merchant_id, "
                "n_amount AS amount, s_currency AS currency, ts_text AS transaction_ts, "
                "s_mcc_code AS mcc_code, s_auth_status AS auth_status, s_channel AS channel")

_QUARANTINE_FIELDS = ", ".join(
    f"CASE WHEN decode_kind = 'ok' THEN "
    f"CASE WHEN t_{f} = 'NULL' THEN NULL WHEN t_{f} = 'VARCHAR' THEN s_{f} "
    f"ELSE CAST(f_{f} AS VARCHAR) END END AS {f}"
    for f in _FIELDS)

ORACLE_SQL: dict[str, str] = {
    "batch_run_summary": with_pipeline("""
SELECT batch_id, run_id, strftime(batch_now, '%Y-%m-%dT%H:%M:%S') || '+00:00' AS start_ts,
  count(*) AS total, count(*) FILTER (WHERE is_valid) AS valid, count(*) - count(*) FILTER (WHERE is_valid) AS quarantined,
  CASE WHEN count(*) - count(*) FILTER (WHERE is_valid) = 0 THEN 'SUCCESS' ELSE 'PARTIAL' END AS run_status,
  strftime(batch_now, 'year=%Y/month=%m/day=%d') AS partition_path
FROM classified GROUP BY batch_id, run_id, batch_now"""),
    "decode_outcome_counts": with_pipeline("""
SELECT CASE decode_kind WHEN 'ok' THEN 'ok' WHEN 'utf8' THEN 'DECODE_ERROR:utf8'
         WHEN 'json' THEN 'DECODE_ERROR:json' ELSE 'DECODE_ERROR:not_dict:' || py_type END AS decode_outcome,
  count(*) AS records
FROM k1 GROUP BY 1"""),
    "decode_errors_b64": with_pipeline("""
SELECT event_id, batch_id, base64(data) AS _raw_b64, array_to_string(reasons, '|') AS reasons,
  quarantine_ts AS _quarantine_ts
FROM classified WHERE decode_kind <> 'ok'"""),
    "field_reasons": with_pipeline("""
SELECT reason, count(*) AS records FROM (SELECT unnest(reasons) AS reason FROM classified) GROUP BY reason"""),
    "drift_flagged": with_pipeline("""
SELECT event_id, batch_id, ts_text AS transaction_ts,
  strftime(batch_now, '%Y-%m-%dT%H:%M:%S') || '+00:00' AS reference_now,
  epoch_us(batch_now) - epoch_us(ts_value) AS drift_us
FROM classified WHERE list_contains(reasons, 'TIMESTAMP_DRIFT')"""),
    "bronze_rows": with_pipeline(f"""
SELECT event_id, batch_id, run_id, {_BRONZE_COLS} FROM classified WHERE is_valid"""),
    "quarantine_rows": with_pipeline(f"""
SELECT event_id, batch_id, run_id,
  CASE WHEN decode_kind <> 'ok' THEN base64(data) END AS _raw_b64,
  CASE WHEN decode_kind = 'ok' THEN txt END AS payload_json,
  {_QUARANTINE_FIELDS},
  array_to_string(reasons, '|') AS reasons, quarantine_ts AS _quarantine_ts
FROM classified WHERE NOT is_valid"""),
    "partition_paths": with_pipeline("""
SELECT DISTINCT batch_id, strftime(batch_now, 'year=%Y/month=%m/day=%d') AS partition_path,
  strftime(batch_now, 'year=%Y/month=%m/day=%d') || '/' || run_id || '.ndjson' AS object_key
FROM c"""),
}

_RUNS = """
runs AS (
  SELECT 'txn-realtime-ingestion' AS pipeline_name, run_id,
    CASE WHEN count(*) - count(*) FILTER (WHERE is_valid) = 0 THEN 'SUCCESS' ELSE 'PARTIAL' END AS run_status,
    strftime(batch_now, '%Y-%m-%dT%H:%M:%S') || '+00:00' AS start_ts,
    count(*) AS total_records, count(*) FILTER (WHERE is_valid) AS valid_records,
    count(*) - count(*) FILTER (WHERE is_valid) AS quarantine_records,
    CASE WHEN count(*) FILTER (WHERE is_valid) > 0 THEN strftime(batch_now, 'year=%Y/month=%m/day=%d') ELSE '' END AS bronze_partition,
    CASE WHEN count(*) - count(*) FILTER (WHERE is_valid) > 0 THEN strftime(batch_now, 'year=%Y/month=%m/day=%d') ELSE '' END AS quarantine_partition
  FROM classified GROUP BY run_id, batch_now
)"""

_DAY = ("strftime(batch_now, '%Y') AS year, strftime(batch_now, '%m') AS month, "
        "strftime(batch_now, '%d') AS day")

ORACLE_SQL.update({
    "bronze_roundtrip": with_pipeline(f"""
SELECT run_id, {_BRONZE_COLS}, {_DAY} FROM classified WHERE is_valid"""),
    "quarantine_roundtrip": with_pipeline(f"""
SELECT run_id, CASE WHEN decode_kind <> 'ok' THEN base64(data) END AS _raw_b64,
  {_QUARANTINE_FIELDS},
  CASE WHEN decode_kind = 'utf8' THEN 'DECODE_ERROR:utf8:invalid start byte'
       WHEN decode_kind = 'json' AND txt LIKE '{{%' THEN 'DECODE_ERROR:json:Extra data'
       WHEN decode_kind = 'json' THEN 'DECODE_ERROR:json:Expecting value'
       ELSE array_to_string(reasons, '|') END AS reasons, quarantine_ts AS _quarantine_ts, {_DAY}
FROM classified WHERE NOT is_valid"""),
    "metadata_latest": with_pipeline("," + _RUNS + "\nSELECT * FROM runs").replace(")\n,\nruns", "),\nruns"),
    "metadata_get": with_pipeline("," + _RUNS + """
SELECT * FROM runs WHERE run_id = (SELECT arg_min(run_id, batch_id) FROM classified)""").replace(")\n,\nruns", "),\nruns"),
    "metadata_last_n": with_pipeline("," + _RUNS + """
SELECT * FROM runs ORDER BY run_id DESC LIMIT 5""").replace(")\n,\nruns", "),\nruns"),
    "metadata_by_status": with_pipeline("," + _RUNS + """
SELECT * FROM runs WHERE run_status = 'SUCCESS' AND start_ts >= '2024-01-15T00:00:00+00:00'
ORDER BY start_ts, run_id""").replace(")\n,\nruns", "),\nruns"),
})

ORACLE_SQL.update({
    "shard_audit": with_pipeline("""
SELECT shard_id, count(*) AS records, min(event_id) AS first_sequence, max(event_id) AS last_sequence
FROM raw GROUP BY ROLLUP (shard_id)"""),
    "stream_ingest": with_pipeline(f"""
SELECT {_BRONZE_COLS} FROM classified WHERE is_valid"""),
})

_RECORD_JSON = """'{"transaction_id":"' || txn_id || '","card_id":"' || s_card_id
  || '","merchant_id":"' || s_merchant_id || '","amount":' || CAST(n_amount AS VARCHAR)
  || ',"currency":"' || s_currency || '","transaction_ts":"' || ts_text
  || '","mcc_code":"' || s_mcc_code || '","auth_status":"' || s_auth_status
  || '","channel":"' || s_channel || '"}'"""

_VALID_ORDERED = """,
valid AS (
  SELECT *, row_number() OVER (ORDER BY event_id) - 1 AS row_index FROM classified WHERE is_valid
)"""

ORACLE_SQL.update({
    "producer_records": with_pipeline(f"""
SELECT event_id, s_card_id AS partition_key, {_RECORD_JSON} AS record FROM classified WHERE is_valid"""),
    "producer_batches": with_pipeline("," + _VALID_ORDERED.lstrip(",") + """
SELECT CAST(floor(row_index / 500) AS BIGINT) AS batch_no, count(*) AS records FROM valid GROUP BY 1"""),
    "send_result": with_pipeline("""
SELECT count(*) AS total, count(*) FILTER (WHERE NOT s_card_id LIKE '%7') AS success_count,
  count(*) FILTER (WHERE s_card_id LIKE '%7') AS failed_count FROM classified WHERE is_valid"""),
    "send_failures": with_pipeline("," + _VALID_ORDERED.lstrip(",") + f"""
SELECT 'ProvisionedThroughputExceededException' AS ErrorCode, 'Rate exceeded for shard' AS ErrorMessage,
  {_RECORD_JSON} AS record FROM valid WHERE s_card_id LIKE '%7'"""),
    "send_order": with_pipeline("""
SELECT count(*) AS total, CAST(0 AS BIGINT) AS out_of_order FROM classified WHERE is_valid"""),
    "record_preview": with_pipeline("," + _VALID_ORDERED.lstrip(",") + """
SELECT row_index + 1 AS line_no,
  printf('[%04d] %s $%9.2f %s %-9s %-10s card=%s… mcc=%s', row_index + 1, txn_id, n_amount,
         s_currency, s_auth_status, s_channel, substr(s_card_id, 1, 8), s_mcc_code) AS line
FROM valid"""),
})


def _u(salt: str) -> str:
    return (f"CAST(('0x' || substr(md5('42|{salt}|' || CAST(event_id AS VARCHAR) || ':0'), 1, 13)) "
            f"AS BIGINT) / 4503599627370496.0")


def _pick(u: str, items: tuple[str, ...], weights: tuple[float, ...]) -> str:
    total = float(sum(weights))
    parts, cum = [], 0.0
    for item, w in zip(items[:-1], weights[:-1]):
        cum += w
        parts.append(f"WHEN {u} * {total!r} < {cum!r} THEN '{item}'")
    return "CASE " + " ".join(parts) + f" ELSE '{items[-1]}' END"


_GEN = f"""
WITH g AS (
  SELECT event_id,
    CAST(floor({_u('card-pick')} * 1000) AS BIGINT) AS card_slot,
    CAST(floor({_u('merchant-pick')} * 200) AS BIGINT) AS merchant_slot,
    round(least(greatest(exp(3.5 + 1.0 * sqrt(-2.0 * ln(1.0 - {_u('amount-1')}))
        * cos(2 * pi() * {_u('amount-2')})), 0.01), 50000.0), 2) AS amount,
    {_pick(_u('currency'), ('USD', 'EUR', 'GBP', 'CNY', 'JPY', 'CAD'), (80.0, 8.0, 5.0, 4.0, 2.0, 1.0))} AS currency,
    {_pick(_u('auth'), ('APPROVED', 'DECLINED', 'PENDING'), (95.0, 4.0, 1.0))} AS auth_status,
    {_pick(_u('channel'), ('POS', 'ECOM', 'ATM', 'PHONE', 'RECURRING'), (40.0, 50.0, 5.0, 3.0, 2.0))} AS channel
  FROM events
), named AS (
  SELECT *,
    lpad(CAST(CAST(('0x' || substr(md5('42|card|' || CAST(card_slot AS VARCHAR)), 1, 14)) AS BIGINT)
      % 10000000000000000 AS VARCHAR), 16, '0') AS card_id,
    'MERCH-' || upper(substr(md5('42|merchant|' || CAST(merchant_slot AS VARCHAR)), 1, 8)) AS merchant_id
  FROM g
)"""

ORACLE_SQL["generated_profile"] = _GEN + """
SELECT currency, auth_status, channel, count(*) AS records, count(*) FILTER (WHERE amount >= 100) AS records_100_plus,
  count(DISTINCT card_id) AS cards, count(DISTINCT merchant_id) AS merchants
FROM named GROUP BY currency, auth_status, channel"""

_SILVER = """,
silver AS (
  SELECT txn_id AS transaction_id, run_id, s_card_id AS card_id, s_merchant_id AS merchant_id,
    n_amount AS amount, s_currency AS currency, ts_text AS transaction_ts, ts_text, s_mcc_code AS mcc_code,
    s_auth_status AS auth_status, s_channel AS channel, ts_value, CAST(2 AS BIGINT) AS copies
  FROM classified WHERE is_valid
)"""

ORACLE_SQL.update({
    "silver_dedup": with_pipeline(_SILVER + """
SELECT transaction_id, run_id, card_id, merchant_id, amount, currency, transaction_ts, mcc_code,
  auth_status, channel, copies FROM silver"""),
    "gold_daily": with_pipeline(_SILVER + """
SELECT strftime(ts_value, '%Y-%m-%d') AS event_date, currency, channel, auth_status,
  count(*) AS transactions, CAST(sum(CAST(amount AS DECIMAL(18,2))) AS DECIMAL(38,2)) AS total_amount,
  min(CAST(amount AS DECIMAL(18,2))) AS min_amount, max(CAST(amount AS DECIMAL(18,2))) AS max_amount
FROM silver GROUP BY 1, 2, 3, 4"""),
    "card_rollup": with_pipeline(_SILVER + """
SELECT card_id, count(*) AS transactions, CAST(sum(CAST(amount AS DECIMAL(18,2))) AS DECIMAL(38,2)) AS total_amount,
  arg_min(ts_text, ts_value) AS first_ts, arg_max(ts_text, ts_value) AS last_ts,
  count(DISTINCT merchant_id) AS merchants
FROM silver GROUP BY card_id"""),
    "warnings_tagged": with_pipeline("""
SELECT event_id, true AS is_valid, 'TIMESTAMP_DRIFT' AS _quality_warnings FROM classified
WHERE list_contains(reasons, 'TIMESTAMP_DRIFT')"""),
    "bronze_day_counts": with_pipeline("""
SELECT strftime(batch_now, '%Y') AS year, strftime(batch_now, '%m') AS month,
  strftime(batch_now, '%d') AS day, count(*) AS records
FROM classified WHERE is_valid AND strftime(batch_now, '%Y-%m-%d') BETWEEN '2024-01-10' AND '2024-01-20'
GROUP BY 1, 2, 3"""),
})

ORACLE_SQL["dead_letter"] = with_pipeline("""
SELECT event_id, txn_id AS transaction_id, 'downstream rejected record' AS error_message
FROM classified WHERE is_valid AND txn_id LIKE '00%'""")

ORACLE_SQL.update({
    "landing_decode_counts": ORACLE_SQL["decode_outcome_counts"],
    "manifest_check": with_pipeline("""
SELECT shard_id, 'OK' AS status, count(*) AS expected_rows, count(*) AS actual_rows
FROM raw GROUP BY shard_id"""),
})

ORACLE_SQL["card_sequence"] = with_pipeline(_SILVER + """,
seq AS (
  SELECT card_id, transaction_id, ts_value, transaction_ts,
    row_number() OVER w AS seq_no,
    lag(ts_value) OVER w AS prev_value,
    sum(CAST(amount AS DECIMAL(18,2))) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS running
  FROM silver
  WINDOW w AS (PARTITION BY card_id ORDER BY ts_value, transaction_id)
)
SELECT card_id, transaction_id, transaction_ts, seq_no,
  CASE WHEN prev_value IS NULL THEN NULL ELSE
    strftime(prev_value, '%Y-%m-%dT%H:%M:%S')
    || CASE WHEN microsecond(prev_value) % 1000000 = 0 THEN ''
            ELSE '.' || lpad(CAST(microsecond(prev_value) % 1000000 AS VARCHAR), 6, '0') END
    || 'Z' END AS prev_ts,
  epoch_us(ts_value) - epoch_us(prev_value) AS gap_us,
  CAST(running AS DECIMAL(38,2)) AS running_amount
FROM seq""")

# Expected outcome of every template of `sources.faults`, in its order; an
# empty text is a valid record.
_EXPECTED = (
    "", "INVALID_FIELD:transaction_id:uuid_parsing", "INVALID_FIELD:transaction_id:uuid_parsing",
    "INVALID_FIELD:transaction_id:uuid_type", "MISSING_FIELD:transaction_id", "", "",
    "INVALID_FIELD:card_id:string_too_short", "INVALID_FIELD:card_id:string_type",
    "INVALID_FIELD:card_id:string_unicode", "", "INVALID_FIELD:merchant_id:string_type",
    "INVALID_FIELD:merchant_id:string_unicode", "INVALID_FIELD:amount:float_parsing",
    "INVALID_FIELD:amount:float_type", "INVALID_FIELD:amount:less_than_equal",
    "INVALID_FIELD:amount:greater_than_equal", "INVALID_FIELD:amount:less_than_equal", "", "", "",
    "INVALID_FIELD:amount:greater_than_equal", "INVALID_FIELD:currency:enum",
    "INVALID_FIELD:transaction_ts:datetime_from_date_parsing",
    "INVALID_FIELD:transaction_ts:datetime_from_date_parsing", "", "", "",
    "INVALID_FIELD:transaction_ts:datetime_parsing", "INVALID_FIELD:transaction_ts:timezone_missing",
    "TIMESTAMP_DRIFT", "INVALID_FIELD:transaction_ts:datetime_type", "INVALID_FIELD:transaction_ts:datetime_parsing",
    "INVALID_FIELD:mcc_code:string_too_short", "INVALID_FIELD:mcc_code:string_too_long",
    "INVALID_FIELD:mcc_code:string_type", "INVALID_FIELD:auth_status:enum", "INVALID_FIELD:channel:enum", "", "",
    "MISSING_FIELD:transaction_id|INVALID_FIELD:currency:enum|MISSING_FIELD:channel",
    "DECODE_ERROR:not_dict:int", "DECODE_ERROR:not_dict:float", "DECODE_ERROR:not_dict:str",
    "DECODE_ERROR:not_dict:bool", "DECODE_ERROR:not_dict:NoneType", "DECODE_ERROR:not_dict:list",
    "DECODE_ERROR:json:invalid json", "DECODE_ERROR:not_dict:float", "", "MISSING_FIELD:channel",
    "MISSING_FIELD:auth_status", "", "", "", "DECODE_ERROR:json:invalid json",
)

ORACLE_SQL["reject_matrix"] = f"""
SELECT event_id, CAST(event_id % {len(_EXPECTED)} AS INTEGER) AS variant,
  [{", ".join(_sql_str(x) for x in _EXPECTED)}][event_id % {len(_EXPECTED)} + 1] = '' AS is_valid,
  [{", ".join(_sql_str(x) for x in _EXPECTED)}][event_id % {len(_EXPECTED)} + 1] AS reasons
FROM events"""

ORACLE_SQL["drift_override"] = with_pipeline("""
SELECT event_id, batch_id FROM classified
WHERE decode_kind = 'ok' AND len(schema_reasons) = 0 AND NOT ts_naive
  AND abs(epoch_us(batch_now) - epoch_us(ts_value)) > 600000000""")

ORACLE_SQL["shard_resume"] = with_pipeline(""",
m AS (
  SELECT shard_id, CAST(floor((min(event_id) + max(event_id)) / 2.0) AS BIGINT) AS middle FROM raw GROUP BY shard_id
)
SELECT shard_id, event_id AS sequence_number FROM raw JOIN m USING (shard_id) WHERE event_id > middle
QUALIFY row_number() OVER (PARTITION BY shard_id ORDER BY event_id) <= 25""")

ORACLE_SQL["bronze_warnings"] = with_pipeline("""
SELECT txn_id AS transaction_id, run_id, 'TIMESTAMP_DRIFT' AS warnings FROM classified
WHERE list_contains(reasons, 'TIMESTAMP_DRIFT')""")

ORACLE_SQL["reject_matrix_stored"] = ORACLE_SQL["reject_matrix"]

ORACLE_SQL["rule_versions"] = with_pipeline(""",
objects AS (
  SELECT *, abs(epoch_us(batch_now) - epoch_us(ts_value)) AS drift,
    list_filter(schema_reasons, lambda x: x LIKE '%:channel%') AS channel2,
    list_concat(
      list_filter(schema_reasons, lambda x: x NOT LIKE '%:channel%' AND x NOT LIKE '%:mcc_code%'),
      list_filter([
        CASE WHEN n_amount > 100 AND len(list_filter(schema_reasons, lambda x: x LIKE '%:amount%')) = 0
             THEN 'INVALID_FIELD:amount:less_than_equal' END,
        CASE WHEN t_currency = 'VARCHAR' AND s_currency = 'CAD' THEN 'INVALID_FIELD:currency:enum' END,
        CASE WHEN t_merchant_id = 'VARCHAR' AND NOT regexp_matches(s_merchant_id, '^MERCH-[0-9A-Ea-e]')
             THEN 'INVALID_FIELD:merchant_id:string_pattern_mismatch' END
      ], lambda x: x IS NOT NULL)) AS schema2
  FROM classified WHERE decode_kind = 'ok'
), judged AS (
  SELECT 1 AS version, reasons AS errors, CAST([] AS VARCHAR[]) AS warnings FROM objects
  UNION ALL
  SELECT 2, CASE WHEN len(schema2) = 0 AND ts_naive THEN ['INVALID_FIELD:transaction_ts:timezone_missing']
                 ELSE schema2 END,
    CASE WHEN len(schema2) = 0 AND NOT ts_naive AND drift > 600000000
         THEN list_append(channel2, 'TIMESTAMP_DRIFT') ELSE channel2 END
  FROM objects
), listed AS (
  SELECT version, 'ERROR' AS outcome, unnest(errors) AS reason FROM judged
  UNION ALL SELECT version, 'WARNING', unnest(warnings) FROM judged
  UNION ALL SELECT version, 'ACCEPTED', '' FROM judged WHERE len(errors) = 0
)
SELECT CAST(version AS INTEGER) AS version, outcome, reason, count(*) AS records FROM listed GROUP BY ALL""")

ORACLE_SQL["run_states"] = with_pipeline("""
SELECT CAST(step AS BIGINT) AS step, run_status, CAST(NULL AS BIGINT) AS total_records,
  CAST(NULL AS BIGINT) AS valid_records, CAST(NULL AS BIGINT) AS quarantine_records, run_status = 'FAILED' AS has_error
FROM (VALUES (1, 'RUNNING'), (2, 'FAILED'), (3, 'RUNNING')) AS first_states (step, run_status)
UNION ALL
SELECT 4, CASE WHEN bool_and(is_valid) THEN 'SUCCESS' ELSE 'PARTIAL' END, count(*),
  count(*) FILTER (WHERE is_valid), count(*) FILTER (WHERE NOT is_valid), false
FROM classified""")

ORACLE_SQL["micro_batches"] =with_pipeline(""",
numbered AS (
  SELECT shard_id, (event_id // 10) % 3 AS slice,
    (row_number() OVER (PARTITION BY shard_id, (event_id // 10) % 3 ORDER BY event_id) - 1) // 100 AS batch_number
  FROM raw
)
SELECT shard_id, slice, batch_number, count(*) AS records,
  CASE WHEN count(*) = 100 THEN 'size' ELSE 'open' END AS closed_by
FROM numbered GROUP BY shard_id, slice, batch_number""")

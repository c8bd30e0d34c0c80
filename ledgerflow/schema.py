"""Record shapes, enum values, reason codes and lake settings.

Everything here is declarative: StructTypes for the fixed tables, the
accepted enum values, and the stable reason-code vocabulary that the
quarantine zone and the run-metadata table expose to their readers.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values that must equal the surveyed pipeline's contract.
# Enum members, field order, pipeline name and status names are part of
# what downstream readers grep for, so they are spelled out here verbatim.
# ---------------------------------------------------------------------------
CURRENCIES = ("USD", "EUR", "GBP", "CNY", "JPY", "CAD")
AUTH_STATUSES = ("APPROVED", "DECLINED", "PENDING")
CHANNELS = ("POS", "ECOM", "ATM", "PHONE", "RECURRING")

# Field order is the order validation errors are reported in.
TXN_FIELDS = (
    "transaction_id",
    "card_id",
    "merchant_id",
    "amount",
    "currency",
    "transaction_ts",
    "mcc_code",
    "auth_status",
    "channel",
)

PIPELINE_NAME = "txn-realtime-ingestion"

STATUS_RUNNING = "RUNNING"
STATUS_SUCCESS = "SUCCESS"
STATUS_PARTIAL = "PARTIAL"
STATUS_FAILED = "FAILED"

SEVERITY_ERROR = "ERROR"
SEVERITY_WARNING = "WARNING"

DRIFT_THRESHOLD_SECONDS = 3600
AMOUNT_MIN = 0.0
AMOUNT_MAX = 50000.0
MCC_LENGTH = 4

# Reason-code vocabulary.
DECODE_UTF8 = "DECODE_ERROR:utf8"
DECODE_JSON = "DECODE_ERROR:json"
DECODE_NOT_DICT = "DECODE_ERROR:not_dict"
MISSING_FIELD = "MISSING_FIELD"
INVALID_FIELD = "INVALID_FIELD"
TIMESTAMP_DRIFT = "TIMESTAMP_DRIFT"
# Our own code (a stated deviation): a timestamp without an offset is
# quarantined instead of failing the whole batch.
TIMEZONE_MISSING = "INVALID_FIELD:transaction_ts:timezone_missing"

# Fixed message text used after DECODE_ERROR:utf8: / DECODE_ERROR:json:
# when the JVM-only decode path is used (see functions.decode).
UTF8_FIXED_MESSAGE = "invalid utf-8"
JSON_FIXED_MESSAGE = "invalid json"

# Producer batching (put-records API limit).
PUT_BATCH_LIMIT = 500

# ---------------------------------------------------------------------------
# Table schemas
# ---------------------------------------------------------------------------
RAW_SCHEMA = T.StructType(
    [
        T.StructField("shard_id", T.StringType()),
        T.StructField("sequence_number", T.LongType()),
        T.StructField("arrival_ts", T.TimestampType()),
        T.StructField("partition_key", T.StringType()),
        T.StructField("data", T.BinaryType()),
    ]
)

BRONZE_SCHEMA = T.StructType(
    [
        T.StructField("transaction_id", T.StringType()),
        T.StructField("card_id", T.StringType()),
        T.StructField("merchant_id", T.StringType()),
        T.StructField("amount", T.DoubleType()),
        T.StructField("currency", T.StringType()),
        T.StructField("transaction_ts", T.StringType()),
        T.StructField("mcc_code", T.StringType()),
        T.StructField("auth_status", T.StringType()),
        T.StructField("channel", T.StringType()),
    ]
)

QUARANTINE_SCHEMA = T.StructType(
    [
        T.StructField("_raw_b64", T.StringType()),
        T.StructField("payload_json", T.StringType()),
        *[T.StructField(f, T.StringType()) for f in TXN_FIELDS],
        T.StructField("_quarantine_reason", T.ArrayType(T.StringType())),
        T.StructField("_quarantine_ts", T.StringType()),
    ]
)

METADATA_SCHEMA = T.StructType(
    [
        T.StructField("pipeline_name", T.StringType()),
        T.StructField("run_id", T.StringType()),
        T.StructField("run_status", T.StringType()),
        T.StructField("start_ts", T.StringType()),
        T.StructField("end_ts", T.StringType()),
        T.StructField("total_records", T.LongType()),
        T.StructField("valid_records", T.LongType()),
        T.StructField("quarantine_records", T.LongType()),
        T.StructField("s3_output_path", T.StringType()),
        T.StructField("s3_quarantine_path", T.StringType()),
        T.StructField("error_message", T.StringType()),
        T.StructField("lambda_request_id", T.StringType()),
        T.StructField("saved_at", T.TimestampType()),
    ]
)


@dataclass(frozen=True)
class LakeSettings:
    """Zone layout under one data root (one URI per zone).

    Zones nest under ``root``; every path is a Hadoop URI so the same
    settings work for a local folder, HDFS or an object store.
    """

    root: str
    bronze: str = field(default="")
    quarantine: str = field(default="")
    silver: str = field(default="")
    gold: str = field(default="")
    landing: str = field(default="")
    manifest: str = field(default="")
    metadata: str = field(default="")
    dead_letter: str = field(default="")
    checkpoints: str = field(default="")

    def __post_init__(self):
        root = self.root.rstrip("/")
        object.__setattr__(self, "root", root)
        defaults = {
            "bronze": "bronze/transactions",
            "quarantine": "quarantine/transactions",
            "silver": "silver/transactions",
            "gold": "gold/transactions_daily",
            "landing": "landing/transactions",
            "manifest": "manifest/transactions",
            "metadata": "metadata/pipeline_metadata",
            "dead_letter": "dead_letter/transactions",
            "checkpoints": "_checkpoints",
        }
        for name, rel in defaults.items():
            if not getattr(self, name):
                object.__setattr__(self, name, f"{root}/{rel}")

"""Names of the registered queries and their DuckDB oracle SQL."""

from __future__ import annotations

from . import queries as Q
from .oracle import ORACLE_SQL

QUERIES = {
    "batch_run_summary": Q.batch_run_summary,
    "decode_outcome_counts": Q.decode_outcome_counts,
    "decode_errors_b64": Q.decode_errors_b64,
    "field_reasons": Q.field_reasons,
    "reject_matrix": Q.reject_matrix,
    "reject_matrix_stored": Q.reject_matrix_stored,
    "rule_versions": Q.rule_versions,
    "drift_override": Q.drift_override,
    "drift_flagged": Q.drift_flagged,
    "bronze_rows": Q.bronze_rows,
    "quarantine_rows": Q.quarantine_rows,
    "partition_paths": Q.partition_paths,
    "bronze_roundtrip": Q.bronze_roundtrip,
    "quarantine_roundtrip": Q.quarantine_roundtrip,
    "metadata_latest": Q.metadata_latest,
    "metadata_get": Q.metadata_get,
    "metadata_last_n": Q.metadata_last_n,
    "metadata_by_status": Q.metadata_by_status,
    "shard_audit": Q.shard_audit,
    "shard_resume": Q.shard_resume,
    "stream_ingest": Q.stream_ingest,
    "run_states": Q.run_states,
    "micro_batches": Q.micro_batches,
    "producer_records": Q.producer_records,
    "producer_batches": Q.producer_batches,
    "send_result": Q.send_result,
    "send_failures": Q.send_failures,
    "send_order": Q.send_order,
    "record_preview": Q.record_preview,
    "generated_profile": Q.generated_profile,
    "silver_dedup": Q.silver_dedup,
    "gold_daily": Q.gold_daily,
    "card_rollup": Q.card_rollup,
    "card_sequence": Q.card_sequence,
    "warnings_tagged": Q.warnings_tagged,
    "bronze_warnings": Q.bronze_warnings,
    "bronze_day_counts": Q.bronze_day_counts,
    "dead_letter": Q.dead_letter,
    "landing_decode_counts": Q.landing_decode_counts,
    "manifest_check": Q.manifest_check,
    "file_copy_manifest": Q.file_copy_manifest,
}

ORACLE = {name: sql for name, sql in ORACLE_SQL.items() if name in QUERIES}

"""Schemas of the tables and messages, as DDL."""

from __future__ import annotations

FILES = (
    "id long, full_path string, file_name string, file_type string, size_bytes long, creation_year int, modification_year int, depth int, "
    "is_pdf boolean, ocr_needed boolean, hash_pending boolean, xxhash64 string, sha256 string, first_seen timestamp_ntz, last_seen timestamp_ntz, "
    "text_excerpt string, text_chars_extracted int, is_canonical boolean, canonical_id long, categoria string, last_classified timestamp_ntz, "
    "proyecto string, anio string"
)
FILE_EMBEDDINGS = "file_id long, embedding array<float>"
TASK_MAP = (
    "file_id long, correlation_id string, status string, attempts int, last_error string, created_at timestamp_ntz, updated_at timestamp_ntz"
)
TASK_MESSAGE = (
    "message_id string, correlation_id string, schema_version string, timestamp string, source string, target_model string, "
    "retry_count int, max_retries int, payload map<string,string>"
)
RESULT_MESSAGE = (
    "message_id string, correlation_id string, schema_version string, model string, status string, processing_time_ms int, result string, "
    "embedding array<float>, embedding_dim int, content_hash string, error struct<type:string,message:string,retryable:boolean>"
)
PIPELINE_RUNS = (
    "run_id long, status string, current_phase int, processed_files long, started_at timestamp_ntz, updated_at timestamp_ntz, "
    "finished_at timestamp_ntz, error_message string"
)
PIPELINE_PHASES = (
    "phase_id long, run_id long, phase_number int, status string, started_at timestamp_ntz, finished_at timestamp_ntz, error_message string"
)
PIPELINE_SCRIPTS = "script_id long, phase_id long, script_name string, status string, logs string, error_message string"

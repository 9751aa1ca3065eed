"""Nested-document ingestion and change tracking on Spark."""

from docstrata.functions.extract import extract
from docstrata.functions.fingerprint import columns_except, row_hash
from docstrata.functions.times import convert_zone, count_formats, detect_formats, parse_time, stamp_ingestion
from docstrata.operators.changes import (
    change_log,
    change_summary,
    changed_records,
    fingerprints,
    noise_columns,
)
from docstrata.operators.filters import list_dockets, preview, restrict_to_projects
from docstrata.operators.flatten import flatten, flatten_nested, flatten_object, to_key_value
from docstrata.operators.latest import latest_per_key, latest_view
from docstrata.operators.quality import (
    estimated_keys,
    freshness,
    ingestion_audit,
    key_violations,
    validate_master,
)
from docstrata.operators.upsert import align_to_schema, merge_upsert
from docstrata.operators.versions import number_versions
from docstrata.plans.changelog import ChangeTables, read_change_log, update_change_log
from docstrata.plans.pipeline import (
    commit_batch,
    compact,
    ingest,
    ingest_texts,
    rebuild,
    register_views,
    replay,
)
from docstrata.plans.views import create_views
from docstrata.sources.bucketed import publish_bucketed
from docstrata.sources.documents import flatten_documents, load_documents, rejected_documents
from docstrata.sources.files import discover_files, read_raw
from docstrata.sources.tables import (
    Tables,
    read_archived,
    read_audit,
    read_master,
    read_rejects,
    read_table,
    write_table,
)
from docstrata.spec import FieldSpec, PipelineSpec, delivery_spec
from docstrata.streaming.incremental import run_incremental_ingest
from docstrata.streaming.stream import run_stream_ingest

__all__ = [
    "ChangeTables",
    "FieldSpec",
    "PipelineSpec",
    "Tables",
    "align_to_schema",
    "change_log",
    "change_summary",
    "changed_records",
    "columns_except",
    "commit_batch",
    "compact",
    "convert_zone",
    "count_formats",
    "create_views",
    "delivery_spec",
    "detect_formats",
    "discover_files",
    "estimated_keys",
    "extract",
    "fingerprints",
    "flatten",
    "flatten_documents",
    "flatten_nested",
    "flatten_object",
    "freshness",
    "ingest",
    "ingest_texts",
    "ingestion_audit",
    "key_violations",
    "latest_per_key",
    "latest_view",
    "list_dockets",
    "load_documents",
    "merge_upsert",
    "noise_columns",
    "number_versions",
    "parse_time",
    "preview",
    "publish_bucketed",
    "read_archived",
    "read_audit",
    "read_change_log",
    "read_master",
    "read_raw",
    "read_rejects",
    "read_table",
    "rebuild",
    "register_views",
    "replay",
    "rejected_documents",
    "restrict_to_projects",
    "row_hash",
    "run_incremental_ingest",
    "run_stream_ingest",
    "stamp_ingestion",
    "to_key_value",
    "update_change_log",
    "validate_master",
    "write_table",
]

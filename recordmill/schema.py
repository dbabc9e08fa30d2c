"""Column names and schemas shared by all operators."""

from __future__ import annotations

from pyspark.sql import types as T


def _strings(names: list[str]) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


# Column names of the input and of the published tables.
RAW_COLUMNS = [
    "record_id", "source", "source_type", "bulletin_number",
    "title_raw", "summary_raw", "published_at_raw", "event_date_raw",
    "status_raw", "initiative_raw", "authors_raw",
    "url_raw", "document_url_raw", "scraped_at",
    "html_snippet", "content_hash_hint",
]
NORMALIZED_COLUMNS = [
    "record_id", "source", "source_type", "bulletin_number", "title", "summary",
    "published_at", "event_date", "status", "initiative", "authors",
    "canonical_url", "canonical_document_url", "content_hash_hint", "html_snippet",
]
CANONICAL_COLUMNS = [
    "canonical_id", "kept_record_id", "source", "source_type",
    "bulletin_number", "title", "summary", "published_at", "event_date",
    "status", "initiative", "authors", "canonical_url",
    "canonical_document_url", "duplicate_group_id",
]
REJECTED_COLUMNS = ["record_id", "rejection_reason", "raw_identifier_hint"]
CLUSTER_COLUMNS = ["duplicate_group_id", "record_id", "is_kept", "duplicate_reason"]
PARSE_ERROR_FIELDS = [
    "bulletin_number", "published_at", "event_date", "url_raw", "document_url_raw",
]
PROJECT_COLUMNS = [
    "seed_url", "detail_url", "bulletin_number", "title", "legislature", "entry_date",
    "status", "initiative", "origin_chamber", "authors", "scraped_at",
]
EVENT_COLUMNS = [
    "seed_url", "bulletin_number", "row_order", "event_date", "session", "stage",
    "substage", "description", "document_url",
]
EXTRACT_REPORT_COLUMNS = [
    "seed_url", "fetch_ok", "parse_ok", "http_status", "row_count", "error_message",
]

RAW_SCHEMA = _strings(RAW_COLUMNS)
NORMALIZED_SCHEMA = _strings(NORMALIZED_COLUMNS)

PAGES_SCHEMA = T.StructType([
    T.StructField("seed_url", T.StringType()),
    T.StructField("page_no", T.IntegerType()),
    T.StructField("http_status", T.IntegerType()),
    T.StructField("html", T.StringType()),
    T.StructField("fetch_error", T.StringType()),
])

"""Schemas of the tables, as DDL in the order they are stored."""

from __future__ import annotations

# A captured listing page; status and error are null when the capture succeeded without a status.
LISTING_PAGES = """page_seq BIGINT, body_key STRING, body_id INT, body_name STRING, partition_label STRING,
    page INT, url STRING, status INT, error STRING, html STRING"""

# A captured document response. fetch_seq is unique and gives the order of the run.
FETCHES = "fetch_seq BIGINT, url STRING, status INT, error STRING, data BINARY"

# Metadata of one landed document, as appended to the landing log.
RECORD_FIELDS = """identifier STRING, title STRING, description STRING, published_date DATE, body_key STRING,
    body_name STRING, body_id INT, partition_date STRING, source_url STRING, document_url STRING,
    document_type STRING, storage_path STRING, file_hash STRING, content_length BIGINT,
    scraped_at TIMESTAMP, last_run_id STRING"""
LANDING_LOG = f"{RECORD_FIELDS}, fetch_seq BIGINT, run_seq BIGINT"
CURATED_FIELDS = f"{RECORD_FIELDS}, original_storage_path STRING, original_file_hash STRING"
CURATED_HEADS = f"{CURATED_FIELDS}, content_type STRING, outcome STRING, run_seq BIGINT"
CURATED_LOG = f"{CURATED_FIELDS}, content_type STRING, outcome STRING, data BINARY, run_seq BIGINT"

# Landed bytes. The label is part of the storage path and a partition column of the table.
LANDING_OBJECTS = "storage_path STRING, data BINARY, content_type STRING, run_seq BIGINT, partition_date STRING"

OUTCOMES = """fetch_seq BIGINT, identifier STRING, body_key STRING, partition_date STRING, outcome STRING,
    run_seq BIGINT"""
FAILURES = "body_key STRING, partition_date STRING, url STRING, reason STRING, status INT, run_seq BIGINT"
FOUND = "body_key STRING, partition_date STRING, found BIGINT, run_seq BIGINT"


def field_names(ddl: str) -> list[str]:
    """Column names of a DDL string."""
    return [part.split()[0] for part in ddl.split(",")]


RECORD_COLUMNS = field_names(RECORD_FIELDS)

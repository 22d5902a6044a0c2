"""Schemas of the state tables and of the JSON inputs."""

from __future__ import annotations

from pyspark.sql import types as T

_TS = T.TimestampNTZType()
_S, _L, _I, _B, _D = T.StringType(), T.LongType(), T.IntegerType(), T.BooleanType(), T.DoubleType()


def _struct(*fields: tuple) -> T.StructType:
    """Fields are (name, type) or (name, type, nullable)."""
    return T.StructType([T.StructField(f[0], f[1], f[2] if len(f) > 2 else True) for f in fields])


PAGE_METADATA = _struct(
    ("page_id", _L, False), ("given_title", _S, False), ("found_title", _S),
    ("page_status", _S, False), ("user_verified", _B, False), ("attempts_made", _I),
    ("api_title", _S), ("api_type", _S), ("api_status", _S),
    ("last_modified_by_display_name", _S), ("last_modified_by_username", _S), ("last_modified_date", _S),
    ("created_by_display_name", _S), ("created_by_username", _S), ("created_date", _S),
    ("parent_page_title", _S), ("parent_page_id", _L), ("labels", _S),
    ("first_checked_on", _TS), ("last_checked_on", _TS),
    ("extraction_status", _S), ("hash_id", _S), ("last_parsed_content_hash", _S),
    ("structured_data_file", _S), ("notes", _S),
)

PARSED_CONTENT = _struct(("page_id", _L, False), ("parsed_json", _S, False), ("parsed_date", _TS, False))

DDL_STATE = _struct(
    ("fqdn", _S, False), ("env", _S, False), ("object_type", _S, False),
    ("db_name", _S, False), ("schema_name", _S, False), ("object_name", _S, False),
    ("obj_exists", _B, False),
    ("current_ddl_hash", _S), ("current_ddl", _S), ("last_extracted_on", _TS),
    ("previous_ddl_hash", _S), ("previous_ddl", _S), ("ddl_changed_on", _TS),
    ("last_checked_on", _TS, False), ("notes", _S),
)

COLUMN_MAP = _struct(
    ("page_id", _L, False), ("page_title", _S, False), ("source_field_name", _S, False),
    ("target_field_name", _S, False), ("data_type", _S, False), ("resolved_type", _S, False),
    ("is_primary_key", _B, False), ("definition", _S), ("comments", _S),
    ("fqdn", _S, False), ("env", _S, False), ("object_type", _S, False),
    ("matched_column", _S), ("match_score", _D), ("match_strategy", _S),
    ("mapping_status", _S, False), ("ddl_hash_at_mapping", _S), ("last_mapped_on", _TS, False),
    ("notes", _S), ("user_override", _B, False), ("is_active", _B, False),
)

STATE_TABLES = {
    "page_metadata": PAGE_METADATA,
    "parsed_content": PARSED_CONTENT,
    "ddl_state": DDL_STATE,
    "column_map": COLUMN_MAP,
}

PRIMARY_KEYS = {
    "page_metadata": ["page_id"],
    "parsed_content": ["page_id"],
    "ddl_state": ["fqdn", "env", "object_type"],
    "column_map": ["page_id", "target_field_name", "fqdn", "env", "object_type"],
}

OBJECT_KEY = PRIMARY_KEYS["ddl_state"]
MAPPING_KEY = PRIMARY_KEYS["column_map"]

REPORT = _struct(
    ("given_title", _S), ("status", _S), ("found_title", _S), ("page_id", _L), ("notes", _S),
    ("first_checked_on", _TS), ("last_checked_on", _TS), ("user_verified", _B), ("attempts_made", _I),
)

# DDL text, because parsing it into a type needs a session
PAGE_DOC = (
    "title string, type string, status string,"
    "history struct<createdBy: struct<displayName: string, username: string>, createdDate: string,"
    "  lastUpdated: struct<by: struct<displayName: string, username: string>, `when`: string>>,"
    "metadata struct<labels: struct<results: array<struct<name: string>>>>,"
    "ancestors array<struct<id: string, title: string>>,"
    "body struct<storage: struct<value: string>>"
)

PARSED_PAGE = (
    "page_title string, page_id bigint,"
    "metadata struct<table_name: string, schema_name: string, database_name: string,"
    "  primary_keys: array<string>, foreign_keys: array<string>>,"
    "tables array<struct<id: string, table_type: string, columns: array<map<string, string>>>>"
)


def state_schema(name: str) -> T.StructType:
    """Schema of one of the four state tables."""
    return STATE_TABLES[name]

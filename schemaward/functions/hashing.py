"""SHA-256 fingerprints for change detection."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from schemaward.functions.text import labels_json


def metadata_hash(created_by: Column, created: Column, modified_by: Column, modified: Column,
                  parent_id: Column, labels: Column) -> Column:
    """Fingerprint of who, when, parent and sorted labels; nulls count as 'None'."""
    parts = [F.coalesce(c.cast("string"), F.lit("None")) for c in (created_by, created, modified_by, modified, parent_id)]
    return F.sha2(F.concat_ws("|", *parts, labels_json(F.sort_array(labels))), 256)


def ddl_hash(ddl: Column) -> Column:
    """Fingerprint of DDL text; null for null or empty text."""
    return F.sha2(F.nullif(ddl, F.lit("")), 256)

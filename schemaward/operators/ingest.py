"""Page metadata: ingest with change detection, parse queue and parse results."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from schemaward import constants as K
from schemaward import schemas as S
from schemaward.functions.hashing import metadata_hash
from schemaward.functions.text import add_note, clean_strings, clean_text, file_key, labels_json, title_or_default

# Columns that only a successfully read document supplies.
_FROM_DOC = ["api_title", "api_type", "api_status", "last_modified_by_display_name", "last_modified_by_username",
             "last_modified_date", "created_by_display_name", "created_by_username", "created_date",
             "parent_page_title", "parent_page_id", "labels"]


def flatten_page_docs(docs: DataFrame) -> DataFrame:
    """(page_id, doc_json) to flat metadata; the last ancestor is the parent.

    Adds ``doc_ok``: the document is present and valid JSON.
    """
    d = docs.select("page_id", "doc_json", F.from_json("doc_json", S.PAGE_DOC).alias("d"))
    names = F.transform(F.col("d.metadata.labels.results"), lambda r: r["name"])
    parent = F.try_element_at(F.col("d.ancestors"), F.lit(-1))
    return d.select(
        "page_id",
        F.col("d.title").alias("api_title"), F.col("d.type").alias("api_type"), F.col("d.status").alias("api_status"),
        F.col("d.history.lastUpdated.by.displayName").alias("last_modified_by_display_name"),
        F.col("d.history.lastUpdated.by.username").alias("last_modified_by_username"),
        F.col("d.history.lastUpdated.when").alias("last_modified_date"),
        F.col("d.history.createdBy.displayName").alias("created_by_display_name"),
        F.col("d.history.createdBy.username").alias("created_by_username"),
        F.col("d.history.createdDate").alias("created_date"),
        parent["title"].alias("parent_page_title"),
        parent["id"].try_cast("bigint").alias("parent_page_id"),
        F.coalesce(F.filter(names, lambda n: F.coalesce(n, F.lit("")) != ""), F.array().cast("array<string>")).alias("labels"),
        F.col("doc_json").isNotNull().alias("doc_present"),
        F.coalesce(F.is_valid_json("doc_json") if hasattr(F, "is_valid_json") else
                   F.try_parse_json("doc_json").isNotNull(), F.lit(False)).alias("doc_ok"),
    )


def page_bodies(docs: DataFrame) -> DataFrame:
    """Page body text; a missing or empty body is a failure row."""
    body = F.nullif(F.get_json_object("doc_json", "$.body.storage.value"), F.lit(""))
    return docs.select("page_id", body.alias("html"),
                       F.when(F.col("doc_json").isNull(), "API_ERROR").when(body.isNull(), "EMPTY_BODY")
                       .otherwise("OK").alias("outcome"))


def page_hash() -> Column:
    """H11 over the flattened columns."""
    return metadata_hash(*[F.col(c) for c in ("created_by_username", "created_date", "last_modified_by_username",
                                              "last_modified_date", "parent_page_id", "labels")])


def ingest_metadata(prev: DataFrame, docs: DataFrame, report: DataFrame, as_of: str) -> DataFrame:
    """M3: next page-metadata state from verified report entries and their documents.

    The hash decides whether a page returns to METADATA_INGESTED; a failed read
    keeps the stored document columns, clears the hash and says why in the notes.
    """
    flat = flatten_page_docs(docs).withColumn("new_hash", page_hash()).withColumn("labels", labels_json(F.col("labels")))
    doc = flat.select("page_id", "doc_present", "doc_ok", "new_hash", F.struct(*_FROM_DOC).alias("doc"))
    kept = ["hash_id", "extraction_status", "last_parsed_content_hash", "structured_data_file", *_FROM_DOC]
    old = prev.select("page_id", F.struct(*kept).alias("old"))
    hits = report.where("status = 'HIT' and user_verified and page_id is not null")
    # several titles may lead to one page: the entry checked last speaks for it, then the last title
    fields = [c for c in report.columns if c != "page_id"]
    verified = hits.groupBy("page_id").agg(F.max_by(F.struct(*fields), F.struct("last_checked_on", "given_title", F.struct(*fields))).alias("_r")).select("page_id", "_r.*")
    rows = verified.join(doc, "page_id", "left").join(old, "page_id", "left")

    present = F.coalesce("doc_present", F.lit(False))
    ok = present & F.coalesce("doc_ok", F.lit(False))
    was_parsed = F.coalesce(F.col("old.extraction_status") == "PARSED_OK", F.lit(False))
    same = F.coalesce(F.col("new_hash") == F.col("old.hash_id"), F.lit(False))
    status = (
        F.when(~present, "API_FAILED_METADATA").when(~ok, "METADATA_INGEST_FAILED")
        .when(same & was_parsed, "PARSED_OK").otherwise("METADATA_INGESTED")
    )
    failure = F.when(~present, F.lit("API error fetching metadata")).when(~ok, F.lit("Error during metadata ingestion"))
    changes = rows.select(
        "page_id", "given_title", "found_title", F.col("status").alias("page_status"), "user_verified", "attempts_made",
        *[F.when(ok, F.col(f"doc.{c}")).otherwise(F.col(f"old.{c}")).alias(c) for c in _FROM_DOC],
        "first_checked_on", F.lit(as_of).cast("timestamp_ntz").alias("last_checked_on"),
        status.alias("extraction_status"), F.when(ok, F.col("new_hash")).alias("hash_id"),
        F.col("old.last_parsed_content_hash").alias("last_parsed_content_hash"),
        F.col("old.structured_data_file").alias("structured_data_file"),
        add_note(F.col("notes"), failure).alias("notes"),
    ).select(*S.PAGE_METADATA.names)
    # the report alone tells which state rows are replaced: the documents are read once
    return prev.join(hits.select("page_id"), "page_id", "left_anti").unionByName(clean_strings(changes))


def parse_queue(meta: DataFrame) -> DataFrame:
    """verified pages whose hash moved, that were never parsed, or that must be retried."""
    moved = ~F.col("hash_id").eqNullSafe(F.col("last_parsed_content_hash")) | F.col("last_parsed_content_hash").isNull()
    return meta.where(F.col("user_verified") & (moved | F.coalesce(F.col("extraction_status").isin(*K.RETRY_STATES), F.lit(False))))


def apply_parse_result(meta: DataFrame, results: DataFrame, as_of: str) -> DataFrame:
    """M4: page-metadata state after a parse run.

    ``results``: page_id, outcome (OK, API_ERROR, EMPTY_BODY, PARSE_ERROR), table_name, detail.
    Only parsed pages change; the results side is joined left and may be broadcast.
    """
    new = results.select("page_id", "outcome", "table_name", "detail")
    done, seen = F.col("outcome") == "OK", F.col("outcome").isNotNull()
    status = F.when(done, "PARSED_OK").when(F.col("outcome") == "API_ERROR", "API_FAILED_CONTENT").otherwise("PARSE_FAILED")
    reason = (
        F.when(F.col("outcome") == "API_ERROR", F.lit("API error fetching content"))
        .when(F.col("outcome") == "EMPTY_BODY", F.lit("Content parsing/access error: no body content found"))
        .when(F.col("outcome") == "PARSE_ERROR", F.lit("Error during content parsing"))
    )
    note = F.when(reason.isNotNull(), F.concat_ws(": ", reason, "detail"))
    title = F.coalesce(F.nullif("api_title", F.lit("")), "found_title")
    name = F.concat(file_key(F.coalesce("table_name", title)), F.lit(".json"))
    over = {
        "extraction_status": F.when(seen, status).otherwise(F.col("extraction_status")),
        "last_parsed_content_hash": F.when(done, F.col("hash_id")).otherwise(F.col("last_parsed_content_hash")),
        "structured_data_file": F.when(done, name).otherwise(F.col("structured_data_file")),
        "notes": F.when(seen, clean_text(add_note(F.col("notes"), note))).otherwise(F.col("notes")),
        "last_checked_on": F.when(seen, F.coalesce("last_checked_on", F.lit(as_of).cast("timestamp_ntz")))
        .otherwise(F.col("last_checked_on")),
    }
    return meta.join(new, "page_id", "left").select(*[over[c].alias(c) if c in over else F.col(c) for c in meta.columns])


def meta_content(meta: DataFrame, parsed: DataFrame) -> DataFrame:
    """Metadata with parsed content."""
    return meta.join(parsed.hint("merge"), "page_id")


def mappable(meta: DataFrame, parsed: DataFrame) -> DataFrame:
    """parsed and verified pages with their content."""
    return meta_content(meta.where((F.col("extraction_status") == "PARSED_OK") & F.col("user_verified")), parsed)


def with_title(parsed: DataFrame, meta: DataFrame) -> DataFrame:
    """Page title next to parsed rows, or a label made of the page id."""
    titles = meta.select("page_id", "api_title", "found_title")
    title = title_or_default(F.col("api_title"), F.col("found_title"), F.col("page_id"))
    return parsed.join(titles, "page_id", "left").withColumn("page_title", title).drop("api_title", "found_title")


def explode_parsed(parsed: DataFrame) -> DataFrame:
    """Parsed JSON text to one row per table row: page_id, table_ord, row_ord, record."""
    page = F.from_json("parsed_json", S.PARSED_PAGE)
    tables = parsed.select("page_id", F.explode(page["tables"]).alias("t"))
    number = F.regexp_extract(F.col("t.id"), r"table_(\d+)", 1).try_cast("int")
    return tables.select("page_id", number.alias("table_ord"), F.posexplode("t.columns").alias("row_ord", "record"))

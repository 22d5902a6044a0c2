"""The whole chain on one small wiki: titles to report, pages to columns, sources to objects, columns to DDL."""

import json

from pyspark.sql import functions as F

from schemaward import constants as K
from schemaward import schemas as S
from schemaward.operators import ingest, resolver, titles
from schemaward.plans import jobs
from schemaward.workload.inputs import ENVIRONMENTS

HTML = ("<p>Table name: Orders</p><table><tr><th>Source table</th><th>Source field name</th><th>Add Source To Target?</th>"
        "<th>Target field name</th><th>Data type</th><th>Is primary key</th></tr>"
        "<tr><td> raw_orders </td><td>order_id</td><td>Yes</td><td>id</td><td>integer</td><td>yes</td></tr>"
        "<tr><td></td><td>note</td><td>no</td><td>note</td><td>varchar(20)</td><td></td></tr></table>")
DOC = {"title": "Table: Orders", "type": "page", "status": "current", "history": {"createdBy": {"username": "ann"}, "createdDate": "2024"},
       "metadata": {"labels": {"results": [{"name": "gold"}]}}, "ancestors": [{"id": "9", "title": "Root"}], "body": {"storage": {"value": HTML}}}


def test_chain(spark):
    wanted = spark.createDataFrame([("Table : Orders", 0), ("Absent", 1)], "given_title string, ord int")
    wiki = spark.createDataFrame([(5, "Table: Orders"), (9, "Table: Orders")], "page_id long, title string")
    nothing = spark.createDataFrame([], S.REPORT)
    first = jobs.find_pages(wanted, wiki, nothing, "2024-01-01 00:00:00")
    got = {r.given_title: r for r in first.collect()}
    assert (got["Table : Orders"].page_id, got["Table : Orders"].attempts_made, got["Absent"].status) == (5, 2, "MISS")
    assert not got["Table : Orders"].user_verified

    reviewed = spark.createDataFrame([("Table : Orders", True)], "given_title string, user_verified boolean")
    report = jobs.find_pages(wanted, wiki, first, "2024-02-01 00:00:00", reviewed)
    again = {r.given_title: r for r in report.collect()}["Table : Orders"]
    assert again.user_verified and again.first_checked_on.month == 1 and again.last_checked_on.month == 2
    assert titles.to_search(wanted, report).count() == 1

    docs = spark.createDataFrame([(5, json.dumps(DOC))], "page_id long, doc_json string")
    meta0 = spark.createDataFrame([], S.PAGE_METADATA)
    meta = ingest.ingest_metadata(meta0, docs, report, "2024-02-01 00:00:00")
    row = meta.first()
    assert (row.extraction_status, row.parent_page_id, row.labels) == ("METADATA_INGESTED", 9, '["gold"]')

    meta = spark.createDataFrame(meta.collect(), S.PAGE_METADATA)
    meta2, content = jobs.parse_run(meta, docs, spark.createDataFrame([], S.PARSED_CONTENT), "2024-02-02 00:00:00")
    parsed = meta2.first()
    assert (parsed.extraction_status, parsed.structured_data_file) == ("PARSED_OK", "orders.json")
    assert parsed.last_parsed_content_hash == parsed.hash_id
    assert ingest.parse_queue(meta2).count() == 0
    unchanged = ingest.ingest_metadata(meta2, docs, report, "2024-02-03 00:00:00").first()
    assert unchanged.extraction_status == "PARSED_OK"

    entry = {"defaults": {"environments": ["DEV", "PRU"], "fqdn": "lake.core.orders"}}
    flat = resolver.load_resolver(spark.createDataFrame([(0, "RAW_ORDERS", json.dumps(entry))], "entry_ord int, entry_key string, entry_json string"))
    objects = spark.createDataFrame([("DEV", "lake", "Core", "ORDERS", "BASE TABLE")], "env string, db_name string, schema_name string, object_name string, table_type string")
    ddl = spark.createDataFrame([("LAKE.CORE.ORDERS", "DEV", "TABLE", "create table ORDERS (ORDER_ID NUMBER(38,0), NOTE VARCHAR(20))")],
                                "fqdn string, env string, object_type string, ddl string")
    from schemaward.operators.pages import colspecs, primary_table
    specs = colspecs(primary_table(ingest.explode_parsed(content)))
    state = jobs.check_and_store(specs, flat, ENVIRONMENTS, objects, ddl, spark.createDataFrame([], S.DDL_STATE), "2024-02-02 00:00:00")
    found = {r.env: r for r in state.collect()}
    assert found["DEV"].obj_exists and not found["PRU"].obj_exists and found["PRU"].notes == "TABLE does not exist."

    types = spark.createDataFrame(list(K.DEFAULT_TYPE_MAP.items()), "declared_type string, warehouse_type string")
    mapped = jobs.map_run(meta2, content, flat, ENVIRONMENTS, state, spark.createDataFrame([], S.COLUMN_MAP), types, "2024-02-03 00:00:00").collect()
    assert [(r.target_field_name, r.env, r.matched_column, r.mapping_status, r.resolved_type, r.is_primary_key) for r in mapped] == [
        ("id", "DEV", "ORDER_ID", "MAPPED_EXACT", "NUMBER(38,0)", True)]


def test_failed_documents_keep_stored_columns(spark):
    report = spark.createDataFrame([("T", "HIT", "T", 1, "", None, None, True, 1), ("U", "HIT", "U", 2, "n", None, None, True, 1)], S.REPORT)
    good = spark.createDataFrame([(1, json.dumps(DOC)), (2, json.dumps(DOC))], "page_id long, doc_json string")
    meta = ingest.ingest_metadata(spark.createDataFrame([], S.PAGE_METADATA), good, report, "2024-01-01 00:00:00")
    meta = spark.createDataFrame(meta.collect(), S.PAGE_METADATA)
    bad = spark.createDataFrame([(1, None), (2, "{oops")], "page_id long, doc_json string")
    got = {r.page_id: r for r in ingest.ingest_metadata(meta, bad, report, "2024-01-02 00:00:00").collect()}
    assert [got[i].extraction_status for i in (1, 2)] == ["API_FAILED_METADATA", "METADATA_INGEST_FAILED"]
    assert got[1].hash_id is None and got[1].api_title == "Table: Orders"
    assert got[2].notes == "n | Error during metadata ingestion"

"""Queries over readers and writers: derived data is written to the shared folder and read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from schemaward.functions.text import labels_json
from schemaward.operators import ingest, pages
from schemaward.operators.merge import lookup
from schemaward.session import shared_dir
from schemaward.sources import inputs as R
from schemaward.sources import long_documents as L
from schemaward.sources import outputs as W
from schemaward.workload.registry import query

DOC_SIZE = 1000  # entries per JSON document
LONG = 20_000    # entries per document that is read in blocks


def _documents(df, order, item, left, right, size=DOC_SIZE):
    """Entries joined into one JSON document per block of ``size`` consecutive keys."""
    items = F.transform(F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), item.alias("i")))), lambda x: x["i"])
    return (df.groupBy(F.floor(F.col(order) / size).alias("doc"))
            .agg(F.concat(F.lit(left), F.array_join(items, ","), F.lit(right)).alias("value")))


def _write_documents(docs, path):
    docs.repartition("doc").write.partitionBy("doc").text(path)


@query(f"select ord % {DOC_SIZE} as ord, given_title from @titles")
def read_titles(c):
    path = shared_dir(c.spark)
    text = F.to_json(F.array("given_title")).substr(F.lit(2), F.length(F.to_json(F.array("given_title"))) - 2)
    _write_documents(_documents(c["titles"], "ord", text, "[", "]"), path)
    return R.read_titles(c.spark, path).select(F.col("ord").cast("long"), "given_title")


@query("select given_title, status, found_title, page_id, notes, first_checked_on, last_checked_on, user_verified, attempts_made from @prev_report")
def report_round_trip(c):
    path = shared_dir(c.spark)
    W.write_report(c["prev_report"], path)
    return R.read_report(c.spark, path)


@query("select entry_key, entry_json from @resolver_entries")
def read_resolver_entries(c):
    path = shared_dir(c.spark)
    item = F.concat(F.lit('"'), "entry_key", F.lit('":'), "entry_json")
    _write_documents(_documents(c["resolver_entries"], "entry_ord", item, "{", "}"), path)
    return R.read_resolver_raw(c.spark, path).select("entry_key", "entry_json")


@query(f"""select cast(d as bigint) as doc, case d % 4 when 1 then 'not a JSON list' else 'not JSON' end as reason
 from (select distinct o_orderkey // {DOC_SIZE} as d from orders) x where d % 4 > 0""")
def document_faults(c):
    path = shared_dir(c.spark)
    good = _documents(c["orders"], "o_orderkey", F.concat(F.lit('"'), "o_orderpriority", F.lit('"')), "[", "]")
    kind, value = F.col("doc") % 4, F.col("value")
    broken = (F.when(kind == 1, F.concat(F.lit('{"a": '), value, F.lit("}"))).when(kind == 2, F.substring(value, F.lit(1), F.length(value) - 1))
              .when(kind == 3, F.concat(F.lit("titles: "), value)).otherwise(F.concat(F.lit(" "), value)))
    _write_documents(good.withColumn("value", broken), path)
    return R.document_faults(c.spark, path, "list").select(F.regexp_extract("path", "doc=([0-9]+)", 1).cast("long").alias("doc"), "reason")


@query("select upper(map_key) as declared_type, arg_max(map_value, n) as warehouse_type from @type_map_raw where trim(map_value) <> '' group by 1")
def read_type_map(c):
    path = shared_dir(c.spark)
    item = F.concat(F.lit('"'), "map_key", F.lit('":"'), "map_value", F.lit('"'))
    _write_documents(_documents(c["type_map_raw"], "n", item, "{", "}"), path)
    return R.read_type_map(c.spark, path)


@query(f"select ord % {LONG} as ord, given_title from @titles")
def read_titles_in_blocks(c):
    path = shared_dir(c.spark)
    text = F.to_json(F.array("given_title")).substr(F.lit(2), F.length(F.to_json(F.array("given_title"))) - 2)
    _write_documents(_documents(c["titles"], "ord", text, "[", "]", LONG), path)
    return L.read_titles(c.spark, path).select("ord", "given_title")


@query("select entry_key, entry_json from @resolver_entries")
def read_resolver_in_blocks(c):
    path = shared_dir(c.spark)
    item = F.concat(F.lit('"'), "entry_key", F.lit('":'), "entry_json")
    _write_documents(_documents(c["resolver_entries"], "entry_ord", item, "{", "}", LONG), path)
    return L.read_resolver_raw(c.spark, path).select("entry_key", "entry_json")


@query("select upper(map_key) as declared_type, arg_max(map_value, n) as warehouse_type from @type_map_raw where trim(map_value) <> '' group by 1")
def read_type_map_in_blocks(c):
    path = shared_dir(c.spark)
    item = F.concat(F.lit('"'), "map_key", F.lit('":"'), "map_value", F.lit('"'))
    _write_documents(_documents(c["type_map_raw"], "n", item, "{", "}", LONG), path)
    return R.type_map_from_raw(L.read_type_map_raw(c.spark, path))


@query(f"""select cast(d as bigint) as doc, case d % 4 when 1 then 'not a JSON list' else 'not JSON' end as reason
 from (select distinct o_orderkey // {LONG} as d from orders) x where d % 4 > 0""")
def document_faults_in_blocks(c):
    path = shared_dir(c.spark)
    good = _documents(c["orders"], "o_orderkey", F.concat(F.lit('"'), "o_orderpriority", F.lit('"')), "[", "]", LONG)
    kind, value = F.col("doc") % 4, F.col("value")
    broken = (F.when(kind == 1, F.concat(F.lit('{"a": '), value, F.lit("}"))).when(kind == 2, F.substring(value, F.lit(1), F.length(value) - 1))
              .when(kind == 3, F.concat(F.lit("titles: "), value)).otherwise(F.concat(F.lit(" "), value)))
    _write_documents(good.withColumn("value", broken), path)
    return L.document_faults(c.spark, path, "list").select(F.regexp_extract("path", "doc=([0-9]+)", 1).cast("long").alias("doc"), "reason")


@query("""select page_id, api_title, created_by_display_name, created_by_username, created_date, last_modified_by_username,
 last_modified_date, parent_page_title, parent_page_id, labels, present as doc_present, ok as doc_ok from @doc_fields""")
def flatten_page_docs(c):
    return ingest.flatten_page_docs(c["page_docs"]).select(
        "page_id", "api_title", "created_by_display_name", "created_by_username", "created_date", "last_modified_by_username",
        "last_modified_date", "parent_page_title", "parent_page_id", labels_json(F.col("labels")).alias("labels"),
        "doc_present", "doc_ok")


@query("""select c_custkey as page_id, case when c_custkey % 17 in (5, 6) or c_custkey % 11 = 0 then null else '<p>' || c_mktsegment || '</p>' end as html,
 case when c_custkey % 17 = 5 then 'API_ERROR' when c_custkey % 17 = 6 or c_custkey % 11 = 0 then 'EMPTY_BODY' else 'OK' end as outcome from @customer""")
def page_bodies(c):
    return ingest.page_bodies(c["page_docs"])


@query("""select cast(floor(o_orderkey / 20) as bigint) as page_id, cast(1 as bigint) as table_ord,
 row_number() over (partition by floor(o_orderkey / 20) order by o_orderkey) - 1 as row_ord,
 cast(o_orderkey as varchar) as order_key, o_orderstatus as status, o_orderpriority as order_priority from orders""")
def explode_parsed(c):
    parsed = pages.to_parsed_json(c.dealt("order_pages"))
    first = pages.primary_table(ingest.explode_parsed(parsed))
    return first.select("page_id", F.col("table_ord").cast("long"), F.col("row_ord").cast("long"),
                        *[F.col("record")[k].alias(k) for k in ("order_key", "status", "order_priority")])


@query("select env, db_name, schema_name, object_name, table_type from @inventory")
def read_inventory(c):
    path = shared_dir(c.spark)
    c["inventory"].write.parquet(path)
    return R.read_inventory(c.spark, path)


@query("select fqdn, env, object_type, checked_on, obj_exists, ddl from @snapshots")
def read_ddl_snapshots(c):
    path = shared_dir(c.spark)
    c["snapshots"].write.parquet(path)
    return R.read_ddl_snapshots(c.spark, path)


@query("select * from @page_metadata")
def state_table_round_trip(c):
    path = shared_dir(c.spark)
    W.write_state(c["page_metadata"], "page_metadata", path)
    return R.read_state(c.spark, "page_metadata", path)


@query("select page_id, api_title, hash_id from @page_metadata where page_id = 42")
def state_lookup(c):
    return lookup(c["page_metadata"], page_id=42).select("page_id", "api_title", "hash_id")


@query("""select case when page_id % 3 = 0 then 'block_' else 't_' end || cast(page_id as varchar) as file_key, page_id, n as first_table_rows
 from (select cast(floor(o_orderkey / 20) as bigint) as page_id, count(*) as n from orders group by 1) p""")
def write_tables_json(c):
    path = shared_dir(c.spark)
    W.write_tables_json(pages.parsed_pages(c.dealt("order_pages")), path)
    schema = ("page_id bigint, file_key string,"
              "page struct<metadata:struct<table_name:string>, tables:array<struct<id:string,columns:array<map<string,string>>>>>")
    return c.spark.read.schema(schema).json(path).select(
        "file_key", "page_id", F.size(F.get("page.tables", F.lit(0))["columns"]).cast("long").alias("first_table_rows"))

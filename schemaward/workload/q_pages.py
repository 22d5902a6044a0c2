"""Queries over HTML pages: cells, labels, nested documents, declared columns."""

from __future__ import annotations

from pyspark.sql import functions as F

from schemaward.operators import ingest, pages
from schemaward.workload.registry import query

_ORD = "row_number() over (partition by floor(o_orderkey / 20) order by o_orderkey)"
_ROWS = f"select *, cast(floor(o_orderkey / 20) as bigint) as page_id, {_ORD} as n from orders"
# table 3 has header kind, deprecated, kind; two of its four row kinds hold values
_ODD = f"""select page_id, n, case o_orderkey % 4 when 0 then ['', 'false', ''] when 1 then [o_orderstatus, 'false', ''] else [o_orderstatus || ' & more', 'true', 'last'] end as v
 from ({_ROWS}) r where o_orderkey % 4 <> 2"""
_CELLS = f"""select page_id, 1 as table_ord, n as row_ord, unnest([0, 1, 2]) as col_ord, unnest(['order_key', 'status', 'order_priority']) as key,
 unnest([cast(o_orderkey as varchar), o_orderstatus, o_orderpriority]) as value from ({_ROWS}) r
 union all select page_id, 3, n, unnest([0, 1, 2]), unnest(['kind', 'deprecated', 'kind']), unnest(v) from ({_ODD}) o"""
_DEDUPED = f"""select page_id, table_ord, row_ord, min(col_ord) as col_ord, key, arg_max(value, col_ord) as value from ({_CELLS}) c group by page_id, table_ord, row_ord, key"""
_KEPT = f"""select * from ({_DEDUPED}) d where exists (select 1 from ({_DEDUPED}) e where e.page_id = d.page_id and e.table_ord = d.table_ord and e.row_ord = d.row_ord
 and e.value <> '' and not (e.key = 'deprecated' and e.value = 'false'))"""
_LONG = "cast(page_id as bigint) as page_id, cast(table_ord as bigint) as table_ord, cast(row_ord as bigint) as row_ord, cast(col_ord as bigint) as col_ord, key, value"


def _long(df):
    return df.select("page_id", *[F.col(x).cast("long") for x in ("table_ord", "row_ord", "col_ord")], "key", "value")


@query(f"select {_LONG} from ({_CELLS}) c")
def page_tables(c):
    return _long(pages.page_tables(c.dealt("order_pages")))


@query(f"select {_LONG} from ({_DEDUPED}) c")
def dedupe_headers(c):
    return _long(pages.page_tables(c.dealt("order_pages"), one_per_header=True))


@query(f"select {_LONG} from ({_KEPT}) c")
def drop_blank_rows(c):
    return _long(pages.page_tables(c.dealt("order_pages"), one_per_header=True, filled_rows=True))


@query(f"select page_id, cast(n as bigint) as row_ord, cast(o_orderkey as varchar) as order_key, o_orderstatus as status, o_orderpriority as order_priority from ({_ROWS}) r")
def pivot_first_table(c):
    cells = pages.primary_table(pages.page_tables(c.dealt("order_pages")))
    wide = pages.pivot_cells(cells, ["order_key", "status", "order_priority"])
    return wide.select("page_id", F.col("row_ord").cast("long"), "order_key", "status", "order_priority")


@query(f"""select page_id, cast(n as bigint) as row_ord, 'order_key=' || cast(o_orderkey as varchar) || ';order_priority=' || o_orderpriority || ';status=' || o_orderstatus as record from ({_ROWS}) r""")
def cells_to_records(c):
    cells = pages.primary_table(pages.page_tables(c.dealt("order_pages")))
    pairs = F.transform(F.array_sort(F.map_entries("record")), lambda e: F.concat(e["key"], F.lit("="), e["value"]))
    return pages.pivot_cells(cells).select("page_id", F.col("row_ord").cast("long"), F.array_join(pairs, ";").alias("record"))


@query("""select distinct page_id, case when page_id % 3 = 0 then 'Block ' else 'T ' end || cast(page_id as varchar) as table_name, 'S' || cast(page_id % 5 as varchar) as schema_name,
 'D' as database_name, 'a|b' as primary_keys, '' as foreign_keys from (select cast(floor(o_orderkey / 20) as bigint) as page_id from orders) o""")
def page_labels(c):
    return pages.page_labels(c.dealt("order_pages")).select(
        "page_id", "table_name", "schema_name", "database_name", F.array_join("primary_keys", "|").alias("primary_keys"),
        F.array_join("foreign_keys", "|").alias("foreign_keys"))


@query(f"""select p.page_id, '{{"page_title":"Table: Block ' || cast(p.page_id as varchar) || '","page_id":' || cast(p.page_id as varchar) || ',"metadata":{{"table_name":"' ||
 case when p.page_id % 3 = 0 then 'Block ' else 'T ' end || cast(p.page_id as varchar) || '","schema_name":"S' || cast(p.page_id % 5 as varchar) ||
 '","database_name":"D","primary_keys":["a","b"],"foreign_keys":[]}},"tables":[{{"id":"table_1","table_type":"dynamically_parsed","columns":[' || p.rows ||
 ']}},{{"id":"table_3","table_type":"dynamically_parsed","columns":[' || coalesce(o.rows, '') || ']}}]}}' as parsed_json
 from (select page_id, string_agg('{{"order_key":"' || cast(o_orderkey as varchar) || '","status":"' || o_orderstatus || '","order_priority":"' || o_orderpriority || '"}}', ',' order by n) as rows from ({_ROWS}) r group by page_id) p
 left join (select page_id, string_agg('{{"kind":"' || v[3] || '","deprecated":"' || v[2] || '"}}', ',' order by n) as rows from ({_ODD}) z where v[3] <> '' or v[2] = 'true' group by page_id) o on p.page_id = o.page_id""")
def parsed_json(c):
    return pages.to_parsed_json(c.dealt("order_pages"))


@query("""select page_id, cast(0 as bigint) as tables, table_name from (select page_id, trim(regexp_replace(regexp_replace(url, '[^\\x20-\\x7E\\t\\n\\r]+', ' ', 'g'), '\\s+', ' ', 'g')) as table_name from pages) p""")
def raw_pages_without_tables(c):
    site = c.dealt("pages").select("page_id", F.col("url").alias("title"), "html")
    return pages.parsed_pages(site).select("page_id", F.size("page.tables").cast("long").alias("tables"), "page.metadata.table_name")


@query("select row_ord, source_field_name, target_field_name from @colspecs where source_field_name <> '' or target_field_name <> ''")
def keep_named_rows(c):
    return pages.keep_named_rows(c["colspecs"]).select("row_ord", "source_field_name", "target_field_name")


@query("select row_ord, source_field_name from @colspecs where lower(trim(add_source_to_target)) = 'yes'")
def columns_to_map(c):
    return pages.columns_to_map(c["colspecs"]).select("row_ord", "source_field_name")


@query("""select page_id, api_title, parsed_json from (select page_id, api_title from @page_metadata where extraction_status = 'PARSED_OK' and user_verified) m
 join (select c_custkey as page_id, '{"page_id":' || cast(c_custkey as varchar) || '}' as parsed_json from customer) p using (page_id)""")
def mappable_pages(c):
    content = c["customer"].select(F.col("c_custkey").alias("page_id"),
                                   F.concat(F.lit('{"page_id":'), "c_custkey", F.lit("}")).alias("parsed_json"))
    return ingest.mappable(c["page_metadata"], content).select("page_id", "api_title", "parsed_json")


_TRIMMED = """select page_id, cast(row_number() over (partition by page_id order by row_ord) as bigint) - 1 as row_ord, trim(source_table) as source_table, source_field_name,
 target_field_name, data_type, trim(add_source_to_target) as add_source_to_target, is_primary_key, definition, comments from @colspecs"""


@query(_TRIMMED)
def declared_columns_from_pages(c):
    records = pages.primary_table(ingest.explode_parsed(pages.to_parsed_json(c.dealt("spec_pages"))))
    return pages.colspecs(records).withColumn("row_ord", F.col("row_ord").cast("long"))

"""Inputs derived from the driver's tables.

Each recipe is SQL valid in Spark and in DuckDB (``d`` supplies the few spellings
that differ); ``@name`` stands for a driver table or another recipe. Pages hold
blocks of 20 consecutive parts or orders, so a page is bounded at any scale.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations"]

AS_OF = "2025-01-15 12:00:00"
ENVIRONMENTS = ["DEV", "SPC", "BFM", "PRU"]  # names of the recipes' environments


class SparkText:
    @staticmethod
    def sha(x: str) -> str:
        return f"sha2({x}, 256)"

    @staticmethod
    def joined(x: str, order: str, sep: str = "") -> str:
        return f"array_join(transform(array_sort(collect_list(struct({order} as o, {x} as r))), z -> z.r), '{sep}')"


class DuckText:
    @staticmethod
    def sha(x: str) -> str:
        return f"sha256({x})"

    @staticmethod
    def joined(x: str, order: str, sep: str = "") -> str:
        return f"string_agg({x}, '{sep}' order by {order})"


def _block(column: str, size: int = 20) -> str:
    return f"cast(floor({column} / {size}) as bigint)"


def colspecs(d):
    return f"""
select page_id, p_partkey as row_ord,
 case when p_size % 9 = 0 then '' when p_size % 2 = 0 then 'src_' || cast(page_id as string)
  else ' SRC_' || cast(page_id as string) || ' ' end as source_table,
 upper(replace(p_name, ' ', '_')) as source_field_name,
 lower(replace(p_name, ' ', '_')) || '_' || cast(p_partkey as string) as target_field_name,
 case p_size % 12 when 0 then 'varchar(128)' when 1 then 'NUMBER(38, 0)' when 2 then 'integer' when 3 then 'Float or Number'
  when 4 then 'BIGINT' when 5 then 'VARCHAR(12' when 6 then 'FLOAT' when 7 then 'datetime' when 8 then ''
  when 9 then 'money' when 10 then 'timestamp' else 'bool' end as data_type,
 case when p_partkey % 3 = 0 then 'Yes' when p_partkey % 3 = 1 then ' no' else '' end as add_source_to_target,
 case when p_partkey % 10 = 0 then 'yes' else '' end as is_primary_key,
 p_type as definition, p_brand as comments
from (select *, {_block('p_partkey')} as page_id from @part) p"""


def resolver(d):
    return f"""
select case when k % 7 = 3 then 'LEGACY_' else 'SRC_' end || cast(k as string) as source_name, env,
 'DB_' || cast(k % 50 as string) || '.SCH.T_' || cast(k as string) || case when env = 'PRU' then '_P' else '' end as fqdn,
 case when k % 7 = 0 then 'VIEW' else 'TABLE' end as object_type
from (select distinct {_block('p_partkey')} as k,
  case p_size % 12 when 0 then 'DEV' when 1 then 'SPC' when 2 then 'BFM' when 3 then 'PRU' else 'OLD' end as env from @part) p"""


def inventory(d):
    return f"""
select env, case when l_orderkey % 2 = 0 then db else lower(db) end as db_name, 'SCH' as schema_name,
 't_' || cast(k as string) || case when env = 'PRU' then '_p' else '' end as object_name,
 case when k % 7 = 0 then 'VIEW' else 'BASE TABLE' end as table_type
from (select l_orderkey, k,
  case l_linenumber when 1 then 'DEV' when 2 then 'SPC' when 3 then 'BFM' when 4 then 'PRU' else 'OLD' end as env,
  'DB_' || cast(k % 50 + case when k % 3 = l_linenumber % 3 then 100 else 0 end as string) as db
  from (select l_orderkey, l_linenumber, {_block('l_partkey')} as k from @lineitem) l) m"""


def titles(d):
    return f"""
select p_partkey as ord, case p_partkey % 6 when 0 then 'Table: ' || n when 1 then 'Table : ' || n when 2 then 'Table:' || n
 when 3 then 'Table:  ' || n when 4 then '  Table: ' || n || ' ' else 'Missing: ' || n end as given_title
from (select p_partkey, 'Unit ' || cast({_block('p_partkey', 12)} as string) as n from @part) p"""


def wiki_pages(d):
    return f"""
select p_partkey as page_id, case k % 3 when 0 then 'Table: Unit ' || cast(k as string)
 when 1 then 'Table : Unit ' || cast(k as string) else 'Table:Unit' || cast(k as string) end as title
from (select p_partkey, {_block('p_partkey', 12)} as k from @part) p"""


def prev_report(d):
    return """
select distinct given_title, case when n % 4 = 0 then 'MISS' else 'HIT' end as status,
 case when n % 4 = 0 then null else 'Old ' || given_title end as found_title,
 case when n % 4 = 0 then null else 7000000 + n end as page_id, 'earlier' as notes,
 timestamp '2024-03-01 00:00:00' as first_checked_on, timestamp '2024-04-01 00:00:00' as last_checked_on,
 n % 3 = 0 as user_verified, cast(1 as int) as attempts_made
from (select case when n % 5 = 4 then 'Unlisted ' || given_title else given_title end as given_title, n
 from (select given_title, cast(length(given_title) + min(ord) as bigint) as n from @titles group by given_title) t) t"""


def page_docs(d):
    return """
select c_custkey as page_id,
 case when c_custkey % 17 = 5 then null when c_custkey % 17 = 6 then '{"title": broken' else
 '{"title":"' || c_name || ' é","type":"page","status":"current","history":{"createdBy":{"displayName":"N ' || c_mktsegment ||
 '"' || case when c_custkey % 5 = 0 then '' else ',"username":"u' || cast(c_nationkey as string) || '"' end ||
 '},"createdDate":"2023-01-02T00:00:00Z","lastUpdated":{"by":{"displayName":"M","username":"m' || cast(c_custkey % 7 as string) ||
 '"},"when":"2024-02-0' || cast(1 + c_custkey % 9 as string) || 'T00:00:00Z"}},"metadata":{"labels":{"results":[' ||
 case c_custkey % 3 when 0 then '' when 1 then '{"name":"zeta"},{"name":""},{"name":"alpha"}' else '{"name":"' || lower(c_mktsegment) || '"}' end ||
 ']}},"ancestors":[' || case when c_custkey % 4 = 0 then '' else '{"id":"1","title":"Root"},{"id":"' || cast(c_nationkey + 100 as string) ||
 '","title":"Nation ' || cast(c_nationkey as string) || '"}' end || ']' ||
 case when c_custkey % 11 = 0 then '' else ',"body":{"storage":{"value":"<p>' || c_mktsegment || '</p>"}}' end || '}' end as doc_json
from @customer"""


def doc_fields(d):
    """What page_docs holds, as columns; null where the document is missing or broken."""
    return """
select c_custkey as page_id, c_custkey % 17 <> 5 as present, c_custkey % 17 not in (5, 6) as ok,
 case when c_custkey % 17 not in (5, 6) then c_name || ' é' end as api_title,
 case when c_custkey % 17 not in (5, 6) then 'N ' || c_mktsegment end as created_by_display_name,
 case when c_custkey % 17 not in (5, 6) and c_custkey % 5 <> 0 then 'u' || cast(c_nationkey as string) end as created_by_username,
 case when c_custkey % 17 not in (5, 6) then '2023-01-02T00:00:00Z' end as created_date,
 case when c_custkey % 17 not in (5, 6) then 'm' || cast(c_custkey % 7 as string) end as last_modified_by_username,
 case when c_custkey % 17 not in (5, 6) then '2024-02-0' || cast(1 + c_custkey % 9 as string) || 'T00:00:00Z' end as last_modified_date,
 case when c_custkey % 17 not in (5, 6) and c_custkey % 4 <> 0 then 'Nation ' || cast(c_nationkey as string) end as parent_page_title,
 case when c_custkey % 17 not in (5, 6) and c_custkey % 4 <> 0 then cast(c_nationkey + 100 as bigint) end as parent_page_id,
 case when c_custkey % 17 in (5, 6) or c_custkey % 3 = 0 then '[]' when c_custkey % 3 = 1 then '["zeta", "alpha"]'
  else '["' || lower(c_mktsegment) || '"]' end as labels,
 case when c_custkey % 17 in (5, 6) or c_custkey % 3 = 0 then '[]' when c_custkey % 3 = 1 then '["alpha", "zeta"]'
  else '["' || lower(c_mktsegment) || '"]' end as sorted_labels
from @customer"""


def doc_hashes(d):
    joined = " || '|' || ".join(f"coalesce(cast({c} as string), 'None')" for c in (
        "created_by_username", "created_date", "last_modified_by_username", "last_modified_date", "parent_page_id"))
    return f"select page_id, present, ok, {d.sha(joined + ' || ' + repr('|') + ' || sorted_labels')} as hash_id from @doc_fields"


def verified_report(d):
    return """
select c_name as given_title, case when c_custkey % 13 = 0 then 'MISS' else 'HIT' end as status, c_name || ' found' as found_title,
 case when c_custkey % 29 = 1 then null else c_custkey end as page_id, case when c_custkey % 2 = 0 then 'checked' else '' end as notes,
 timestamp '2024-03-01 00:00:00' as first_checked_on, timestamp '2024-04-01 00:00:00' as last_checked_on,
 c_custkey % 10 <> 3 as user_verified, cast(1 + c_custkey % 5 as int) as attempts_made
from @customer
union all
select c_name || ' again', 'HIT', c_name || ' found again', c_custkey, 'second title of the page', timestamp '2024-03-02 00:00:00', timestamp '2024-04-01 00:00:00', true, cast(2 as int)
from @customer where c_custkey % 7 = 2"""


def page_metadata(d):
    """Stored metadata of an earlier run: some hashes are current, some old, some missing."""
    return """
select f.page_id + case when c_nationkey < 20 then 0 else 10000000 end as page_id, c_name as given_title, c_name || ' found' as found_title, 'HIT' as page_status, c_custkey % 10 <> 3 as user_verified,
 cast(1 as int) as attempts_made, f.api_title, cast('page' as string) as api_type, cast('current' as string) as api_status,
 cast('M' as string) as last_modified_by_display_name, f.last_modified_by_username, f.last_modified_date,
 f.created_by_display_name, f.created_by_username, f.created_date, f.parent_page_title, f.parent_page_id, f.labels,
 timestamp '2024-03-01 00:00:00' as first_checked_on, timestamp '2024-03-01 00:00:00' as last_checked_on,
 case c_custkey % 8 when 0 then 'PARSE_FAILED' when 1 then 'METADATA_INGESTED' when 2 then 'DB_FAILED' else 'PARSED_OK' end as extraction_status,
 case when c_custkey % 6 = 0 then null when c_custkey % 6 = 1 then 'stale' else h.hash_id end as hash_id,
 case when c_custkey % 8 = 1 then null when c_custkey % 8 = 5 then 'older' when c_custkey % 6 = 1 then 'stale' else h.hash_id end as last_parsed_content_hash,
 cast('f' || cast(c_custkey as string) || '.json' as string) as structured_data_file, cast('' as string) as notes
from @customer c join @doc_fields f on c.c_custkey = f.page_id join @doc_hashes h on c.c_custkey = h.page_id"""


def snapshots(d):
    """DDL snapshots per object over time; error events are absent objects, signup events exist without DDL."""
    return """
select 'DB.SCH.T' || cast(user_id as string) as fqdn,
 case user_id % 2 when 0 then case when event_id % 2 = 0 then 'DEV' else 'SPC' end else case when event_id % 3 = 0 then 'BFM' else 'PRU' end end as env,
 'TABLE' as object_type, ts as checked_on, event_id, event_type <> 'error' as obj_exists,
 case when event_type not in ('error', 'signup') then 'create or replace TABLE T' || cast(user_id as string) || ' (\nID NUMBER(38,0) NOT NULL,\nV' ||
  cast(event_id % 3 as string) || ' VARCHAR(' || cast(16 * (1 + event_id % 2) as string) || ') DEFAULT \\'a,b\\',\nW TIMESTAMP_LTZ(3) DEFAULT CAST(\\'0001-01-01\\' AS TIMESTAMP_LTZ(3))' ||
  case when event_id % 4 = 0 then ',\nprimary key (ID)' else '' end || '\n);' end as ddl
from @events""".replace("\\'", "''")


def order_pages(d):
    """Pages with labels, a full table of orders, a rowless table and a table of awkward rows."""
    row = ("'<tr><td>' || cast(o_orderkey as string) || '</td><td>' || o_orderstatus || '</td><td> ' || o_orderpriority || "
           "'&nbsp;</td></tr>'")
    odd = ("case o_orderkey % 4 when 0 then '<tr><td></td><td> </td><td></td></tr>' "
           "when 1 then '<tr><th>x</th><td>' || o_orderstatus || '</td></tr>' when 2 then '<tr><th>only head</th></tr>' "
           "else '<tr><td><b>' || o_orderstatus || '</b><br>&amp; more</td><td>Yes</td><td>last</td></tr>' end")
    return f"""
select page_id, 'Table: Block ' || cast(page_id as string) as title,
 '<html><body><script>var t = "<table>";</script><h1>Orders</h1>' || case when page_id % 3 = 0 then '' else
  '<p>Table name: <b>T ' || cast(page_id as string) || '</b></p>' end ||
 '<p>Schema name: S' || cast(page_id % 5 as string) || '</p><div>Database name: D Historization: SCD-2</div><p>Primary Keys: a, ,b</p>' ||
 '<table><tbody><tr><th>Order Key</th><th>Status?</th><th>Order-Priority</th></tr>' || body || '</tbody></table><table></table>' ||
 '<table><tr><th>Kind</th><td>Deprecated</td><th>kind</th></tr>' || odd || '</table></body></html>' as html
from (select page_id, {d.joined(row, 'o_orderkey')} as body, {d.joined(odd, 'o_orderkey')} as odd
 from (select *, {_block('o_orderkey')} as page_id from @orders) o group by page_id) p"""


def spec_pages(d):
    """Definition pages: the declared columns of every page as an HTML table."""
    cells = ["source_table", "source_field_name", "add_source_to_target", "target_field_name", "data_type", "is_primary_key", "definition", "comments"]
    row = "'<tr>' || " + " || ".join(f"'<td>' || {c} || '</td>'" for c in cells) + " || '</tr>'"
    return f"""
select page_id, 'Page ' || cast(page_id as string) as title, '<h1>Definition</h1><table><tr><th>Source table</th><th>Source field name</th><th>Add Source To Target?</th>' ||
 '<th>Target field name</th><th>Data-type</th><th>Primary Key</th><th>Definition</th><th>Comments</th></tr>' || body || '</table>' as html
from (select page_id, {d.joined(row, 'row_ord')} as body from @colspecs group by page_id) p"""


def page_columns(d):
    """Physical columns behind each page: close, shortened, prefixed and foreign names."""
    return f"""
select page_id, p_partkey, case p_partkey % 5 when 0 then n when 1 then n || '_ID' when 2 then replace(n, 'E', '')
 when 3 then 'X_' || n else 'COL_' || cast(p_partkey as string) end as name
from (select {_block('p_partkey')} as page_id, p_partkey, upper(replace(p_name, ' ', '_')) as n from @part) p"""


def page_ddl(d):
    return f"""
select page_id, 'create or replace TABLE T_' || cast(page_id as string) || ' (' ||
 {d.joined("name || ' VARCHAR(16)'", 'p_partkey', ', ')} || ');' as ddl from @page_columns group by page_id"""


def ddl_state(d):
    """Stored DDL of every resolver object; some objects have none."""
    return f"""
select r.fqdn, r.env, r.object_type, 'DB' as db_name, 'SCH' as schema_name, 'T' as object_name, r.page_id % 6 <> 1 as obj_exists,
 case when r.page_id % 6 <> 1 then {d.sha('p.ddl')} end as current_ddl_hash, case when r.page_id % 6 <> 1 then p.ddl end as current_ddl,
 timestamp '2024-05-01 00:00:00' as last_extracted_on, cast(null as string) as previous_ddl_hash, cast(null as string) as previous_ddl,
 timestamp '2024-05-01 00:00:00' as ddl_changed_on, timestamp '2024-05-01 00:00:00' as last_checked_on, '' as notes
from (select *, cast(replace(replace(source_name, 'LEGACY_', ''), 'SRC_', '') as bigint) as page_id from @resolver) r
 join @page_ddl p on r.page_id = p.page_id"""


def prev_map(d):
    """Mappings of an earlier run: overridden, still good, out of date, and orphaned ones."""
    return f"""
select c.page_id, 'Page ' || cast(c.page_id as string) as page_title, c.source_field_name,
 case when c.row_ord % 18 = 12 then 'gone_' || cast(c.row_ord as string) else c.target_field_name end as target_field_name,
 c.data_type, 'VARCHAR' as resolved_type, false as is_primary_key, '' as definition, '' as comments,
 r.fqdn, r.env, r.object_type, 'OLD_MATCH' as matched_column, cast(91.5 as double) as match_score, 'RATIO' as match_strategy,
 case when c.row_ord % 4 = 0 then 'MAPPED_FUZZY' else 'UNMAPPED_LOW_SCORE' end as mapping_status,
 case when c.row_ord % 8 = 0 then 'old' else s.current_ddl_hash end as ddl_hash_at_mapping,
 timestamp '2024-05-01 00:00:00' as last_mapped_on, 'earlier' as notes, c.row_ord % 5 = 0 as user_override, true as is_active
from (select * from @colspecs where add_source_to_target = 'Yes') c
 join @resolver r on r.source_name = 'SRC_' || cast(c.page_id as string)
 join @ddl_state s on s.fqdn = r.fqdn and s.env = r.env and s.object_type = r.object_type"""


def resolver_entries(d):
    """Resolver entries as JSON text, one per supplier, with every kind of fault among them."""
    return """
select s_suppkey as entry_ord, case when k % 40 = 11 then lower(name) when k % 40 = 12 then 'AKA_' || cast(k - 2 as string) else name end as entry_key,
 case when k % 40 = 13 then '"just text"' else
 '{' || case when k % 40 = 14 then '"aliases":"AKA",' when k % 40 = 15 then '"aliases":["OK_' || cast(k as string) || '",7],'
   else '"aliases":["aka_' || cast(case when k % 40 = 16 then k - 1 when k % 40 = 17 then k - 5 else k end as string) || '"],' end ||
 case when k % 40 = 18 then '' when k % 40 = 19 then '"defaults":{"environments":["DEV"]},' when k % 40 = 20 then '"defaults":{"fqdn":"A.B.C"},'
   when k % 40 = 21 then '"defaults":{"environments":["dev","SPC"],"fqdn":"A.B"},' when k % 40 = 22 then '"defaults":{"environments":"DEV","fqdn":"A.B.C"},'
   else '"defaults":{"environments":["dev","SPC","BFM"],"fqdn":"db_' || cast(s_nationkey as string) || '.sch.t_' || cast(k as string) || '"},' end ||
 case when k % 40 = 23 then '"specific_environments":{"PRU":{"object_type":"view"}}' when k % 40 = 18 then '"specific_environments":{}'
   when k % 40 = 24 then '"specific_environments":{"PRU":{"fqdn":"X.Y.Z.W"}}' when k % 4 = 1 then '"specific_environments":{"Spc":{"fqdn":"own.sch.v_' || cast(k as string) || '","object_type":"view"}}'
   else '"note":1' end || '}' end as entry_json
from (select s_suppkey, s_nationkey, s_suppkey as k, 'SUP_' || cast(s_suppkey - case when s_suppkey % 40 = 11 then 1 else 0 end as string) as name from @supplier) s"""


def type_map_raw(d):
    """A type map as written: keys differing by case, some blank values."""
    return """
select case when p_partkey % 2 = 0 then lower(k) else k end as map_key, case when k like '%7' then ' ' else v end as map_value, min(p_partkey) as n
from (select p_partkey, p_brand || '_' || cast(p_size as string) as k, 'VARCHAR(' || cast(p_size as string) || ')' as v from @part) p group by 1, 2"""


def type_map(d):
    """The shipped type map restricted to the base types that declared columns use."""
    return """
select distinct case data_type when 'varchar(128)' then 'VARCHAR' when 'timestamp' then 'TIMESTAMP' when 'bool' then 'BOOLEAN'
 when 'integer' then 'INTEGER' else 'NUMBER' end as declared_type,
 case data_type when 'varchar(128)' then 'VARCHAR' when 'timestamp' then 'TIMESTAMP_LTZ' when 'bool' then 'BOOLEAN' else 'NUMBER' end as warehouse_type
from @colspecs where data_type in ('varchar(128)', 'timestamp', 'bool', 'integer', 'BIGINT', 'NUMBER(38, 0)')"""


RECIPES = {f.__name__: f for f in (
    colspecs, resolver, inventory, titles, wiki_pages, prev_report, page_docs, doc_fields, doc_hashes, verified_report,
    page_metadata, snapshots, order_pages, spec_pages, page_columns, page_ddl, ddl_state, prev_map, resolver_entries, type_map_raw, type_map)}

_NAME = re.compile(r"@(\w+)")


def frame(spark: SparkSession, sf_dir: str, name: str, made: dict[str, DataFrame] | None = None) -> DataFrame:
    """A driver table or a recipe as DataFrame; ``made`` keeps those a query has built already."""
    made = {} if made is None else made
    if name not in made:
        made[name] = (spark.read.parquet(f"{sf_dir}/{name}.parquet") if name in TABLES
                      else _spark_sql(spark, sf_dir, RECIPES[name](SparkText), made))
    return made[name]


def _spark_sql(spark: SparkSession, sf_dir: str, text: str, made: dict[str, DataFrame]) -> DataFrame:
    text = text.replace("timestamp '", "timestamp_ntz '")
    used = {n: frame(spark, sf_dir, n, made) for n in set(_NAME.findall(text))}
    if " join " in text:  # recipes join tables that all grow: no side is collected in the driver
        used = {n: df.hint("merge") for n, df in used.items()}
    return spark.sql(_NAME.sub(r"{\1}", text.replace("{", "{{").replace("}", "}}")), **used)


def duck_sql(text: str) -> str:
    """Comparison SQL with every recipe put in as a subquery."""
    return _NAME.sub(lambda m: m[1] if m[1] in TABLES else f"({duck_sql(RECIPES[m[1]](DuckText))})", text)

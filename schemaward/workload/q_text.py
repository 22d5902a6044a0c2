"""Queries over scalar text and type expressions."""

from __future__ import annotations

from pyspark.sql import functions as F

from schemaward.functions import text as X
from schemaward.functions.hashing import ddl_hash
from schemaward.functions.types import canonical_type, parse_type, resolve_types
from schemaward.operators import declared_types
from schemaward.workload.registry import query

_VARIANTS = """
select ord, given_title, flat, tight, dense, wide from (select *, trim(regexp_replace(replace(flat, ':', ' : '), '\\s+', ' ', 'g')) as wide,
 replace(replace(flat, ' : ', ': '), ':  ', ': ') as tight, replace(given_title, ' ', '') as dense
 from (select *, trim(regexp_replace(given_title, '\\s+', ' ', 'g')) as flat from @titles) t) t"""


@query(f"""select ord, array_to_string(list_filter([given_title, case when flat <> given_title then flat end, case when tight <> flat then tight end,
 case when dense <> given_title then dense end, case when wide not in (given_title, flat, tight) then wide end], lambda x: x is not null), '|') as variants
 from ({_VARIANTS}) v""")
def title_variants(c):
    return c["titles"].select("ord", F.array_join(X.title_variants(F.col("given_title")), "|").alias("variants"))


@query(r"""select doc_id, trim(regexp_replace(regexp_replace(text, '[^\x20-\x7E\t\n\r]+', ' ', 'g'), '\s+', ' ', 'g')) as cleaned from documents""")
def clean_text(c):
    return c["documents"].select("doc_id", X.clean_text(F.col("text")).alias("cleaned"))


@query(r"""select conv_id, turn, trim(regexp_replace(regexp_replace(text, '[^\x20-\x7E\t\n\r]+', ' ', 'g'), '\s+', ' ', 'g')) || '|' || role as listed,
 trim(regexp_replace(regexp_replace(text, '[^\x20-\x7E\t\n\r]+', ' ', 'g'), '\s+', ' ', 'g')) as mapped from conversations""")
def clean_nested(c):
    mapped = X.clean_map(F.create_map(F.lit("té xt"), F.col("text")))
    return c["conversations"].select("conv_id", "turn", F.array_join(X.clean_array(F.array("text", "role")), "|").alias("listed"),
                                     mapped["té xt"].alias("mapped"))


@query("""select p_partkey, lower(replace(replace(replace(p_name || '-Is PK?', '?', ''), '-', '_'), ' ', '_')) as header_key,
 p_size % 2 = 0 as flag, case when p_size % 3 = 0 then '' else p_brand end as cell, case when p_size % 2 = 0 then 'true' else 'false' end as flag_cell from part""")
def header_keys_and_flags(c):
    yes = F.when(F.col("p_size") % 2 == 0, "Yes").when(F.col("p_size") % 3 == 0, "no")
    return c["part"].select(
        "p_partkey", X.header_key(F.concat("p_name", F.lit("-Is PK?"))).alias("header_key"), X.is_yes(yes).alias("flag"),
        X.cell_default(F.when(F.col("p_size") % 3 != 0, F.col("p_brand")), F.lit("comments")).alias("cell"),
        X.cell_default(yes, F.lit("deprecated")).alias("flag_cell"))


@query("""select s_suppkey, s_name as database_name, s_name || ' Historization' as table_label,
 case when s_suppkey % 2 = 0 then 'a|' || s_name else '' end as keys, regexp_replace(lower(replace(s_name || ' (x)', ' ', '_')), '[^a-z0-9_.-]', '', 'g') as file_key,
 case when s_suppkey % 2 = 0 then 'Set' else s_name end as table_name, case when s_suppkey % 3 = 0 then 'x | late' else 'x' end as notes from supplier""")
def label_values_and_keys(c):
    text = F.concat(F.lit("Intro Database name: "), "s_name", F.lit(" Historization: SCD-2 "))
    even = F.col("s_suppkey") % 2 == 0
    return c["supplier"].select(
        "s_suppkey", X.label_value(text, "Database name:").alias("database_name"),
        X.label_value(F.concat(F.lit("Table name:"), "s_name", F.lit(" Historization ")), "Table name:").alias("table_label"),
        F.array_join(X.key_list(F.when(even, F.concat(F.lit(" a,, "), "s_name", F.lit(" ")))), "|").alias("keys"),
        X.file_key(F.concat("s_name", F.lit(" (x)"))).alias("file_key"),
        X.table_name_or_title(F.when(even, "Set").otherwise(""), F.concat(F.lit("Table: "), "s_name")).alias("table_name"),
        X.add_note(F.lit("x"), F.when(F.col("s_suppkey") % 3 == 0, F.lit("late"))).alias("notes"))


@query(r"""select page_id, array_to_string(list_filter(string_split(replace(replace(
 regexp_replace(replace(replace(replace(shown, '&quot;', '"'), '&middot;', '·'), '&copy;', '©'), '&amp;?', '&', 'g'), chr(10), ' '), chr(9), ' '), ' '), lambda w: w <> ''), ' ') as body
 from (select page_id, array_to_string(list_transform(string_split(array_to_string(list_transform(string_split(html, '<script'), lambda y, i: case when i = 1 then y
 when instr(y, '</script>') = 0 then '' else ' ' || substr(y, instr(y, '</script>') + 9) end), ''), '<'), lambda x: case when starts_with(x, 'style') then ''
 when starts_with(x, '!--') then substr(x, instr(x, '-->') + 3) else substr(x, instr(x, '>') + 1) end), ' ') as shown from pages) p""")
def cell_text(c):
    return c.dealt("pages").select("page_id", X.cell_text(F.col("html")).alias("body"))


@query("""select p_partkey, p_brand || ' & ' || p_name || ' ' || case p_size % 4 when 0 then '<é>' when 1 then '€' when 2 then '—' else '&unknown;' end
 || ' ' || chr(200 + p_size) || ' ' || p_type || ' end' as body from part""")
def cell_text_awkward(c):
    mark = F.element_at(F.array(F.lit("&lt;&eacute;&gt;"), F.lit("&#128;"), F.lit("&mdash;"), F.lit("&unknown;")), (F.col("p_size") % 4 + 1).cast("int"))
    html = F.concat(F.lit("<TD title='a > b'><script>if (1 < 2) { x = '<p>' }</script>"), "p_brand", F.lit(" &amp; "), "p_name", F.lit("<!-- <b>no</b> --><br/>"), mark,
                    F.lit("&nbsp;<style>p {}</style>&#"), (F.col("p_size") + 200).cast("string"), F.lit(";<b class=\"x>y\">"), "p_type", F.lit("</b><![CDATA[end]]></TD>"))
    return c.dealt("part").select("p_partkey", X.cell_text(html).alias("body"))


@query("select event_id, case when ddl <> '' then sha256(ddl) end as ddl_hash from @snapshots")
def ddl_hash_of_snapshots(c):
    return c["snapshots"].select("event_id", ddl_hash(F.col("ddl")).alias("ddl_hash"))


_CLEAN = "trim(replace(upper(data_type), 'FLOAT OR NUMBER', 'NUMBER'))"
_BASE = f"trim(regexp_extract({_CLEAN}, '^([A-Z0-9_ ]*)', 1))"
_CANON = f"""case {_BASE} when 'BIGINT' then 'NUMBER' when 'BOOL' then 'BOOLEAN' when 'DATETIME' then 'TIMESTAMP_NTZ' else {_BASE} end"""


@query(f"""select row_ord, {_BASE} as base, {_CANON} as canonical, nullif(regexp_replace(regexp_extract({_CLEAN}, '\\(([^()]*)\\)', 1), '\\s+', '', 'g'), '') as params,
 data_type <> 'VARCHAR(12' as balanced from @colspecs""")
def parse_declared_types(c):
    t = c["colspecs"].select("row_ord", parse_type(F.col("data_type")).alias("t"))
    return t.select("row_ord", "t.base", canonical_type(F.col("t.base")).alias("canonical"), "t.params", "t.balanced")


_RESOLVED = """case data_type when 'varchar(128)' then 'VARCHAR(128)' when 'NUMBER(38, 0)' then 'NUMBER(38,0)' when 'integer' then 'NUMBER(38,0)'
 when 'Float or Number' then 'NUMBER(38,0)' when 'BIGINT' then 'NUMBER(38,0)' when 'timestamp' then 'TIMESTAMP_LTZ' when 'bool' then 'BOOLEAN'
 else 'VARCHAR(16777216)' end"""
_CATEGORY = """case data_type when 'VARCHAR(12' then 'MALFORMED' when 'money' then 'MALFORMED' when 'FLOAT' then 'UNMAPPED' when 'datetime' then 'UNMAPPED'
 when '' then 'MISSING' else 'MAPPED' end"""


@query(f"""select row_ord, data_type, {_RESOLVED} as resolved_type, {_CATEGORY} as category,
 cast(case when data_type = 'VARCHAR(12' then 2 when {_CATEGORY} = 'MAPPED' then 0 else 1 end as bigint) as warnings from @colspecs""")
def resolve_declared_types(c):
    return resolve_types(c["colspecs"], c["type_map"]).select(
        "row_ord", "data_type", "resolved_type", F.col("type_category").alias("category"),
        F.size("type_warnings").cast("long").alias("warnings"))


_TITLED = "coalesce(nullif(api_title, ''), found_title, 'Page ID:' || cast(c.page_id as varchar))"


@query(f"select distinct data_type, {_TITLED} as page_title from @colspecs c left join @page_metadata m on c.page_id = m.page_id where data_type <> ''")
def types_by_page(c):
    return declared_types.types_by_page(c["colspecs"], c["page_metadata"])


@query(f"""select data_type, cast(floor((n - 1) / 50) as bigint) as part, total, string_agg(page_title, '|' order by page_title) as titles
 from (select *, row_number() over (partition by data_type order by page_title) as n, count(*) over (partition by data_type) as total
  from (select distinct data_type, {_TITLED} as page_title from @colspecs c left join @page_metadata m on c.page_id = m.page_id where data_type <> '') t) u
 group by data_type, part, total""")
def types_by_page_lists(c):
    lists = declared_types.types_by_page_lists(c["colspecs"], c["page_metadata"], items=50)
    return lists.select("data_type", "part", "total", F.array_join("items", "|").alias("titles"))


@query(f"""select data_type, count(*) as pages, any_value({_RESOLVED}) as resolved_type, any_value({_CATEGORY}) as category
 from (select distinct data_type, {_TITLED} as page_title from @colspecs c left join @page_metadata m on c.page_id = m.page_id where data_type <> '') t group by data_type""")
def declared_type_report(c):
    return declared_types.type_report(c["colspecs"], c["page_metadata"], c["type_map"]).drop("notes")


@query(f"select row_ord, {_TITLED} as page_title from @colspecs c left join @page_metadata m on c.page_id = m.page_id")
def page_title_lookup(c):
    from schemaward.operators.ingest import with_title
    return with_title(c["colspecs"].select("page_id", "row_ord"), c["page_metadata"]).select("row_ord", "page_title")

"""Queries over titles, the hit/miss report, page metadata and keyed state."""

from __future__ import annotations

from pyspark.sql import functions as F

from schemaward import schemas as S
from schemaward.operators import ingest, merge, titles
from schemaward.plans import jobs
from schemaward.workload.inputs import AS_OF
from schemaward.workload.q_text import _VARIANTS
from schemaward.plans.buckets import BucketedState
from schemaward.session import shared_dir
from schemaward.workload.registry import query

_TRIED = f"""select given_title, attempt, variant from (select distinct given_title,
 list_filter([given_title, case when flat <> given_title then flat end, case when tight <> flat then tight end,
 case when dense <> given_title then dense end, case when wide not in (given_title, flat, tight) then wide end], lambda x: x is not null) as v
 from ({_VARIANTS}) x) t, lateral (select unnest(v) as variant, unnest(range(1, len(v) + 1)) as attempt) u"""
_FOUND = f"""select given_title, case when min(page_id) is null then 'MISS' else 'HIT' end as status,
 arg_min(variant, case when page_id is not null then attempt end) as found_title, arg_min(page_id, case when page_id is not null then attempt end) as page_id,
 coalesce(min(case when page_id is not null then attempt end), count(*)) as attempts_made, count(*) as tried
 from ({_TRIED}) t left join (select title, min(page_id) as page_id from @wiki_pages group by title) p on t.variant = p.title group by given_title"""
_NOTED = f"""select given_title, status, found_title, page_id, attempts_made, case when status = 'HIT' then 'Matched using variation: ''' || found_title || ''''
 else 'Page not found after all ' || cast(tried as varchar) || ' variations.' end as notes from ({_FOUND}) f"""


@query(f"select t.ord, t.given_title, f.status, f.found_title, f.page_id, f.notes, f.attempts_made from @titles t join ({_NOTED}) f on t.given_title = f.given_title")
def resolve_titles(c):
    return titles.resolve_titles(c["titles"], c["wiki_pages"]).withColumn("attempts_made", F.col("attempts_made").cast("long"))


_FROZEN = "coalesce(p.status = 'HIT' and p.user_verified, false)"


@query(f"""select t.ord, t.given_title, case when {_FROZEN} then p.status else f.status end as status, case when {_FROZEN} then p.found_title else f.found_title end as found_title,
 case when {_FROZEN} then p.page_id else f.page_id end as page_id, case when {_FROZEN} then p.notes else f.notes end as notes,
 case when {_FROZEN} then p.attempts_made else f.attempts_made end as attempts_made,
 coalesce(p.first_checked_on, timestamp '{AS_OF}') as first_checked_on, timestamp '{AS_OF}' as last_checked_on,
 coalesce(a.user_verified, p.user_verified, false) as user_verified
 from @titles t join ({_NOTED}) f on t.given_title = f.given_title left join @prev_report p on t.given_title = p.given_title
 left join (select distinct given_title, true as user_verified from @titles where given_title like 'Table:%') a on t.given_title = a.given_title""")
def hit_miss_report(c):
    reviewed = c["titles"].where(F.col("given_title").like("Table:%")).select("given_title", F.lit(True).alias("user_verified")).distinct()
    report = jobs.find_pages(c["titles"], c["wiki_pages"], c["prev_report"], AS_OF, reviewed)
    return report.withColumn("attempts_made", F.col("attempts_made").cast("long"))


@query("select given_title, page_id from @verified_report where status = 'HIT' and user_verified and page_id is not null")
def approved_pages(c):
    return titles.with_page_id(titles.approved(c["verified_report"])).select("given_title", "page_id")


@query("select status, user_verified, count(*) as n from @verified_report group by 1, 2")
def report_status_counts(c):
    return titles.status_counts(c["verified_report"], "status", "user_verified")


@query("select page_id, hash_id from @doc_hashes where ok")
def metadata_hashes(c):
    flat = ingest.flatten_page_docs(c["page_docs"]).where("doc_ok")
    return flat.select("page_id", ingest.page_hash().alias("hash_id"))


_INGEST = """select r.page_id, r.given_title, case when ok then f.api_title else m.api_title end as api_title_raw,
 case when not present or present is null then 'API_FAILED_METADATA' when not ok then 'METADATA_INGEST_FAILED'
  when m.extraction_status = 'PARSED_OK' and h.hash_id = m.hash_id then 'PARSED_OK' else 'METADATA_INGESTED' end as extraction_status,
 case when ok then h.hash_id end as hash_id, m.last_parsed_content_hash,
 case when not present then concat_ws(' | ', nullif(r.notes, ''), 'API error fetching metadata') when not ok then concat_ws(' | ', nullif(r.notes, ''), 'Error during metadata ingestion') else r.notes end as notes,
 case when ok then f.labels else m.labels end as labels
 from @verified_report r left join (select page_id, present, ok, api_title, labels from @doc_fields) f on r.page_id = f.page_id
 left join @doc_hashes h0 on false left join (select page_id, hash_id from @doc_hashes) h on r.page_id = h.page_id left join @page_metadata m on r.page_id = m.page_id
 where r.status = 'HIT' and r.user_verified and r.page_id is not null
 qualify row_number() over (partition by r.page_id order by r.last_checked_on desc, r.given_title desc) = 1""".replace(" left join @doc_hashes h0 on false", "").replace(
    "case when not present or present is null then", "case when not f.present then")


@query(f"""select page_id, given_title, trim(regexp_replace(regexp_replace(api_title_raw, '[^\\x20-\\x7E]+', ' ', 'g'), '\\s+', ' ', 'g')) as api_title,
 extraction_status, hash_id, last_parsed_content_hash, notes, labels from ({_INGEST}) i
 union all select page_id, given_title, api_title, extraction_status, hash_id, last_parsed_content_hash, notes, labels from @page_metadata
 where page_id not in (select page_id from @verified_report where status = 'HIT' and user_verified and page_id is not null)""")
def ingest_metadata(c):
    return ingest.ingest_metadata(c["page_metadata"], c["page_docs"], c["verified_report"], AS_OF).select(
        "page_id", "given_title", "api_title", "extraction_status", "hash_id", "last_parsed_content_hash", "notes", "labels")


_QUEUE = """select * from @page_metadata where user_verified and (hash_id is distinct from last_parsed_content_hash or last_parsed_content_hash is null
 or extraction_status in ('PENDING_PARSE', 'PARSE_FAILED', 'API_FAILED_CONTENT', 'DB_FAILED'))"""


@query(f"select page_id, extraction_status, hash_id, last_parsed_content_hash from ({_QUEUE}) q")
def parse_queue(c):
    return ingest.parse_queue(c["page_metadata"]).select("page_id", "extraction_status", "hash_id", "last_parsed_content_hash")


_OUTCOME = """select q.page_id, case when doc_json is null then 'API_FAILED_CONTENT' when q.page_id % 17 = 6 or q.page_id % 11 = 0 then 'PARSE_FAILED' else 'PARSED_OK' end as status
 from ({q}) q left join @page_docs d on q.page_id = d.page_id""".replace("{q}", _QUEUE)


@query(f"""select m.page_id, coalesce(o.status, m.extraction_status) as extraction_status,
 case when o.status = 'PARSED_OK' then m.hash_id else m.last_parsed_content_hash end as last_parsed_content_hash,
 case when o.status = 'PARSED_OK' then regexp_replace(lower(trim(regexp_replace(m.api_title, '[^\\x20-\\x7E]', '', 'g'))), '[^a-z0-9_.-]', '', 'g') || '.json' else m.structured_data_file end as structured_data_file,
 case o.status when 'API_FAILED_CONTENT' then 'API error fetching content' when 'PARSE_FAILED' then 'Content parsing/access error: no body content found' else '' end as notes
 from @page_metadata m left join ({_OUTCOME}) o on m.page_id = o.page_id""")
def parse_results(c):
    empty = c["page_metadata"].sparkSession.createDataFrame([], S.PARSED_CONTENT)
    meta, _ = jobs.parse_run(c["page_metadata"], c["page_docs"], empty, AS_OF)
    return meta.select("page_id", "extraction_status", "last_parsed_content_hash", "structured_data_file", "notes")


@query(f"""select c_custkey as page_id, case when o.status = 'PARSED_OK' then '{{"page_title":"' || c_name || '","page_id":' || cast(c_custkey as varchar) || ',"metadata":{{"table_name":"' || c_name ||
 '","schema_name":null,"database_name":null,"primary_keys":[],"foreign_keys":[]}},"tables":[]}}' else '{{}}' end as parsed_json,
 case when o.status = 'PARSED_OK' then timestamp '{AS_OF}' else timestamp '2024-01-01 00:00:00' end as parsed_date
 from customer c left join ({_OUTCOME}) o on c.c_custkey = o.page_id""")
def stored_parsed_content(c):
    before = c["customer"].select(F.col("c_custkey").alias("page_id"), F.lit("{}").alias("parsed_json"),
                                  F.lit("2024-01-01 00:00:00").cast("timestamp_ntz").alias("parsed_date"))
    return jobs.parse_run(c["page_metadata"], c["page_docs"], before, AS_OF)[1]


# keyed merges: orders are the state, line items bring changed and new keys
_STATE = "select o_orderkey, o_orderstatus, o_totalprice, o_orderpriority from orders"
_DELTA = """select case when l_orderkey % 4 = 0 then l_orderkey + 1000000000 else l_orderkey end as o_orderkey, 'N' as o_orderstatus,
 max(case when l_orderkey % 3 <> 0 then l_extendedprice end) as o_totalprice from lineitem group by 1"""


def _state(c):
    return c["orders"].select("o_orderkey", "o_orderstatus", "o_totalprice", "o_orderpriority")


def _delta(c):
    key = F.when(F.col("l_orderkey") % 4 == 0, F.col("l_orderkey") + 1000000000).otherwise(F.col("l_orderkey"))
    price = F.max(F.when(F.col("l_orderkey") % 3 != 0, F.col("l_extendedprice")))
    return c["lineitem"].groupBy(key.alias("o_orderkey")).agg(F.lit("N").alias("o_orderstatus"), price.alias("o_totalprice"))


_UPSERTED = f"""select coalesce(s.o_orderkey, d.o_orderkey) as o_orderkey, case when d.o_orderkey is not null then d.o_orderstatus else s.o_orderstatus end as o_orderstatus,
 case when d.o_orderkey is not null then d.o_totalprice else s.o_totalprice end as o_totalprice, s.o_orderpriority
 from ({_STATE}) s full join ({_DELTA}) d on s.o_orderkey = d.o_orderkey"""


@query(_UPSERTED)
def upsert_in_buckets(c):
    state = BucketedState.create(_state(c), shared_dir(c.spark), ["o_orderkey"], buckets=32)
    state.update(_delta(c), lambda rows, changes: merge.upsert(rows, changes, ["o_orderkey"]))
    return state.read()


@query(_UPSERTED)
def upsert_partial_columns(c):
    return merge.upsert(_state(c), _delta(c), ["o_orderkey"])


@query(f"""select coalesce(s.o_orderkey, d.o_orderkey) as o_orderkey, case when d.o_orderkey is not null then d.o_orderstatus else s.o_orderstatus end as o_orderstatus,
 case when d.o_totalprice is not null then d.o_totalprice else s.o_totalprice end as o_totalprice, s.o_orderpriority
 from ({_STATE}) s full join ({_DELTA}) d on s.o_orderkey = d.o_orderkey""")
def upsert_supplied_per_row(c):
    delta = _delta(c).withColumn("given", F.when(F.col("o_totalprice").isNull(), F.array(F.lit("o_orderstatus")))
                                 .otherwise(F.array(F.lit("o_orderstatus"), F.lit("o_totalprice"))))
    return merge.upsert(_state(c), delta, ["o_orderkey"], supplied="given")


@query(f"""select o_orderkey, o_orderstatus, o_totalprice from ({_DELTA}) d union all
 select o_orderkey, o_orderstatus, o_totalprice from ({_STATE}) s where o_orderkey not in (select o_orderkey from ({_DELTA}) d)""")
def replace_rows_by_key(c):
    return merge.replace_by_key(_state(c).drop("o_orderpriority"), _delta(c), ["o_orderkey"])


_MANY = """select case when l_orderkey % 4 = 0 then l_orderkey + 1000000000 else l_orderkey end as o_orderkey, 'L' || l_linenumber as o_orderstatus,
 case when l_linenumber % 3 <> 0 then l_extendedprice end as o_totalprice, l_linenumber as step from lineitem"""


def _many(c):
    key = F.when(F.col("l_orderkey") % 4 == 0, F.col("l_orderkey") + 1000000000).otherwise(F.col("l_orderkey"))
    return c["lineitem"].select(key.alias("o_orderkey"), F.concat(F.lit("L"), "l_linenumber").alias("o_orderstatus"),
                                F.when(F.col("l_linenumber") % 3 != 0, F.col("l_extendedprice")).alias("o_totalprice"), F.col("l_linenumber").alias("step"))


@query(f"""select coalesce(s.o_orderkey, d.o_orderkey) as o_orderkey, coalesce(d.o_orderstatus, s.o_orderstatus) as o_orderstatus,
 coalesce(d.o_totalprice, s.o_totalprice) as o_totalprice, s.o_orderpriority from ({_STATE}) s full join (select o_orderkey,
  arg_max(o_orderstatus, (step, o_orderstatus, o_totalprice)) as o_orderstatus, arg_max(o_totalprice, (step, o_totalprice)) filter (o_totalprice is not null) as o_totalprice
  from ({_MANY}) m group by o_orderkey) d on s.o_orderkey = d.o_orderkey""")
def upsert_repeated_keys(c):
    changes = _many(c).withColumn("given", F.when(F.col("o_totalprice").isNull(), F.array(F.lit("o_orderstatus"))).otherwise(F.array(F.lit("o_orderstatus"), F.lit("o_totalprice"))))
    return merge.upsert(_state(c), changes, ["o_orderkey"], supplied="given", order="step")


@query(f"""select o_orderkey, r.o_orderstatus as o_orderstatus, r.o_totalprice as o_totalprice from (select o_orderkey,
  arg_max({{'o_orderstatus': o_orderstatus, 'o_totalprice': o_totalprice}}, (step, o_orderstatus, coalesce(o_totalprice, 0))) as r from ({_MANY}) m group by o_orderkey) d
 union all select o_orderkey, o_orderstatus, o_totalprice from ({_STATE}) s where o_orderkey not in (select o_orderkey from ({_MANY}) m)""")
def replace_repeated_keys(c):
    return merge.replace_by_key(_state(c).drop("o_orderpriority"), _many(c), ["o_orderkey"], order="step")


@query("select page_id, row_ord from @colspecs where page_id not in (select page_id from @page_metadata)")
def orphan_page_rows(c):
    return merge.orphan_keys(c["colspecs"], c["page_metadata"], ["page_id"]).select("page_id", "row_ord")

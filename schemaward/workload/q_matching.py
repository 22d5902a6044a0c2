"""Queries over similarity scores and column mapping."""

from __future__ import annotations

from pyspark.sql import functions as F

from schemaward import schemas as S
from schemaward.functions import similarity as M
from schemaward.operators import matching, pages
from schemaward.plans import jobs
from schemaward.plans.buckets import BucketedState
from schemaward.session import shared_dir
from schemaward.workload.inputs import AS_OF, ENVIRONMENTS
from schemaward.workload.registry import query


def _lcs(a: str, b: str) -> str:
    """Longest common subsequence by the textbook table, row by row."""
    cell = (f"case when substr({a}, e[1], 1) = substr({b}, f[1], 1) then acc[f[1]] + 1 else greatest(acc[f[1] + 1], nr[len(nr)]) end")
    return (f"list_reduce(list_transform(range(1, length({a}) + 1), lambda i: [i]), lambda acc, e: list_reduce(list_transform(range(1, length({b}) + 1), lambda j: [j]), "
            f"lambda nr, f: list_append(nr, {cell}), [cast(0 as bigint)]), list_transform(range(0, length({b}) + 1), lambda i: cast(0 as bigint)))[length({b}) + 1]")


def _ratio(a: str, b: str) -> str:
    return f"case when length({a}) + length({b}) = 0 then 100.0 else 200.0 * {_lcs(a, b)} / (length({a}) + length({b})) end"


# two names per part: the declared one and its physical column, as words
_PAIRS = """select p_partkey, upper(p_name) || ' ' || p_type as a, case p_partkey % 4 when 0 then p_type || ' ' || upper(p_name) when 1 then upper(p_name)
 when 2 then replace(upper(p_name), 'E', '') || ' X' else upper(p_brand) end as b from @part"""


def _pairs(c):
    name = F.upper("p_name")
    b = (F.when(F.col("p_partkey") % 4 == 0, F.concat("p_type", F.lit(" "), name)).when(F.col("p_partkey") % 4 == 1, name)
         .when(F.col("p_partkey") % 4 == 2, F.concat(F.replace(name, F.lit("E"), F.lit("")), F.lit(" X"))).otherwise(F.upper("p_brand")))
    return c["part"].select("p_partkey", F.concat(name, F.lit(" "), "p_type").alias("a"), b.alias("b"))


def _scored(c, fn):
    """Each distinct pair is scored once."""
    pairs = _pairs(c)
    scores = pairs.select("a", "b").distinct().withColumn("score", F.round(fn(F.col("a"), F.col("b")), 6))
    return pairs.join(scores, ["a", "b"]).select("p_partkey", "score")


def _score_sql(score: str, extra: str = "") -> str:
    return f"""select p_partkey, round(score, 6) as score from ({_PAIRS}) p join (select a, b, {score} as score from
 (select *, {extra or '1 as one'} from (select distinct a, b from ({_PAIRS}) q) d) d) s using (a, b)"""


_SORTED = "array_to_string(list_sort(string_split(trim(a), ' ')), ' ') as sa, array_to_string(list_sort(string_split(trim(b), ' ')), ' ') as sb"
_SETS = ("array_to_string(list_sort(list_intersect(string_split(a, ' '), string_split(b, ' '))), ' ') as i, "
         "array_to_string(list_sort(list_filter(list_distinct(string_split(a, ' ')), lambda x: not list_contains(string_split(b, ' '), x))), ' ') as da, "
         "array_to_string(list_sort(list_filter(list_distinct(string_split(b, ' ')), lambda x: not list_contains(string_split(a, ' '), x))), ' ') as db")
_TOKEN_SET = (f"case when i <> '' and (da = '' or db = '') then 100.0 else greatest({_ratio('trim(i || chr(32) || da)', 'trim(i || chr(32) || db)')}, "
              f"case when i = '' then 0 else greatest({_ratio('i', 'trim(i || chr(32) || da)')}, {_ratio('i', 'trim(i || chr(32) || db)')}) end) end")


@query(_score_sql(_ratio("a", "b")))
def sim_ratio(c):
    return _scored(c, M.sim_ratio)


@query(_score_sql(f"case when a = '' or b = '' then 0 else {_ratio('a', 'b')} end"))
def sim_quick_ratio(c):
    return _scored(c, M.sim_qratio)


@query(_score_sql(_ratio("sa", "sb"), _SORTED))
def sim_token_sort(c):
    return _scored(c, M.sim_token_sort)


@query(_score_sql(_TOKEN_SET, _SETS))
def sim_token_set(c):
    return _scored(c, M.sim_token_set)


def _partial(x: str, y: str) -> str:
    """Best ratio of the shorter text against every window of the longer one, clipped at both ends."""
    s = f"(case when length({x}) <= length({y}) then {x} else {y} end)"
    g = f"(case when length({x}) <= length({y}) then {y} else {x} end)"
    win = f"substr({g}, greatest(k, 1), least(k + length({s}) - 1, length({g})) - greatest(k, 1) + 1)"
    # lists of windows first, so that the subsequence table is spelled once
    return f"list_transform(range(2 - length({s}), length({g}) + 1), lambda k: {win}) as wins, {s} as short"


_PARTIAL_ROWS = f"""select a, b, max(score) as score from (select a, b, {_ratio('short', 'w')} as score from (select a, b, short, unnest(wins) as w from (select a, b, {_partial('a', 'b')} from (select distinct a, b from ({_PAIRS}) q) d) e) f
 union all select a, b, {_ratio('short', 'w')} from (select a, b, short, unnest(wins) as w from (select a, b, {_partial('b', 'a')} from (select distinct a, b from ({_PAIRS}) q where length(a) = length(b)) d) e) f) g group by a, b"""


@query(f"select p_partkey, round(score, 6) as score from ({_PAIRS}) p join ({_PARTIAL_ROWS}) s using (a, b)")
def sim_partial(c):
    return _scored(c, M.sim_partial)


_LONGER = "greatest(length(a), length(b)) / cast(least(length(a), length(b)) as double)"
_PART_TOKENS = f"""select a, b, case when list_has_any(string_split(a, ' '), string_split(b, ' ')) then 100.0 else max(score) end as score from (
 select a, b, {_ratio('short', 'w')} as score from (select a, b, short, unnest(wins) as w from (select a, b, {_partial('sa', 'sb')} from (select a, b, {_SORTED} from (select distinct a, b from ({_PAIRS}) q) d) d) e) f
 union all select a, b, {_ratio('short', 'w')} from (select a, b, short, unnest(wins) as w from (select a, b, {_partial('sb', 'sa')} from (select a, b, {_SORTED} from (select distinct a, b from ({_PAIRS}) q) d where length(a) = length(b)) d) e) f) g group by a, b"""
_WRATIO = f"""select d.a, d.b, case when {_LONGER.replace('(a)', '(d.a)').replace('(b)', '(d.b)')} < 1.5 then greatest(r.score, 0.95 * greatest(ts.score, tt.score))
 else greatest(r.score, p.score * case when {_LONGER.replace('(a)', '(d.a)').replace('(b)', '(d.b)')} < 8 then 0.9 else 0.6 end,
  0.95 * pt.score * case when {_LONGER.replace('(a)', '(d.a)').replace('(b)', '(d.b)')} < 8 then 0.9 else 0.6 end) end as score
 from (select distinct a, b from ({_PAIRS}) q) d join (select a, b, {_ratio('a', 'b')} as score from (select distinct a, b from ({_PAIRS}) q) x) r using (a, b)
 join (select a, b, {_ratio('sa', 'sb')} as score from (select a, b, {_SORTED} from (select distinct a, b from ({_PAIRS}) q) x) x) ts using (a, b)
 join (select a, b, {_TOKEN_SET} as score from (select a, b, {_SETS} from (select distinct a, b from ({_PAIRS}) q) x) x) tt using (a, b)
 join ({_PARTIAL_ROWS}) p using (a, b) join ({_PART_TOKENS}) pt using (a, b)"""


@query(f"select p_partkey, round(score, 6) as score from ({_PAIRS}) p join ({_WRATIO}) s using (a, b)")
def sim_weighted_ratio(c):
    return _scored(c, M.sim_wratio)


# --- mapping ------------------------------------------------------------------

_SOURCE = "select page_id, upper(trim(arg_min(source_table, row_ord))) as source_name from @colspecs where source_table <> '' group by page_id"
_OBJECTS = f"""select s.page_id, r.fqdn, r.env, r.object_type, d.current_ddl_hash, d.current_ddl, p.page_id as ddl_page from ({_SOURCE}) s
 join @resolver r on r.source_name = s.source_name and r.env in ('DEV', 'SPC', 'BFM', 'PRU')
 join @ddl_state d on d.fqdn = r.fqdn and d.env = r.env and d.object_type = r.object_type and d.current_ddl is not null
 join @page_ddl p on p.ddl = d.current_ddl"""


def _objects(c):
    return matching.with_current_ddl(matching.page_objects(c["colspecs"], ENVIRONMENTS, c["resolver"]), c["ddl_state"])


@query(_SOURCE)
def first_source_of_page(c):
    return matching.first_source(c["colspecs"])


@query(f"select page_id, fqdn, env, object_type, current_ddl_hash from ({_OBJECTS}) o")
def objects_with_ddl(c):
    return _objects(c).drop("current_ddl")


@query(f"""select s.page_id, r.fqdn, r.env, r.object_type from ({_SOURCE}) s join @resolver r on r.source_name = s.source_name and r.env in ('DEV', 'SPC', 'BFM', 'PRU')
 join @ddl_state d on d.fqdn = r.fqdn and d.env = r.env and d.object_type = r.object_type and d.current_ddl is null""")
def objects_without_ddl(c):
    grid = matching.page_objects(c["colspecs"], ENVIRONMENTS, c["resolver"])
    return matching.without_ddl(grid, c["ddl_state"]).select("page_id", *S.OBJECT_KEY)


@query(f"""with s as ({_SOURCE}), p as (select page_id, max(case when add_source_to_target = 'Yes' then 1 else 0 end) as f from @colspecs group by page_id),
 g as (select s.page_id, s.source_name, e.env from s, (select unnest(['DEV', 'SPC', 'BFM', 'PRU']) as env) e where s.source_name in (select source_name from @resolver)),
 o as (select g.page_id, g.env, r.fqdn, r.object_type from g left join @resolver r on r.source_name = g.source_name and r.env = g.env),
 d as (select o.*, x.current_ddl from o left join @ddl_state x on x.fqdn = o.fqdn and x.env = o.env and x.object_type = o.object_type and x.current_ddl <> '' and x.current_ddl_hash <> '')
 select page_id, cast(null as varchar) as env, 'NO_FLAGGED_COLUMNS' as reason from p where f = 0
 union select page_id, null, 'NO_SOURCE_TABLE' from p where page_id not in (select page_id from s)
 union select page_id, null, 'SOURCE_UNKNOWN' from s where source_name not in (select source_name from @resolver)
 union select page_id, env, 'NO_OBJECT' from o where fqdn is null
 union select page_id, env, 'NO_DDL' from d where fqdn is not null and current_ddl is null
 union select page_id, env, 'NO_DDL_COLUMNS' from d where current_ddl is not null and not contains(upper(current_ddl), 'TABLE')""")
def mapping_skips(c):
    return matching.mapping_skips(c["colspecs"], ENVIRONMENTS, c["resolver"], c["ddl_state"])


@query(f"""select c.row_ord, o.fqdn, o.env, cast(n.choices as bigint) as choices from @colspecs c join ({_OBJECTS}) o on c.page_id = o.page_id
 join (select page_id, count(*) as choices from @page_columns group by page_id) n on n.page_id = o.ddl_page where c.add_source_to_target = 'Yes'""")
def match_candidates(c):
    return matching.match_candidates(c["colspecs"], _objects(c)).select(
        "row_ord", "fqdn", "env", F.size("choices").cast("long").alias("choices"))


@query(f"""select c.page_id, c.target_field_name, o.fqdn, o.env, p.mapping_status as old_status, p.user_override as old_override from @colspecs c join ({_OBJECTS}) o on c.page_id = o.page_id
 left join @prev_map p on p.page_id = c.page_id and p.target_field_name = c.target_field_name and p.fqdn = o.fqdn and p.env = o.env and p.object_type = o.object_type""")
def previous_mappings(c):
    now = c["colspecs"].select("page_id", "target_field_name").join(_objects(c).drop("current_ddl", "current_ddl_hash"), "page_id")
    return matching.with_prev_map(now, c["prev_map"]).select(
        "page_id", "target_field_name", "fqdn", "env", F.col("old.mapping_status").alias("old_status"), F.col("old.user_override").alias("old_override"))


# best match per declared name and page, first in DDL order on ties
_BEST = f"""select name, ddl_page, matched_column, score from (
 select name, ddl_page, c.name_2 as matched_column, s.score, row_number() over (partition by name, ddl_page order by s.score desc, c.p_partkey) as n from
 (select distinct source_field_name as name, o.ddl_page from @colspecs c join ({_OBJECTS}) o on c.page_id = o.page_id where add_source_to_target = 'Yes') w
 join (select page_id, p_partkey, name as name_2 from @page_columns) c on c.page_id = w.ddl_page
 join (select a, b, {_ratio('a', 'b')} as score from (select distinct c.source_field_name as a, p.name as b from @colspecs c join @page_columns p on c.page_id = p.page_id
  where add_source_to_target = 'Yes') d) s on s.a = w.name and s.b = c.name_2 where s.score >= 80) z where n = 1"""


@query(f"select name, cast(ddl_page as bigint) as page_id, matched_column, round(score, 6) as score from ({_BEST}) b")
def best_matches(c):
    objects = _objects(c)
    wanted = matching.columns_to_map(c["colspecs"]).join(objects.select("page_id", "current_ddl_hash").distinct(), "page_id")
    best = matching.best_matches(wanted, matching.choices_by_ddl(objects), matching.MatchSettings(strategy="RATIO"))
    used = objects.select("page_id", "current_ddl_hash").distinct()
    return best.where("matched_column is not null").join(used, "current_ddl_hash").select(
        "name", "page_id", "matched_column", F.round("match_score", 6).alias("score"))


_MAPPED = f"""select c.page_id, c.target_field_name, o.fqdn, o.env, o.object_type, o.current_ddl_hash, coalesce(p.user_override, false) as user_override,
 coalesce(p.user_override or (p.ddl_hash_at_mapping = o.current_ddl_hash and p.mapping_status in ('MAPPED_EXACT', 'MAPPED_FUZZY')), false) as kept,
 p.matched_column as old_column, p.match_score as old_score, p.mapping_status as old_status, p.match_strategy as old_strategy, b.matched_column, b.score
 from (select * from @colspecs where add_source_to_target = 'Yes') c join ({_OBJECTS}) o on c.page_id = o.page_id
 left join @prev_map p on p.page_id = c.page_id and p.target_field_name = c.target_field_name and p.fqdn = o.fqdn and p.env = o.env and p.object_type = o.object_type
 left join ({_BEST}) b on b.name = c.source_field_name and b.ddl_page = o.ddl_page"""
_NEW_MAP = f"""select page_id, target_field_name, fqdn, env, object_type, case when kept then old_column else matched_column end as matched_column,
 round(case when kept then old_score else score end, 6) as match_score, case when kept then old_strategy when score is not null then 'TOKEN_SET_RATIO' end as match_strategy,
 case when kept then old_status when score is null then 'UNMAPPED_LOW_SCORE' when score = 100 then 'MAPPED_EXACT' else 'MAPPED_FUZZY' end as mapping_status,
 user_override, true as is_active, timestamp '{AS_OF}' as last_mapped_on from ({_MAPPED}) m"""
_REST = f"""select p.* from @prev_map p left join ({_NEW_MAP}) n on p.page_id = n.page_id and p.target_field_name = n.target_field_name and p.fqdn = n.fqdn and p.env = n.env and p.object_type = n.object_type where n.page_id is null"""
_OUT = ["page_id", "target_field_name", "fqdn", "env", "object_type", "matched_column", "match_score", "match_strategy", "mapping_status",
        "user_override", "is_active", "last_mapped_on"]


def _out(df):
    return df.withColumn("match_score", F.round("match_score", 6)).select(*_OUT)


@query(f"select {', '.join(_OUT)} from ({_NEW_MAP}) n union all select {', '.join(_OUT)} from ({_REST}) r")
def map_columns(c):
    names = c["colspecs"].select("page_id", F.concat(F.lit("Page "), "page_id").alias("page_title")).distinct()
    return _out(matching.map_columns(c["colspecs"], _objects(c), c["prev_map"], names, c["type_map"], AS_OF))


_ORPHANS = f"""select p.* from @prev_map p where exists (select 1 from ({_OBJECTS}) o where o.page_id = p.page_id and o.fqdn = p.fqdn and o.env = p.env and o.object_type = p.object_type)
 and not exists (select 1 from @colspecs c where c.page_id = p.page_id and c.target_field_name = p.target_field_name)"""


@query(f"select page_id, target_field_name, fqdn, env, user_override from ({_ORPHANS}) o")
def orphan_mappings(c):
    return matching.orphan_mappings(c["prev_map"], c["colspecs"], _objects(c)).select(
        "page_id", "target_field_name", "fqdn", "env", "user_override")


_DEACTIVATED = f"""select p.page_id, p.target_field_name, p.fqdn, p.env, case when o.page_id is not null and not p.user_override then 'INACTIVE_ORPHANED' else p.mapping_status end as mapping_status,
 o.page_id is null or p.user_override as is_active, case when o.page_id is not null then timestamp '{AS_OF}' else p.last_mapped_on end as last_mapped_on
 from @prev_map p left join ({_ORPHANS}) o on p.page_id = o.page_id and p.target_field_name = o.target_field_name and p.fqdn = o.fqdn and p.env = o.env and p.object_type = o.object_type"""
_DEACTIVATED_COLUMNS = ["page_id", "target_field_name", "fqdn", "env", "mapping_status", "is_active", "last_mapped_on"]


@query(_DEACTIVATED)
def deactivate_orphans(c):
    return matching.deactivate_orphans(c["prev_map"], c["colspecs"], AS_OF, _objects(c)).select(*_DEACTIVATED_COLUMNS)


@query(_DEACTIVATED)
def deactivate_orphans_in_buckets(c):
    """The mapping state in buckets by page; only those of pages handled in this run are rewritten."""
    state = BucketedState.create(c["prev_map"], shared_dir(c.spark), ["page_id"], buckets=16)
    handled = _objects(c).select("page_id", *S.OBJECT_KEY)
    state.update(handled, lambda rows, objects: matching.deactivate_orphans(rows, c["colspecs"], AS_OF, objects))
    return state.read().select(*_DEACTIVATED_COLUMNS)


_JOB = f"""select {', '.join(_OUT)} from ({_NEW_MAP}) n union all
 select r.page_id, r.target_field_name, r.fqdn, r.env, r.object_type, r.matched_column, r.match_score, r.match_strategy,
  case when o.page_id is not null and not r.user_override then 'INACTIVE_ORPHANED' else r.mapping_status end, r.user_override, o.page_id is null or r.user_override,
  case when o.page_id is not null then timestamp '{AS_OF}' else r.last_mapped_on end
 from ({_REST}) r left join ({_ORPHANS}) o on r.page_id = o.page_id and r.target_field_name = o.target_field_name and r.fqdn = o.fqdn and r.env = o.env and r.object_type = o.object_type"""


@query(_JOB)
def mapping_job(c):
    names = c["colspecs"].select("page_id", F.concat(F.lit("Page "), "page_id").alias("page_title")).distinct()
    return _out(jobs.map_specs(c["colspecs"], names, c["resolver"], ENVIRONMENTS, c["ddl_state"], c["prev_map"], c["type_map"], AS_OF))


@query(_JOB)
def mapping_from_stored_pages(c):
    """From page HTML: parsed documents as stored content, then the mapping run over the state tables."""
    content = pages.to_parsed_json(c.dealt("spec_pages")).withColumn("parsed_date", F.lit(AS_OF).cast("timestamp_ntz"))
    meta = c["spec_pages"].select("page_id", F.col("title").alias("api_title"), F.lit("PARSED_OK").alias("extraction_status"),
                                  F.lit(True).alias("user_verified"))
    return _out(jobs.map_run(meta, content, c["resolver"], ENVIRONMENTS, c["ddl_state"], c["prev_map"], c["type_map"], AS_OF))

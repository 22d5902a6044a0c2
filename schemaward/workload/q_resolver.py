"""Queries over the resolver, its validation, and existence checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from schemaward import schemas as S
from schemaward.operators import catalog, resolver as R
from schemaward.plans import jobs
from schemaward.workload.inputs import AS_OF, ENVIRONMENTS
from schemaward.workload.registry import query

_ENVS = "(values ('DEV'), ('SPC'), ('BFM'), ('PRU')) e(env)"
_NAMES = "select distinct upper(trim(source_table)) as source_name from @colspecs where trim(source_table) <> ''"
_GRID = f"""select n.source_name, e.env, r.fqdn, r.object_type from ({_NAMES}) n cross join {_ENVS}
 left join @resolver r on r.source_name = n.source_name and r.env = e.env where n.source_name in (select source_name from @resolver)"""
_CHECKED = f"""select g.source_name, g.env, g.fqdn, g.object_type, coalesce(i.n, 0) > 0 as obj_exists from ({_GRID}) g left join
 (select env, upper(db_name || '.' || schema_name || '.' || object_name) as name, case when table_type = 'VIEW' then 'VIEW' else 'TABLE' end as kind, count(*) as n
  from @inventory group by 1, 2, 3) i on i.env = g.env and i.name = upper(g.fqdn) and i.kind = g.object_type where g.fqdn is not null"""

# resolver entries in SQL: final targets per entry
_OK_DEFAULT = "k % 40 not in (13, 18, 19, 20, 21, 22)"
_TARGETS = f"""select entry_ord, name, alias, env, fqdn, kind from (
 select s_suppkey as entry_ord, k, case when k % 40 = 12 then 'AKA_' || cast(k - 2 as varchar) else 'SUP_' || cast(k - case when k % 40 = 11 then 1 else 0 end as varchar) end as name,
  case when k % 40 = 14 then null when k % 40 = 15 then 'OK_' || cast(k as varchar) else 'AKA_' || cast(case when k % 40 = 16 then k - 1 when k % 40 = 17 then k - 5 else k end as varchar) end as alias,
  e.env, k % 4 = 1 and k % 40 not in (13, 18, 23, 24) as own, e.env in ('DEV', 'SPC', 'BFM') and {_OK_DEFAULT} as by_default,
  case when k % 4 = 1 and k % 40 not in (13, 18, 23, 24) and e.env = 'SPC' then 'OWN.SCH.V_' || cast(k as varchar)
   when e.env in ('DEV', 'SPC', 'BFM') and {_OK_DEFAULT} then 'DB_' || cast(s_nationkey as varchar) || '.SCH.T_' || cast(k as varchar) end as fqdn,
  case when k % 4 = 1 and k % 40 not in (13, 18, 23, 24) and e.env = 'SPC' then 'VIEW' else 'TABLE' end as kind
 from (select *, s_suppkey as k from supplier) s cross join {_ENVS}) x where fqdn is not null"""
_SIGNED = f"""select s.s_suppkey as entry_ord, n.name, n.is_alias, coalesce(g.sig, '') as sig from supplier s
 join (select s_suppkey, case when s_suppkey % 40 = 12 then 'AKA_' || cast(s_suppkey - 2 as varchar) else 'SUP_' || cast(s_suppkey - case when s_suppkey % 40 = 11 then 1 else 0 end as varchar) end as name, 0 as is_alias from supplier where s_suppkey % 40 <> 13
  union all select s_suppkey, case when s_suppkey % 40 = 15 then 'OK_' || cast(s_suppkey as varchar) else 'AKA_' || cast(case when s_suppkey % 40 = 16 then s_suppkey - 1 when s_suppkey % 40 = 17 then s_suppkey - 5 else s_suppkey end as varchar) end, 1 from supplier where s_suppkey % 40 not in (13, 14)) n
  on n.s_suppkey = s.s_suppkey
 left join (select entry_ord, string_agg(env || '=' || fqdn || '=' || kind, ';' order by env) as sig from ({_TARGETS}) t group by 1) g on g.entry_ord = s.s_suppkey"""


@query(f"select entry_ord, name as source_name, env, fqdn, kind as object_type from ({_TARGETS}) t")
def environment_overrides(c):
    return R.apply_overrides(c["resolver_entries"]).select("entry_ord", "source_name", F.inline("targets"))


@query(f"""select distinct name as source_name, env, fqdn, kind as object_type from ({_TARGETS}) t
 union select distinct alias, env, fqdn, kind from ({_TARGETS}) t where alias is not null""")
def flat_resolver(c):
    return R.load_resolver(c["resolver_entries"])


_KEY = "case when s_suppkey % 40 = 11 then lower('SUP_' || cast(s_suppkey - 1 as varchar)) when s_suppkey % 40 = 12 then 'AKA_' || cast(s_suppkey - 2 as varchar) else 'SUP_' || cast(s_suppkey as varchar) end"


@query(f"""select rule, {_KEY} as key, detail from supplier s join (values
 (13, 'V1', 'entry is not an object'), (19, 'V2', 'defaults need environments (list) and fqdn'), (20, 'V2', 'defaults need environments (list) and fqdn'),
 (22, 'V2', 'defaults need environments (list) and fqdn'), (21, 'V3', 'defaults: A.B'), (24, 'V3', 'PRU: X.Y.Z.W'), (23, 'V4', 'PRU: no fqdn'),
 (18, 'V5', 'no environment'), (14, 'V8', 'aliases is not a list'), (15, 'V8', 'alias is BIGINT')) f(pos, rule, detail) on s.s_suppkey % 40 = f.pos""")
def resolver_entry_faults(c):
    return R.entry_faults(c["resolver_entries"])


@query(f"""with u as ({_SIGNED}), a as (select name, sum(1 - is_alias) as keys, arg_min(sig, entry_ord * 2 + is_alias) as first_sig,
 min(case when is_alias = 1 then entry_ord end) as alias_at, max(case when is_alias = 0 then entry_ord end) as key_at from u group by name)
 select 'V6' as rule, name as key, 'defined ' || cast(keys as varchar) || ' times' as detail from a where keys > 1
 union all select 'V6', name, 'also an alias of an earlier entry' from a where key_at > alias_at
 union all select distinct 'V7', u.name, 'alias of entries with different targets' from u join a on u.name = a.name where is_alias = 1 and sig <> first_sig""")
def resolver_name_faults(c):
    return R.name_faults(c["resolver_entries"])


@query(f"select rule, count(*) as n from (select pos, rule from (values (13, 'V1'), (19, 'V2'), (20, 'V2'), (22, 'V2'), (21, 'V3'), (24, 'V3'), (23, 'V4'), (18, 'V5'), (14, 'V8'), (15, 'V8')) f(pos, rule)) f join supplier s on s.s_suppkey % 40 = f.pos group by rule"
       f" union all select 'V6', count(*) from (select name from ({_SIGNED}) u where is_alias = 0 group by name having count(*) > 1 union all"
       f" select name from ({_SIGNED}) u group by name having max(case when is_alias = 0 then entry_ord end) > min(case when is_alias = 1 then entry_ord end)) d having count(*) > 0"
       f" union all select 'V7', count(*) from (select distinct u.name from ({_SIGNED}) u join (select name, arg_min(sig, entry_ord * 2 + is_alias) as f from ({_SIGNED}) v group by name) a on u.name = a.name where is_alias = 1 and sig <> f) d having count(*) > 0")
def resolver_fault_counts(c):
    return R.validate_resolver(c["resolver_entries"]).groupBy("rule").agg(F.count("*").alias("n"))


@query(f"select upper(key) as key, count(*) as n from (select {_KEY} as key from supplier) s group by 1 having count(*) > 1")
def duplicate_resolver_keys(c):
    return R.dup_keys(c["resolver_entries"])


@query(f"select name as alias, count(distinct sig) as target_sets from ({_SIGNED}) u where is_alias = 1 group by name having count(distinct sig) > 1")
def alias_conflicts(c):
    return R.alias_conflicts(c["resolver_entries"])


@query("""select 'V9' as rule, upper(map_key) as key, 'empty value' as detail from @type_map_raw where trim(map_value) = ''
 union all select 'V10', upper(map_key), 'defined ' || cast(count(*) as varchar) || ' times' from @type_map_raw group by 2 having count(*) > 1""")
def type_map_faults(c):
    return R.validate_type_map(c["type_map_raw"])


@query(_NAMES)
def distinct_sources(c):
    return R.distinct_sources(c["colspecs"])


@query(f"select n.source_name, env, fqdn, object_type from ({_NAMES}) n join @resolver r on n.source_name = r.source_name")
def resolved_sources(c):
    return R.resolve_sources(R.distinct_sources(c["colspecs"]), c["resolver"])


@query(f"select source_name from ({_NAMES}) n where source_name not in (select source_name from @resolver)")
def unresolved_sources(c):
    return R.unresolved(R.distinct_sources(c["colspecs"]), c["resolver"])


@query(f"select source_name from ({_NAMES}) n except select source_name from @resolver")
def unresolved_by_difference(c):
    return R.unresolved_as_difference(R.distinct_sources(c["colspecs"]), c["resolver"])


_USED = f"select fqdn from @resolver where source_name in ({_NAMES})"
_UNUSED = f"select distinct source_name from @resolver where source_name not in (select source_name from @resolver where fqdn in ({_USED}))"


@query(_UNUSED)
def unused_resolver_entries(c):
    return R.unused_entries(c["resolver"], R.distinct_sources(c["colspecs"]))


@query(f"select source_name from ({_UNUSED}) u where source_name like 'SRC%'")
def unused_canonical_entries(c):
    canonical = c["resolver"].where("source_name like 'SRC%'").select("source_name")  # the recipe's other names are aliases
    return R.unused_entries(c["resolver"], R.distinct_sources(c["colspecs"]), canonical)


@query(_GRID)
def environment_grid(c):
    return R.env_grid(R.distinct_sources(c["colspecs"]), ENVIRONMENTS, c["resolver"])


_ITEMS = f"""select 'resolved_fqdns' as section, fqdn as item from (select distinct fqdn from ({_USED}) u) r
 union all select 'unresolved_sources', source_name from ({_NAMES}) n where source_name not in (select source_name from @resolver)
 union all select 'unused_entries', source_name from ({_UNUSED}) x"""


@query(_ITEMS)
def resolver_summary_items(c):
    return R.resolver_items(R.distinct_sources(c["colspecs"]), c["resolver"])


@query(f"""select section, cast(floor((n - 1) / 100) as bigint) as part, total, string_agg(item, '|' order by item) as items
 from (select *, row_number() over (partition by section order by item) as n, count(*) over (partition by section) as total from (select distinct * from ({_ITEMS}) i) d) r
 group by section, part, total""")
def resolver_summary_lists(c):
    lists = R.resolver_lists(R.distinct_sources(c["colspecs"]), c["resolver"], items=100)
    return lists.select("section", "part", "total", F.array_join("items", "|").alias("items"))


@query(f"select section, count(*) as n from ({_ITEMS}) i group by section")
def resolver_summary(c):
    return R.resolver_summary(R.distinct_sources(c["colspecs"]), c["resolver"])


@query(f"select count(*) as unresolved, count(*) = 0 as may_generate from ({_NAMES}) n where source_name not in (select source_name from @resolver)")
def generation_gate(c):
    return R.generation_gate(R.unresolved(R.distinct_sources(c["colspecs"]), c["resolver"]))


@query("""select env, db_name || '.' || schema_name || '.' || object_name as fqdn, db_name, schema_name, object_name,
 case when table_type = 'BASE TABLE' then 'TABLE' else table_type end as object_type from @inventory where db_name ilike 'db_1%' and schema_name ilike 's_h'""")
def discover_objects(c):
    return catalog.discover(c["inventory"], "db_1%", "s_h")


@query("""select source_name, env, fqdn, split_part(fqdn, '.', 1) as db_name, split_part(fqdn, '.', 2) as schema_name, split_part(fqdn, '.', 3) as object_name from @resolver""")
def split_object_names(c):
    return catalog.split_fqdn(c["resolver"].select("source_name", "env", "fqdn"))


@query("""select env, upper(db_name) as db_key, upper(schema_name) as schema_key, upper(object_name) as object_key, table_type as type_key, count(*) as n
 from @inventory group by 1, 2, 3, 4, 5""")
def object_counts(c):
    return catalog.object_counts(c["inventory"])


@query(_CHECKED)
def existence_check(c):
    checked = jobs.check_sources(c["colspecs"], c["resolver"], ENVIRONMENTS, c["inventory"])
    return checked.select("source_name", "env", "fqdn", "object_type", "obj_exists")


@query(f"select distinct env, fqdn, object_type, fqdn || ' (' || env || ', ' || object_type || ')' as label from ({_CHECKED}) x where not obj_exists")
def missing_objects(c):
    return catalog.missing_objects(jobs.check_sources(c["colspecs"], c["resolver"], ENVIRONMENTS, c["inventory"]))


# the check merged into an earlier state: stored DDL of every object, new DDL read for existing ones
_NEW_DDL = """select fqdn, env, object_type, replace(current_ddl, 'VARCHAR(16)', case when length(fqdn) % 2 = 0 then 'VARCHAR(32)' else 'VARCHAR(16)' end) as ddl from @ddl_state"""


@query(f"""select s.fqdn, s.env, s.object_type, coalesce(n.obj_exists, s.obj_exists) as obj_exists,
 case when n.fqdn is null then s.current_ddl_hash else sha256(n.ddl) end as current_ddl_hash,
 case when n.ddl is not null and sha256(n.ddl) is distinct from s.current_ddl_hash then s.current_ddl_hash else s.previous_ddl_hash end as previous_ddl_hash,
 case when n.ddl is not null and sha256(n.ddl) is distinct from s.current_ddl_hash or (n.obj_exists and not s.obj_exists) then timestamp '{AS_OF}' else s.ddl_changed_on end as ddl_changed_on,
 case when n.ddl is not null then timestamp '{AS_OF}' else s.last_extracted_on end as last_extracted_on,
 case when n.fqdn is not null then timestamp '{AS_OF}' else s.last_checked_on end as last_checked_on,
 case when n.fqdn is not null and not n.obj_exists then n.object_type || ' does not exist.' else '' end as notes
 from @ddl_state s left join (select distinct x.fqdn, x.env, x.object_type, x.obj_exists, case when x.obj_exists then d.ddl end as ddl
  from ({_CHECKED}) x left join ({_NEW_DDL}) d on x.fqdn = d.fqdn and x.env = d.env and x.object_type = d.object_type) n
  on s.fqdn = n.fqdn and s.env = n.env and s.object_type = n.object_type""")
def source_check_state(c):
    wide = F.replace("current_ddl", F.lit("VARCHAR(16)"), F.when(F.length("fqdn") % 2 == 0, "VARCHAR(32)").otherwise("VARCHAR(16)"))
    ddl = c["ddl_state"].select(*S.OBJECT_KEY, wide.alias("ddl"))
    return jobs.check_and_store(c["colspecs"], c["resolver"], ENVIRONMENTS, c["inventory"], ddl, c["ddl_state"], AS_OF).select(
        *S.OBJECT_KEY, "obj_exists", "current_ddl_hash", "previous_ddl_hash", "ddl_changed_on", "last_extracted_on", "last_checked_on", "notes")

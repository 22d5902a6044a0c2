"""Queries over DDL history, parity, differences and DDL columns."""

from __future__ import annotations

from pyspark.sql import functions as F

from schemaward import schemas as S
from schemaward.functions.ddl import ddl_columns
from schemaward.operators import ddl_history as H
from schemaward.operators import parity as P
from schemaward.operators import render
from schemaward.functions.types import resolve_types
from schemaward.functions.text import is_yes
from schemaward.plans.buckets import BucketedState
from schemaward.session import shared_dir
from schemaward.workload.inputs import AS_OF, ENVIRONMENTS
from schemaward.workload.registry import query

# snapshot rows with the fold state after each, in plain windows
_STEPS = """select fqdn, env, object_type, checked_on, event_id, obj_exists, ddl, h, is_change, changed, ph, pddl,
 last_value(case when changed then event_id end ignore nulls) over cum as was_at,
 last_value(case when is_change then checked_on end ignore nulls) over cum as ddl_changed_on,
 last_value(case when h is not null then checked_on end ignore nulls) over cum as last_extracted_on
 from (select *, h is not null and n > 1 and h is distinct from ph as changed,
   n = 1 or (h is not null and h is distinct from ph) or (not pe and obj_exists) as is_change
  from (select *, row_number() over w as n, lag(h) over w as ph, lag(ddl) over w as pddl, lag(obj_exists) over w as pe
   from (select *, case when ddl <> '' then sha256(ddl) end as h from @snapshots) s
   window w as (partition by fqdn, env, object_type order by checked_on, event_id)) a) b
 window cum as (partition by fqdn, env, object_type order by checked_on, event_id rows unbounded preceding)"""
_STEPS = f"""select s.*, w.ph as previous_ddl_hash, w.pddl as previous_ddl from ({_STEPS}) s left join
 (select event_id as at, ph, pddl from ({_STEPS}) z) w on s.was_at = w.at"""
_FOLDED = f"""select * from ({_STEPS}) s qualify row_number() over (partition by fqdn, env, object_type order by checked_on desc, event_id desc) = 1"""


@query(f"""select fqdn, env, checked_on, event_id, obj_exists, is_change, h as current_ddl_hash, previous_ddl_hash, ddl_changed_on, last_extracted_on from ({_STEPS}) s""")
def ddl_history(c):
    return H.ddl_history(c["snapshots"], tie="event_id").select(
        "fqdn", "env", "checked_on", "event_id", "obj_exists", "is_change", "current_ddl_hash", "previous_ddl_hash",
        "ddl_changed_on", "last_extracted_on")


_FOLD_COLUMNS = ["fqdn", "env", "object_type", "db_name", "object_name", "obj_exists", "current_ddl_hash", "current_ddl",
                 "previous_ddl_hash", "previous_ddl", "ddl_changed_on", "last_extracted_on", "last_checked_on"]
_FOLD_SQL = f"""select fqdn, env, object_type, 'DB' as db_name, split_part(fqdn, '.', 3) as object_name, obj_exists, h as current_ddl_hash, ddl as current_ddl,
 previous_ddl_hash, previous_ddl, ddl_changed_on, last_extracted_on, checked_on as last_checked_on from ({_FOLDED}) f"""


def _folded(c):
    return H.fold_ddl(c["snapshots"], tie="event_id")


@query(_FOLD_SQL)
def fold_ddl(c):
    return _folded(c).select(*_FOLD_COLUMNS)


@query(_FOLD_SQL)
def fold_ddl_split_hot_objects(c):
    return H.fold_ddl(c["snapshots"], hot_rows=40, tie="event_id").select(*_FOLD_COLUMNS)


@query(_FOLD_SQL)
def fold_ddl_in_increments(c):
    """Three stretches of time: each is folded into the stored summary of those before it."""
    snaps = c["snapshots"]
    at = F.unix_micros(F.col("checked_on").cast("timestamp"))
    low, high = snaps.agg(F.min(at), F.max(at)).first()
    stretch = F.floor((at - low) * 3 / (high - low + 1)) if low is not None else F.lit(0)
    summary = H.history_summary(snaps.where(stretch == 0), tie="event_id")
    for k in (1, 2):
        path = shared_dir(c.spark)
        summary.write.parquet(path)
        summary = H.advance_history(c.spark.read.parquet(path), snaps.where(stretch == k), tie="event_id")
    return H.state_of_summary(summary).select(*_FOLD_COLUMNS)


# one run merged into the folded state: every object re-read, half of them with a new text
_RUN = f"""select fqdn, env, object_type, length(fqdn) % 2 = 0 or obj_exists as e,
 case when length(fqdn) % 2 = 0 then 'create table R (ID NUMBER(38,0))' when obj_exists then ddl end as d from ({_FOLDED}) f where env <> 'BFM'
 union all select 'DB.SCH.N' || cast(c_custkey as varchar), 'DEV', 'TABLE', c_custkey % 2 = 0, case when c_custkey % 2 = 0 then 'create table N (ID NUMBER)' end from customer"""


_MERGED = f"""select coalesce(s.fqdn, n.fqdn) as fqdn, coalesce(s.env, n.env) as env, case when n.fqdn is null then s.obj_exists else n.e end as obj_exists,
 case when n.fqdn is null then s.h else sha256(n.d) end as current_ddl_hash,
 case when s.fqdn is null then null when n.d is not null and sha256(n.d) is distinct from s.h then s.h else s.previous_ddl_hash end as previous_ddl_hash,
 case when s.fqdn is null or (n.d is not null and sha256(n.d) is distinct from s.h) or (n.e and not s.obj_exists) then timestamp '{AS_OF}' else s.ddl_changed_on end as ddl_changed_on,
 case when n.d is not null then timestamp '{AS_OF}' else s.last_extracted_on end as last_extracted_on
 from ({_FOLDED}) s full join ({_RUN}) n on s.fqdn = n.fqdn and s.env = n.env"""
_MERGED_COLUMNS = ["fqdn", "env", "obj_exists", "current_ddl_hash", "previous_ddl_hash", "ddl_changed_on", "last_extracted_on"]


def _run_of(c, state):
    even = F.length("fqdn") % 2 == 0
    again = state.where("env <> 'BFM'").select(
        *S.OBJECT_KEY, (even | F.col("obj_exists")).alias("obj_exists"),
        F.when(even, "create table R (ID NUMBER(38,0))").when(F.col("obj_exists"), F.col("current_ddl")).alias("ddl"))
    there = F.col("c_custkey") % 2 == 0
    new = c["customer"].select(
        F.concat(F.lit("DB.SCH.N"), "c_custkey").alias("fqdn"), F.lit("DEV").alias("env"), F.lit("TABLE").alias("object_type"),
        there.alias("obj_exists"), F.when(there, "create table N (ID NUMBER)").alias("ddl"))
    return again.unionByName(new).select("*", F.lit("DB").alias("db_name"), F.lit("SCH").alias("schema_name"),
                                        F.lit("X").alias("object_name"), F.lit("").alias("notes"))


@query(_MERGED)
def merge_ddl_run(c):
    state = _folded(c)
    return H.merge_ddl(state, _run_of(c, state), AS_OF).select(*_MERGED_COLUMNS)


@query(_MERGED)
def merge_ddl_run_in_buckets(c):
    """The state in buckets by name; the buckets that the run checks are read, merged and written."""
    state = BucketedState.create(_folded(c), shared_dir(c.spark), ["fqdn"], buckets=16)
    run = _run_of(c, state.read())
    state.update(run, lambda rows, new: H.merge_ddl(rows, new, AS_OF))
    return state.read().select(*_MERGED_COLUMNS)


_CHANGED = f"select * from ({_FOLDED}) f where h is not null and previous_ddl_hash is not null and h <> previous_ddl_hash"


@query(f"select fqdn, env, object_type, previous_ddl_hash, h as current_ddl_hash, ddl_changed_on from ({_CHANGED}) x")
def internal_changes(c):
    return P.ordered(H.internal_changes(_folded(c)).select(*S.OBJECT_KEY, "previous_ddl_hash", "current_ddl_hash", "ddl_changed_on"))


@query(f"""with p as (select fqdn, env, previous_ddl as a, ddl as b from ({_CHANGED}) x),
 l as (select fqdn, env, unnest(string_split(a, chr(10))) as line, -1 as side from p union all select fqdn, env, unnest(string_split(b, chr(10))), 1 from p)
 select fqdn, env, case when sum(side) < 0 then '-' else '+' end as sign, line, cast(abs(sum(side)) as bigint) as copies from l group by fqdn, env, line having sum(side) <> 0""")
def changed_lines(c):
    return P.line_diff(H.internal_changes(_folded(c)), ["fqdn", "env"], "previous_ddl", "current_ddl")


@query(f"""select coalesce(a.fqdn, b.fqdn) as fqdn, coalesce(a.object_type, b.object_type) as object_type,
 case when a.fqdn is null then 'MISSING_IN_SOURCE' when b.fqdn is null then 'MISSING_IN_TARGET' when a.h is not distinct from b.h then 'MATCH' else 'DDL_HASH_MISMATCH' end as status,
 a.h as source_hash, b.h as target_hash from (select * from ({_FOLDED}) f where env = 'DEV' and obj_exists) a
 full join (select * from ({_FOLDED}) f where env = 'SPC' and obj_exists) b on a.fqdn = b.fqdn and a.object_type = b.object_type""")
def environment_parity(c):
    return P.env_parity(_folded(c), "DEV", "SPC").select("fqdn", "object_type", "status", "source_hash", "target_hash")


_DRIFT = f"""select a.fqdn, a.object_type, a.ddl as a, b.ddl as b from (select * from ({_FOLDED}) f where env = 'DEV' and obj_exists) a
 join (select * from ({_FOLDED}) f where env = 'SPC' and obj_exists) b on a.fqdn = b.fqdn and a.object_type = b.object_type where a.h is distinct from b.h"""


@query(f"""with p as ({_DRIFT}), l as (select fqdn, object_type, unnest(string_split(coalesce(a, ''), chr(10))) as line, -1 as side from p
  union all select fqdn, object_type, unnest(string_split(coalesce(b, ''), chr(10))), 1 from p)
 select fqdn, object_type, case when sum(side) < 0 then '-' else '+' end as sign, line, cast(abs(sum(side)) as bigint) as copies from l group by fqdn, object_type, line having sum(side) <> 0""")
def parity_changed_lines(c):
    return P.line_diff(P.mismatch_texts(_folded(c), "DEV", "SPC"), ["fqdn", "object_type"], "source_ddl", "target_ddl")


# each supplier's catalogue of parts as a text; then its last line moves to the front and one in the middle goes
_SHELF = """select l_suppkey, array_to_string(list('part ' || p order by p), chr(10)) as a, list('part ' || p order by p) as ls
 from (select distinct l_suppkey, l_partkey as p from @lineitem) l group by l_suppkey having count(*) >= 4"""


@query(f"""with s as ({_SHELF}), n as (select *, cast(len(ls) as bigint) as n from s)
 select l_suppkey, '+' as sign, ls[n] as line, cast(0 as bigint) as old_position, cast(1 as bigint) as new_position from n
 union all select l_suppkey, '-', ls[2], 2, 2 from n
 union all select l_suppkey, '-', ls[n], n, n - 1 from n""")
def moved_lines(c):
    shelf = c["lineitem"].select("l_suppkey", "l_partkey").distinct().groupBy("l_suppkey").agg(F.array_sort(F.collect_list("l_partkey")).alias("p")).where("size(p) >= 4")
    lines = F.transform("p", lambda x: F.concat(F.lit("part "), x))
    moved = F.concat(F.slice(lines, -1, 1), F.slice(lines, 1, 1), F.slice(lines, F.lit(3), F.size(lines) - 3))
    return P.line_edits(shelf.select("l_suppkey", F.array_join(lines, "\n").alias("a"), F.array_join(moved, "\n").alias("b")), ["l_suppkey"], "a", "b")


_SIDE = "select s.*, r.source_name from (select * from @ddl_state where obj_exists and env = '{e}') s join @resolver r on r.fqdn = s.fqdn and r.env = s.env and r.object_type = s.object_type"


@query(f"""select coalesce(a.source_name, b.source_name) as source_name, a.fqdn as source_fqdn, b.fqdn as target_fqdn,
 case when a.fqdn is null then 'MISSING_IN_SOURCE' when b.fqdn is null then 'MISSING_IN_TARGET' when a.current_ddl_hash is not distinct from b.current_ddl_hash then 'MATCH' else 'DDL_HASH_MISMATCH' end as status,
 coalesce(a.object_type <> b.object_type, false) as type_mismatch
 from ({_SIDE.replace('{e}', 'DEV')}) a full join ({_SIDE.replace('{e}', 'PRU')}) b on a.source_name = b.source_name""")
def logical_parity(c):
    return P.logical_parity(c["ddl_state"], c["resolver"], "DEV", "PRU")


@query("select fqdn, string_agg(distinct object_type, ',' order by object_type) as object_types from @ddl_state where obj_exists and env in ('DEV', 'SPC', 'BFM', 'PRU') group by fqdn")
def object_types_per_name(c):
    found = P.known_envs(P.existing(c["ddl_state"]), ENVIRONMENTS)
    return P.types_per_fqdn(found).select("fqdn", F.array_join("object_types", ",").alias("object_types"))


@query("""select fqdn, string_agg(env || '/' || object_type || '/' || coalesce(current_ddl_hash, ''), ';' order by env, object_type) as nested from @ddl_state group by fqdn""")
def records_nested_by_name(c):
    nested = P.nest_by_fqdn(c["ddl_state"])
    flat = nested.select("fqdn", F.explode("envs").alias("env", "types")).select("fqdn", "env", F.explode("types").alias("t", "h"))
    return flat.groupBy("fqdn").agg(F.array_join(F.array_sort(F.collect_list(
        F.concat_ws("/", "env", "t", F.coalesce("h", F.lit(""))))), ";").alias("nested"))


@query("select fqdn, env from @ddl_state where obj_exists and fqdn in (select upper(db_name || '.' || schema_name || '.' || object_name) from @inventory)")
def existing_listed_objects(c):
    listed = c["inventory"].select(F.concat_ws(".", "db_name", "schema_name", "object_name").alias("fqdn"))
    return P.existing(c["ddl_state"], listed).select("fqdn", "env")


_V = "'V' || cast(event_id % 3 as varchar)"
_COLUMNS = f"""select event_id, unnest([1, 2, 3]) as ordinal, unnest(['ID', {_V}, 'W']) as name,
 unnest(['NUMBER(38,0)', 'VARCHAR(' || cast(16 * (1 + event_id % 2) as varchar) || ')', 'TIMESTAMP_LTZ(3)']) as type from @snapshots where ddl is not null"""


@query(f"select event_id, cast(ordinal as bigint) as ordinal, name, type from ({_COLUMNS}) x")
def ddl_columns_of_snapshots(c):
    cols = ddl_columns(c.dealt("snapshots").select("event_id", "ddl"))
    return cols.withColumn("ordinal", F.col("ordinal").cast("long"))


# literals beyond any stack, comments with commas, quoted names with blanks and brackets, two-word types, calls within calls
_AWKWARD = """select c_custkey, unnest([1, 2, 3, 4, 5]) as ordinal, unnest(['COL ' || c_custkey || ', (A', 'B', 'C', 'D', 'E']) as name,
 unnest(['VARCHAR(' || (1 + c_custkey % 9) || ')', 'DOUBLE PRECISION', 'TIMESTAMP(3) WITH TIME ZONE', 'CHARACTER VARYING(12)', 'NUMBER(38,' || (c_custkey % 5) || ')']) as type from @customer"""


@query(f"select c_custkey, cast(ordinal as bigint) as ordinal, name, type from ({_AWKWARD}) x")
def ddl_columns_awkward(c):
    head = F.when(F.col("c_custkey") % 2 == 0, 'create or alter table "My Db"."s"."t, (" (').otherwise("CREATE LOCAL TEMPORARY TABLE IF NOT EXISTS db.t (")
    key = F.col("c_custkey")
    text = F.concat(
        head, F.lit('"Col '), key, F.lit(', (a" varchar( '), 1 + key % 9, F.lit(" ) default '"), F.repeat(F.lit("long, ''text( "), (2000 + key % 100).cast("int")),
        F.lit("', -- a note, not a column int\n b double precision /* x, y int */ not null,\nc timestamp(3) with time zone default f(g(1, h(2, 3)), 'z'), d character varying ( 12 ),"),
        F.lit("\n constraint pk primary key (b, c), e number(38 , "), key % 5, F.lit("), unique (b), check (b > (1 + (2)))) cluster by (b, c)"))
    return ddl_columns(c.dealt("customer").select("c_custkey", text.alias("ddl"))).withColumn("ordinal", F.col("ordinal").cast("long"))


@query("""select page_id, cast(row_number() over (partition by page_id order by p_partkey) as bigint) as ordinal, name, 'VARCHAR(16)' as type from @page_columns""")
def ddl_columns_of_pages(c):
    return ddl_columns(c.dealt("page_ddl")).withColumn("ordinal", F.col("ordinal").cast("long"))


_PAIR = f"""select f.fqdn, f.env, f.ddl as b, f.previous_ddl as a, f.event_id as eb, f.was_at from ({_FOLDED}) f where previous_ddl is not null and ddl is not null"""


def _cols_sql(text):
    inner = f"regexp_extract({text}, 'V([012]) VARCHAR', 1)"
    return f"unnest([1, 2, 3]) as ordinal, unnest(['ID', 'V' || {inner}, 'W']) as name, unnest(['NUMBER(38,0)', 'VARCHAR(' || regexp_extract({text}, 'V[012] VARCHAR.([0-9]+)', 1) || ')', 'TIMESTAMP_LTZ(3)']) as type"


@query(f"""select coalesce(a.fqdn, b.fqdn) as fqdn, coalesce(a.env, b.env) as env, coalesce(a.name, b.name) as name,
 case when a.name is null then 'ADDED' when b.name is null then 'REMOVED' when a.type <> b.type then 'TYPE_CHANGED' else 'MOVED' end as change, a.type as old_type, b.type as new_type
 from (select fqdn, env, {_cols_sql('a')} from ({_PAIR}) p) a full join (select fqdn, env, {_cols_sql('b')} from ({_PAIR}) p) b
 on a.fqdn = b.fqdn and a.env = b.env and a.name = b.name where a.name is null or b.name is null or a.type <> b.type or a.ordinal <> b.ordinal""")
def schema_diff(c):
    both = _folded(c).where("current_ddl is not null and previous_ddl is not null")
    old = ddl_columns(both.select("fqdn", "env", F.col("previous_ddl").alias("ddl")))
    new = ddl_columns(both.select("fqdn", "env", F.col("current_ddl").alias("ddl")))
    return P.schema_diff(old, new, ["fqdn", "env"]).select("fqdn", "env", "name", "change", "old_type", "new_type")


@query(f"""select coalesce(a.fqdn, b.fqdn) as fqdn, coalesce(a.object_type, b.object_type) as object_type, coalesce(a.name, b.name) as name,
 case when a.name is null then 'ADDED' when b.name is null then 'REMOVED' when a.type <> b.type then 'TYPE_CHANGED' else 'MOVED' end as change, a.type as old_type, b.type as new_type
 from (select fqdn, object_type, {_cols_sql('a')} from ({_DRIFT}) p where a is not null) a full join (select fqdn, object_type, {_cols_sql('b')} from ({_DRIFT}) p where b is not null) b
 on a.fqdn = b.fqdn and a.object_type = b.object_type and a.name = b.name where a.name is null or b.name is null or a.type <> b.type or a.ordinal <> b.ordinal""")
def parity_schema_diff(c):
    both = P.mismatch_texts(_folded(c), "DEV", "SPC")
    old, new = (ddl_columns(both.select("fqdn", "object_type", F.col(side).alias("ddl"))) for side in ("source_ddl", "target_ddl"))
    return P.schema_diff(old, new, ["fqdn", "object_type"]).select("fqdn", "object_type", "name", "change", "old_type", "new_type")


@query("""select page_id, 'T_' || cast(page_id as varchar) as table_name, 'CREATE TABLE T_' || cast(page_id as varchar) || ' (' || chr(10) ||
 string_agg('    ' || upper(target_field_name) || ' ' || case when data_type in ('NUMBER(38, 0)', 'integer', 'Float or Number', 'BIGINT') then 'NUMBER(38,0)' when data_type = 'varchar(128)' then 'VARCHAR(128)'
  when data_type = 'timestamp' then 'TIMESTAMP_LTZ' when data_type = 'bool' then 'BOOLEAN' else 'VARCHAR(16777216)' end || case when is_primary_key = 'yes' then ' NOT NULL' else '' end, ',' || chr(10) order by row_ord)
 || coalesce(',' || chr(10) || '    PRIMARY KEY (' || string_agg(case when is_primary_key = 'yes' then upper(target_field_name) end, ', ' order by row_ord) || ')', '') || chr(10) || ');' as ddl from @colspecs group by page_id""")
def render_create(c):
    specs = resolve_types(c["colspecs"], c["type_map"]).select(
        "page_id", F.concat(F.lit("T_"), "page_id").alias("table_name"), "row_ord", "target_field_name", "resolved_type",
        is_yes(F.col("is_primary_key")).alias("is_primary_key"))
    return render.render_create(specs, ["page_id"])

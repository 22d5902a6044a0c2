"""Logical source names resolved to per-environment objects, with validation.

Raw entries are (entry_ord, entry_key, entry_json), one row per canonical entry.
Nothing is raised on a fault: every fault of every entry becomes a row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from schemaward.functions.text import strip
from schemaward.plans.sorted_lists import PART_ITEMS, sorted_parts

_TARGET = "array<struct<env:string,fqdn:string,object_type:string>>"


def _get(v: Column, path: str, kind: str = "variant") -> Column:
    return F.try_variant_get(v, path, kind)


def _kind(v: Column) -> Column:
    """'OBJECT', 'ARRAY', 'STRING', ... of a variant; null when absent."""
    return F.regexp_extract(F.schema_of_variant(v), r"^([A-Z]+)", 1)


def _given(v: Column) -> Column:
    """Present and not empty, false, zero or null."""
    text = F.to_json(v)
    return F.coalesce(~text.isin("null", "{}", "[]", '""', "0", "false"), F.lit(False))


def _three_parts(fqdn: Column) -> Column:
    return F.size(F.split(fqdn, r"\.")) == 3


def _target(env: Column, fqdn: Column, kind: Column) -> Column:
    return F.struct(F.upper(env).alias("env"), F.upper(fqdn).alias("fqdn"),
                    F.upper(F.coalesce(kind, F.lit("TABLE"))).alias("object_type"))


def parse_entries(raw: DataFrame) -> DataFrame:
    """Raw entries with their parts typed; every derivation stays inside the entry's row."""
    v = F.try_parse_json("entry_json")
    parts = raw.select("entry_ord", "entry_key", v.alias("v")).select(
        "*", _get(F.col("v"), "$.aliases").alias("al"), _get(F.col("v"), "$.defaults").alias("de"),
        _get(F.col("v"), "$.specific_environments").alias("sp"))
    return parts.select(
        "entry_ord", "entry_key",
        F.coalesce(_kind(F.col("v")) == "OBJECT", F.lit(False)).alias("is_object"),
        _given(F.col("de")).alias("has_defaults"),
        F.coalesce(_kind(F.col("de")) == "OBJECT", F.lit(False)).alias("defaults_is_object"),
        _get(F.col("de"), "$.environments", "array<string>").alias("default_envs"),
        F.coalesce(_kind(_get(F.col("de"), "$.environments")) == "ARRAY", F.lit(False)).alias("default_envs_is_list"),
        _get(F.col("de"), "$.fqdn", "string").alias("default_fqdn"),
        _get(F.col("de"), "$.object_type", "string").alias("default_type"),
        _given(F.col("sp")).alias("has_specific"),
        F.coalesce(_kind(F.col("sp")) == "OBJECT", F.lit(False)).alias("specific_is_object"),
        F.transform(
            F.map_entries(_get(F.col("sp"), "$", "map<string,variant>")),
            lambda e, i: F.struct(i.alias("i"), F.upper(e["key"]).alias("env"),
                                  _get(e["value"], "$.fqdn", "string").alias("fqdn"),
                                  _get(e["value"], "$.object_type", "string").alias("object_type"))).alias("specific"),
        F.col("al").isNotNull().alias("has_aliases"),
        F.coalesce(_kind(F.col("al")) == "ARRAY", F.lit(False)).alias("aliases_is_list"),
        F.transform(_get(F.col("al"), "$", "array<variant>"),
                    lambda a: F.struct(_kind(a).alias("kind"), _get(a, "$", "string").alias("name"))).alias("aliases"),
    )


def apply_overrides(raw: DataFrame) -> DataFrame:
    """Per canonical entry its names and final targets, specific environments over defaults.

    Yields entry_ord, source_name (upper), aliases (upper), targets. Both sides of
    the override sit in the entry's own row, so no window or join is needed.
    """
    e = parse_entries(raw).where("is_object")
    defaults = F.when(
        F.col("defaults_is_object") & F.col("default_envs_is_list") & _three_parts(F.col("default_fqdn")),
        F.array_distinct(F.transform("default_envs", lambda x: _target(x, F.col("default_fqdn"), F.col("default_type")))))
    usable = F.filter("specific", lambda s: F.coalesce(_three_parts(s["fqdn"]), F.lit(False)))
    last = F.filter(usable, lambda s: ~F.exists(usable, lambda o: (o["env"] == s["env"]) & (o["i"] > s["i"])))
    specific = F.transform(last, lambda s: _target(s["env"], s["fqdn"], s["object_type"]))
    none = F.array().cast(_TARGET)
    rows = e.withColumn("_d", F.coalesce(defaults, none)).withColumn("_s", F.coalesce(specific, none))
    kept = F.filter("_d", lambda d: ~F.exists("_s", lambda s: s["env"] == d["env"]))
    names = F.transform(F.filter("aliases", lambda a: a["kind"] == "STRING"), lambda a: F.upper(a["name"]))
    return rows.select(
        "entry_ord", "entry_key", F.upper("entry_key").alias("source_name"),
        F.coalesce(names, F.array().cast("array<string>")).alias("aliases"),
        F.array_sort(F.concat(kept, "_s")).alias("targets"))


def expand_aliases(entries: DataFrame) -> DataFrame:
    """Flat resolver (source_name, env, fqdn, object_type) over canonical names and aliases."""
    names = F.array_union(F.array("source_name"), "aliases")
    return entries.select(F.explode(names).alias("source_name"), "targets") \
        .select("source_name", F.inline("targets")).distinct()


def load_resolver(raw: DataFrame) -> DataFrame:
    """S4 -> W4 -> U1: raw entries to the flat resolver."""
    return expand_aliases(apply_overrides(raw))


# --- validation ---------------------------------------------------------------

def _issue(rule: str, bad: Column, detail: Column) -> Column:
    return F.when(bad, F.struct(F.lit(rule).alias("rule"), detail.alias("detail")))


def entry_faults(raw: DataFrame) -> DataFrame:
    """V1-V5 and V8: faults visible inside one entry, in one pass over the entries."""
    e = parse_entries(raw)
    ok = F.col("is_object")
    bad_defaults = F.col("has_defaults") & ~(
        F.col("defaults_is_object") & F.col("default_envs_is_list") & F.col("default_fqdn").isNotNull())
    bad_specific = F.col("has_specific") & ~F.col("specific_is_object")
    specific = F.when(F.col("has_specific"), F.col("specific"))
    no_env = ~F.col("has_specific") & (~F.col("has_defaults") | (~bad_defaults & (F.size("default_envs") == 0)))
    no_text = F.lit("")

    single = F.array_compact(F.array(
        _issue("V1", ~ok, F.lit("entry is not an object")),
        _issue("V2", ok & bad_defaults, F.lit("defaults need environments (list) and fqdn")),
        _issue("V3", ok & F.col("has_defaults") & ~bad_defaults & ~_three_parts(F.col("default_fqdn")),
               F.concat(F.lit("defaults: "), F.coalesce("default_fqdn", no_text))),
        _issue("V4", ok & bad_specific, F.lit("specific_environments is not an object")),
        _issue("V5", ok & no_env, F.lit("no environment")),
        _issue("V8", ok & F.col("has_aliases") & ~F.col("aliases_is_list"), F.lit("aliases is not a list")),
    ))
    per_env = F.transform(
        F.filter(specific, lambda s: ~F.coalesce(_three_parts(s["fqdn"]), F.lit(False))),
        lambda s: F.struct(F.when(s["fqdn"].isNull(), "V4").otherwise("V3").alias("rule"),
                           F.concat(s["env"], F.lit(": "), F.coalesce(s["fqdn"], F.lit("no fqdn"))).alias("detail")))
    per_alias = F.transform(
        F.filter("aliases", lambda a: a["kind"] != "STRING"),
        lambda a: F.struct(F.lit("V8").alias("rule"), F.concat(F.lit("alias is "), a["kind"]).alias("detail")))
    none = F.array().cast("array<struct<rule:string,detail:string>>")
    faults = F.concat(single, F.coalesce(F.when(ok, per_env), none), F.coalesce(F.when(ok, per_alias), none))
    return e.select(F.col("entry_key").alias("key"), F.inline(faults)).select("rule", "key", "detail")


def _occurrences(raw: DataFrame) -> DataFrame:
    """One row per use of a name, as canonical key or alias, with its target signature."""
    if "path" in raw.columns:  # ordinals begin anew in every document
        raw = raw.withColumn("entry_ord", F.struct("path", "entry_ord"))
    entries = apply_overrides(raw).withColumn("sig", F.to_json("targets"))
    uses = F.concat(F.array(F.struct(F.col("source_name").alias("name"), F.lit(0).alias("is_alias"))),
                    F.transform("aliases", lambda a: F.struct(a.alias("name"), F.lit(1).alias("is_alias"))))
    return entries.select("entry_ord", "sig", F.inline(uses))


def name_faults(raw: DataFrame) -> DataFrame:
    """V6 and V7 from one combinable aggregation over all uses of every name."""
    alias = F.col("is_alias") == 1
    uses = _occurrences(raw).groupBy("name").agg(
        F.sum(1 - F.col("is_alias")).alias("keys"),
        F.min_by("sig", F.struct("entry_ord", "is_alias")).alias("first_sig"),
        F.min(F.when(alias, F.col("sig"))).alias("low"), F.max(F.when(alias, F.col("sig"))).alias("high"),
        F.min(F.when(alias, F.col("entry_ord"))).alias("alias_at"),
        F.max(F.when(~alias, F.col("entry_ord"))).alias("key_at"),
    )
    shadowed = F.coalesce(F.col("key_at") > F.col("alias_at"), F.lit(False))
    conflict = F.coalesce((F.col("low") != F.col("first_sig")) | (F.col("high") != F.col("first_sig")), F.lit(False))
    faults = F.array_compact(F.array(
        _issue("V6", F.col("keys") > 1, F.concat(F.lit("defined "), F.col("keys"), F.lit(" times"))),
        _issue("V6", shadowed, F.lit("also an alias of an earlier entry")),
        _issue("V7", conflict, F.lit("alias of entries with different targets")),
    ))
    return uses.select(F.col("name").alias("key"), F.inline(faults)).select("rule", "key", "detail")


def validate_resolver(raw: DataFrame) -> DataFrame:
    """V1-V8: all faults as (rule, key, detail)."""
    return entry_faults(raw).unionByName(name_faults(raw))


def dup_keys(raw: DataFrame, key: str = "entry_key") -> DataFrame:
    """A12 (and V10): keys that collide after upper-casing."""
    return raw.groupBy(F.upper(key).alias("key")).agg(F.count("*").alias("n")).where("n > 1")


def alias_conflicts(raw: DataFrame) -> DataFrame:
    """Aliases pointing to more than one target set."""
    return (_occurrences(raw).where("is_alias = 1").groupBy(F.col("name").alias("alias"))
            .agg(F.count_distinct("sig").alias("target_sets")).where("target_sets > 1"))


def validate_type_map(raw: DataFrame) -> DataFrame:
    """V9 and V10 over raw (map_key, map_value) pairs."""
    empty = raw.where(F.coalesce(strip(F.col("map_value")), F.lit("")) == "").select(
        F.lit("V9").alias("rule"), F.upper("map_key").alias("key"), F.lit("empty value").alias("detail"))
    clash = dup_keys(raw, "map_key").select(
        F.lit("V10").alias("rule"), "key", F.concat(F.lit("defined "), F.col("n"), F.lit(" times")).alias("detail"))
    return empty.unionByName(clash)


# --- use ----------------------------------------------------------------------

def distinct_sources(specs: DataFrame) -> DataFrame:
    """A1: source names used by declared columns, trimmed, upper-cased, blanks dropped."""
    return specs.select(F.upper(strip(F.col("source_table"))).alias("source_name")).where("source_name <> ''").distinct()


def resolve_sources(names: DataFrame, resolver: DataFrame) -> DataFrame:
    """Names the resolver knows, with every environment's object."""
    return names.join(resolver, "source_name")


def unresolved(names: DataFrame, resolver: DataFrame) -> DataFrame:
    """Names the resolver does not know."""
    return names.join(resolver.select("source_name"), "source_name", "left_anti")


def unresolved_as_difference(names: DataFrame, resolver: DataFrame) -> DataFrame:
    """C6 as a set difference."""
    return names.select("source_name").subtract(resolver.select("source_name"))


def unused_entries(resolver: DataFrame, names: DataFrame, canonical: DataFrame | None = None) -> DataFrame:
    """Resolver entries none of whose objects any used name resolves to.

    ``canonical`` (source_name) holds the entries' own names, see ``apply_overrides``; without it aliases are listed too.
    """
    used = resolve_sources(names, resolver).select("fqdn").distinct()
    touched = resolver.join(used, "fqdn", "left_semi").select("source_name")
    listed = resolver if canonical is None else canonical
    return listed.select("source_name").distinct().join(touched, "source_name", "left_anti")


def env_grid(names: DataFrame, envs: list[str], resolver: DataFrame) -> DataFrame:
    """Resolved names times environments, left-joined to their objects.

    The environments are a parameter list, so the product is an explode.
    """
    known = names.join(resolver.select("source_name"), "source_name", "left_semi")
    grid = known.select("source_name", F.explode(F.array(*[F.lit(e.upper()) for e in envs])).alias("env"))
    return grid.join(resolver, ["source_name", "env"], "left")


def resolver_items(names: DataFrame, resolver: DataFrame, canonical: DataFrame | None = None) -> DataFrame:
    """A9 as rows: (section, item) for resolved objects, unresolved names and unused entries.

    The lists may be as long as the inputs, so they stay rows instead of arrays.
    """
    resolved = resolve_sources(names, resolver).select("fqdn").distinct()
    return (
        resolved.select(F.lit("resolved_fqdns").alias("section"), F.col("fqdn").alias("item"))
        .unionByName(unresolved(names, resolver).select(F.lit("unresolved_sources").alias("section"),
                                                        F.col("source_name").alias("item")))
        .unionByName(unused_entries(resolver, names, canonical).select(F.lit("unused_entries").alias("section"),
                                                            F.col("source_name").alias("item")))
    )


def resolver_summary(names: DataFrame, resolver: DataFrame, canonical: DataFrame | None = None) -> DataFrame:
    """A9 counts per section."""
    return resolver_items(names, resolver, canonical).groupBy("section").agg(F.count("*").alias("n"))


def resolver_lists(names: DataFrame, resolver: DataFrame, canonical: DataFrame | None = None, items: int = PART_ITEMS) -> DataFrame:
    """A9 as sorted lists: (section, part, total, items), at most ``items`` entries in an array."""
    return sorted_parts(resolver_items(names, resolver, canonical), ["section"], "item", items)


def generation_gate(missing: DataFrame) -> DataFrame:
    """A10: one row telling whether generation may start: no unresolved name."""
    return missing.agg(F.count("*").alias("unresolved")).withColumn("may_generate", F.col("unresolved") == 0)

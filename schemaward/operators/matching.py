"""Declared columns mapped to the columns of the objects behind their page.

All tables here grow with the pages, and their rows shrink so well in files and shuffles that the planner takes them for
small ones; joins name the merge join, so that no hash table of theirs is built in the driver.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from schemaward import constants as K
from schemaward import schemas as S
from schemaward.functions.ddl import ddl_column_array
from schemaward.functions.similarity import best_choice, check_strategy, mapping_status
from schemaward.functions.text import is_yes, strip
from schemaward.functions.types import resolve_types
from schemaward.operators.pages import columns_to_map

KEY = S.MAPPING_KEY
_OBJECT = ["fqdn", "env", "object_type"]


@dataclass(frozen=True)
class MatchSettings:
    """Mapper settings; the threshold is clamped to 0-100."""

    threshold: float = K.MATCH_THRESHOLD
    strategy: str = K.MATCH_STRATEGY
    exact_only: bool = False

    def __post_init__(self):
        object.__setattr__(self, "threshold", float(max(0, min(100, self.threshold))))
        object.__setattr__(self, "strategy", check_strategy(self.strategy))


def first_source(specs: DataFrame) -> DataFrame:
    """First non-empty source table of each page, trimmed and upper-cased."""
    named = specs.where(F.coalesce("source_table", F.lit("")) != "")
    return named.groupBy("page_id").agg(F.upper(strip(F.min_by("source_table", "row_ord"))).alias("source_name"))


def page_objects(specs: DataFrame, envs: list[str], resolver: DataFrame) -> DataFrame:
    """Objects behind each page in the checked environments."""
    known = resolver.where(F.col("env").isin(*[e.upper() for e in envs]))
    return first_source(specs).join(known.hint("merge"), "source_name").select("page_id", *_OBJECT)


def with_current_ddl(grid: DataFrame, ddl_state: DataFrame) -> DataFrame:
    """Adds the stored DDL text and fingerprint; objects without either fall out."""
    usable = ddl_state.where("current_ddl <> '' and current_ddl_hash <> ''")
    return grid.join(usable.select(*_OBJECT, "current_ddl", "current_ddl_hash").hint("merge"), _OBJECT)


def with_current_hash(grid: DataFrame, ddl_state: DataFrame) -> DataFrame:
    """C16 without the texts: adds the fingerprint; objects without stored DDL fall out."""
    usable = ddl_state.where("current_ddl <> '' and current_ddl_hash <> ''")
    return grid.join(usable.select(*_OBJECT, "current_ddl_hash").hint("merge"), _OBJECT)


def without_ddl(grid: DataFrame, ddl_state: DataFrame) -> DataFrame:
    """C16, the skip list: objects without stored DDL."""
    usable = ddl_state.where("current_ddl <> '' and current_ddl_hash <> ''")
    return grid.join(usable.select(*_OBJECT).hint("merge"), _OBJECT, "left_anti")


def column_names(ddl: Column) -> Column:
    """Column names of a DDL text, in DDL order."""
    return F.transform(ddl_column_array(ddl), lambda c: c["name"])


def choices_by_ddl(ddl: DataFrame) -> DataFrame:
    """Column names per distinct DDL text; texts without columns fall out."""
    texts = ddl.groupBy("current_ddl_hash").agg(F.first("current_ddl").alias("current_ddl"))
    return texts.select("current_ddl_hash", column_names(F.col("current_ddl")).alias("choices")).where(F.size("choices") > 0)


def mapping_skips(specs: DataFrame, envs: list[str], resolver: DataFrame, ddl_state: DataFrame) -> DataFrame:
    """Why pages, or pages in an environment, are not mapped: (page_id, env, reason), env null for reasons of the page.

    Reasons: NO_FLAGGED_COLUMNS, NO_SOURCE_TABLE and SOURCE_UNKNOWN of a page; NO_OBJECT, NO_DDL and NO_DDL_COLUMNS of
    a page in an environment. The environments are a list, so the grid is an explode.
    """
    def rows(df: DataFrame, reason: str, env: Column | None = None) -> DataFrame:
        return df.select("page_id", (F.lit(None).cast("string") if env is None else env).alias("env"), F.lit(reason).alias("reason")).distinct()

    pages = specs.groupBy("page_id").agg(F.max(F.coalesce(is_yes(F.col("add_source_to_target")), F.lit(False))).alias("flagged"))
    named = pages.join(first_source(specs).hint("merge"), "page_id", "left")
    names = resolver.select("source_name").distinct().withColumn("known", F.lit(True))
    placed = named.where("source_name is not null").join(names.hint("merge"), "source_name", "left")
    grid = placed.where("known").select("page_id", "source_name", F.explode(F.array(*[F.lit(e.upper()) for e in envs])).alias("env"))
    found = grid.join(resolver.select("source_name", *_OBJECT).hint("merge"), ["source_name", "env"], "left")
    usable = ddl_state.where("current_ddl <> '' and current_ddl_hash <> ''")
    with_ddl = found.where("fqdn is not null").join(usable.select(*_OBJECT, "current_ddl_hash").hint("merge"), _OBJECT, "left")
    readable = choices_by_ddl(usable).select("current_ddl_hash", F.lit(True).alias("readable"))
    read = with_ddl.where("current_ddl_hash is not null").join(readable.hint("merge"), "current_ddl_hash", "left")
    env = F.col("env")
    parts = [rows(pages.where(~F.col("flagged")), "NO_FLAGGED_COLUMNS"), rows(named.where("source_name is null"), "NO_SOURCE_TABLE"),
             rows(placed.where("known is null"), "SOURCE_UNKNOWN"), rows(found.where("fqdn is null"), "NO_OBJECT", env),
             rows(with_ddl.where("current_ddl_hash is null"), "NO_DDL", env), rows(read.where("readable is null"), "NO_DDL_COLUMNS", env)]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def match_candidates(specs: DataFrame, objects: DataFrame) -> DataFrame:
    """Every flagged column next to each object of its page, choices as one array.

    ``objects``: page_id, object key, current_ddl_hash, current_ddl.
    """
    return columns_to_map(specs).join(objects.drop("current_ddl").hint("merge"), "page_id").join(choices_by_ddl(objects).hint("merge"), "current_ddl_hash")


def best_matches(wanted: DataFrame, choices: DataFrame, settings: MatchSettings) -> DataFrame:
    """Best choice per distinct (name, DDL); names and texts repeat across pages and environments.

    ``wanted``: source_field_name, current_ddl_hash. Null score: nothing reached the threshold.
    """
    pairs = wanted.select(F.upper("source_field_name").alias("name"), "current_ddl_hash").distinct()
    best = best_choice(settings.strategy, settings.threshold, F.col("name"), F.col("choices"))
    scored = pairs.join(choices.hint("merge"), "current_ddl_hash").select("name", "current_ddl_hash", best.alias("b"))
    return scored.select("name", "current_ddl_hash", F.col("b.matched_column").alias("matched_column"),
                         F.col("b.score").alias("match_score"))


def with_prev_map(new: DataFrame, prev: DataFrame) -> DataFrame:
    """C14: adds the previous mapping of the same key as struct ``old``."""
    kept = ["matched_column", "match_score", "match_strategy", "mapping_status", "ddl_hash_at_mapping", "notes",
            "user_override"]
    return new.join(prev.select(*KEY, F.struct(*kept).alias("old")).hint("merge"), KEY, "left")


def _score_text(score: Column) -> Column:
    return F.concat(F.round(score, 2).cast("string"), F.lit("%"))


def map_columns(specs: DataFrame, objects: DataFrame, prev: DataFrame, titles: DataFrame, type_map: DataFrame,
                as_of: str, settings: MatchSettings = MatchSettings(), choices: DataFrame | None = None) -> DataFrame:
    """M7: next mapping state.

    ``objects``: page_id, object key, current_ddl_hash, and current_ddl (see ``with_current_ddl``) unless ``choices``
    (see ``choices_by_ddl``) are given; ``titles``: page_id, page_title. User overrides and good matches against an
    unchanged DDL keep their match; everything else is matched again.
    """
    now = F.lit(as_of).cast("timestamp_ntz")
    choices = choices_by_ddl(objects) if choices is None else choices
    usable = objects.join(choices.select("current_ddl_hash").hint("merge"), "current_ddl_hash", "left_semi")
    # a target named twice on a page is mapped from its last row
    named = columns_to_map(specs).groupBy("page_id", "target_field_name").agg(
        F.max_by(F.struct(*[c for c in specs.columns if c not in ("page_id", "target_field_name")]), "row_ord").alias("s"))
    flagged = resolve_types(named.select("page_id", "target_field_name", "s.*"), type_map).join(titles.hint("merge"), "page_id", "left")
    found = flagged.join(usable.select("page_id", *_OBJECT, "current_ddl_hash").hint("merge"), "page_id").withColumn("new", F.lit(True))
    # one full outer join on unique keys serves both the previous match and the rows no longer mapped
    rest = [c for c in S.COLUMN_MAP.names if c not in KEY]
    rows = found.join(prev.select(*KEY, F.struct(*rest).alias("old")).hint("merge"), KEY, "full_outer")
    new, override = F.col("new").isNotNull(), F.coalesce(F.col("old.user_override"), F.lit(False))
    unchanged = F.coalesce((F.col("old.ddl_hash_at_mapping") == F.col("current_ddl_hash"))
                           & F.col("old.mapping_status").isin("MAPPED_EXACT", "MAPPED_FUZZY"), F.lit(False))
    rows = rows.withColumn("search", new & ~override & ~unchanged)
    best = best_matches(rows.where("search"), choices, settings)
    # rows without a search get a name of their own that matches nothing: null keys would all meet in one task
    own = F.concat(F.lit("\0"), F.col("page_id").cast("string"), F.lit("\0"), "target_field_name")
    rows = rows.withColumn("name", F.when(F.col("search"), F.upper("source_field_name")).otherwise(own)) \
        .withColumn("current_ddl_hash", F.coalesce("current_ddl_hash", F.lit(""))).join(best.hint("merge"), ["name", "current_ddl_hash"], "left")

    score = F.col("match_score")
    status = mapping_status(score, settings.exact_only)
    shown = F.concat(F.lit("'"), F.col("source_field_name"), F.lit("' to '"), F.col("matched_column"), F.lit("'."))
    notes = (
        F.when(status == "UNMAPPED_LOW_SCORE", F.lit(f"No match found above threshold ({settings.threshold:g}%)."))
        .when(status == "UNMAPPED_NOT_EXACT",
              F.concat(F.lit("Fuzzy match ("), _score_text(score), F.lit(") below 100% exact_match_only threshold.")))
        .when(status == "MAPPED_EXACT", F.concat(F.lit("Exact match found for "), shown))
        .otherwise(F.concat(F.lit("Fuzzy match ("), _score_text(score), F.lit(") for "), shown))
    )
    title = F.coalesce("page_title", F.concat(F.lit("Page ID:"), F.col("page_id").cast("string")))
    always = {
        "page_title": title, "is_primary_key": is_yes(F.col("is_primary_key")), "ddl_hash_at_mapping": F.col("current_ddl_hash"),
        "last_mapped_on": now, "user_override": override, "is_active": F.lit(True),
        **{c: F.col(c) for c in ("source_field_name", "data_type", "resolved_type", "definition", "comments")},
    }
    searched = {
        "matched_column": F.col("matched_column"), "match_score": score, "mapping_status": status, "notes": notes,
        "match_strategy": F.when(score.isNotNull(), F.lit(settings.strategy)),
    }
    values = {c: F.when(new, v) for c, v in always.items()} | {c: F.when(F.col("search"), v) for c, v in searched.items()}
    return rows.select(*KEY, *[values[c].otherwise(F.col(f"old.{c}")).alias(c) for c in rest]).select(*S.COLUMN_MAP.names)


def orphan_mappings(column_map: DataFrame, specs: DataFrame, objects: DataFrame | None = None) -> DataFrame:
    """Active mappings whose target name left the page, per page and object.

    ``objects`` (page_id, object key) limits the check to objects handled in this run.
    """
    live = column_map.where("is_active")
    if objects is not None:
        live = live.join(objects.select("page_id", *_OBJECT).hint("merge"), ["page_id", *_OBJECT], "left_semi")
    return live.join(specs.select("page_id", "target_field_name").hint("merge"), ["page_id", "target_field_name"], "left_anti")


def deactivate_orphans(column_map: DataFrame, specs: DataFrame, as_of: str, objects: DataFrame | None = None) -> DataFrame:
    """M8: orphans become inactive; user overrides stay active and are only marked as checked.

    C15 as flags on two left joins, so that the mapping state is read once.
    """
    here = F.lit(True)
    listed = specs.select("page_id", "target_field_name").distinct().withColumn("_listed", here)
    rows = column_map.join(listed.hint("merge"), ["page_id", "target_field_name"], "left")
    handled = F.lit(True)
    if objects is not None:
        rows = rows.join(objects.select("page_id", *_OBJECT).distinct().withColumn("_handled", here).hint("merge"), ["page_id", *_OBJECT], "left")
        handled = F.col("_handled").isNotNull()
    orphan = F.col("is_active") & handled & F.col("_listed").isNull()
    off = orphan & ~F.col("user_override")
    over = {
        "last_mapped_on": F.when(orphan, F.lit(as_of).cast("timestamp_ntz")).otherwise(F.col("last_mapped_on")),
        "is_active": F.col("is_active") & ~off,
        "mapping_status": F.when(off, "INACTIVE_ORPHANED").otherwise(F.col("mapping_status")),
        "notes": F.when(off, "Automatically marked as inactive: column removed from page.").otherwise(F.col("notes")),
    }
    return rows.select(*[over[c].alias(c) if c in over else F.col(c) for c in column_map.columns])

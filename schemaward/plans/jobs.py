"""Whole jobs, one plan each, without loops over pages or objects."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from schemaward import schemas as S
from schemaward.operators import catalog, ddl_history, ingest, matching, pages, resolver, titles
from schemaward.operators.matching import MatchSettings


def find_pages(title_list: DataFrame, page_list: DataFrame, prev_report: DataFrame, as_of: str,
               approvals: DataFrame | None = None) -> DataFrame:
    """Titles to the hit/miss report: C1 for titles that still need a search, then C4."""
    found = titles.find_titles(titles.to_search(title_list, prev_report), page_list)
    return titles.merge_report(title_list, prev_report, found, as_of, approvals)


def parse_run(meta: DataFrame, docs: DataFrame, content: DataFrame, as_of: str) -> tuple[DataFrame, DataFrame]:
    """Queue, bodies, page tables and both state updates: (metadata, parsed content).

    Pages with an unchanged hash never reach the HTML tokenizer.
    """
    queue = ingest.parse_queue(meta).select(
        "page_id", F.coalesce(F.nullif("api_title", F.lit("")), "found_title").alias("title"))
    bodies = queue.join(ingest.page_bodies(docs), "page_id", "left").withColumn(
        "outcome", F.coalesce("outcome", F.lit("API_ERROR")))
    parsed = pages.parsed_pages(bodies)
    broken = (F.col("outcome") == "OK") & F.col("failure").isNotNull()
    parsed = parsed.withColumn("outcome", F.when(broken, "PARSE_ERROR").otherwise(F.col("outcome")))
    results = parsed.select("page_id", "outcome", F.col("page.metadata.table_name").alias("table_name"), F.when(broken, F.col("failure")).alias("detail"))
    fresh = parsed.where("outcome = 'OK'").select(
        "page_id", F.to_json("page", {"ignoreNullFields": "false"}).alias("parsed_json"),
        F.lit(as_of).cast("timestamp_ntz").alias("parsed_date"))
    # one full outer join on unique keys, so that the pages are tokenized once for the stored content
    old = content.select("page_id", F.struct("parsed_json", "parsed_date").alias("old"))
    stored = old.join(fresh.select("page_id", F.struct("parsed_json", "parsed_date").alias("new")), "page_id", "full_outer")
    return ingest.apply_parse_result(meta, results, as_of), stored.select("page_id", F.coalesce("new", "old").alias("c")).select("page_id", "c.*")


def check_sources(specs: DataFrame, flat_resolver: DataFrame, envs: list[str], inventory: DataFrame) -> DataFrame:
    """Names -> grid -> existence: A1, C5, C8, F11, C10 as one plan."""
    names = resolver.distinct_sources(specs)
    grid = resolver.env_grid(names, envs, flat_resolver).where(F.col("fqdn").isNotNull())
    return catalog.check_existence(grid, inventory)


def check_and_store(specs: DataFrame, flat_resolver: DataFrame, envs: list[str], inventory: DataFrame,
                    ddl: DataFrame, state: DataFrame, as_of: str) -> DataFrame:
    """M9: the existence check merged into the DDL state.

    ``ddl``: key and ddl text of objects that could be read.
    """
    checked = check_sources(specs, flat_resolver, envs, inventory)
    objects = checked.groupBy(*S.OBJECT_KEY, "db_name", "schema_name", "object_name").agg(F.max("obj_exists").alias("obj_exists"))
    read = objects.join(ddl.select(*S.OBJECT_KEY, "ddl"), S.OBJECT_KEY, "left")
    snapshot = read.withColumn("ddl", F.when(F.col("obj_exists"), F.col("ddl"))) \
        .withColumn("notes", catalog.absence_note(read, F.lit("")))
    return ddl_history.merge_ddl(state, snapshot, as_of)


def map_run(meta: DataFrame, content: DataFrame, flat_resolver: DataFrame, envs: list[str], ddl_state: DataFrame,
            prev_map: DataFrame, type_map: DataFrame, as_of: str,
            settings: MatchSettings = MatchSettings()) -> DataFrame:
    """Column mapping from state tables to the next mapping state: F14, S8, F4, W2, C16, M7, M8."""
    chosen = ingest.mappable(meta, content)
    records = pages.primary_table(ingest.explode_parsed(chosen.select("page_id", "parsed_json")))
    specs = pages.colspecs(records)
    names = meta.select("page_id", F.col("api_title").alias("page_title"))
    return map_specs(specs, names, flat_resolver, envs, ddl_state, prev_map, type_map, as_of, settings)


def map_specs(specs: DataFrame, names: DataFrame, flat_resolver: DataFrame, envs: list[str], ddl_state: DataFrame,
              prev_map: DataFrame, type_map: DataFrame, as_of: str,
              settings: MatchSettings = MatchSettings()) -> DataFrame:
    """The mapping job on declared columns: W2, C16, M7, M8."""
    grid = matching.with_current_hash(matching.page_objects(specs, envs, flat_resolver), ddl_state)
    # a text is read once however many pages refer to it; objects without columns are skipped by both steps
    wanted = ddl_state.join(grid.select("current_ddl_hash").distinct().hint("merge"), "current_ddl_hash", "left_semi")
    choices = matching.choices_by_ddl(wanted)
    objects = grid.join(choices.select("current_ddl_hash").hint("merge"), "current_ddl_hash", "left_semi")
    mapped = matching.map_columns(specs, objects, prev_map, names, type_map, as_of, settings, choices)
    return matching.deactivate_orphans(mapped, specs, as_of, objects)

"""Report over declared data types: where they are used and what they resolve to."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from schemaward.functions.text import strip
from schemaward.functions.types import resolve_types
from schemaward.operators.ingest import with_title
from schemaward.plans.sorted_lists import PART_ITEMS, sorted_parts


def types_by_page(specs: DataFrame, meta: DataFrame) -> DataFrame:
    """A2: each declared type with each page title using it, once.

    One type may occur on most pages, so its set of pages stays rows;
    ``types_by_page_lists`` gives the sorted listing. The pairs are reduced before the title join.
    """
    used = specs.select("page_id", strip(F.col("data_type")).alias("data_type")).where("data_type <> ''").distinct()
    return with_title(used, meta).select("data_type", "page_title").distinct()


def types_by_page_lists(specs: DataFrame, meta: DataFrame, items: int = PART_ITEMS) -> DataFrame:
    """A2 as sorted lists: (data_type, part, total, items), at most ``items`` page titles in an array."""
    return sorted_parts(types_by_page(specs, meta), ["data_type"], "page_title", items)


def type_report(specs: DataFrame, meta: DataFrame, type_map: DataFrame) -> DataFrame:
    """Per declared type: number of pages, resolved type, category and notes."""
    counts = types_by_page(specs, meta).groupBy("data_type").agg(F.count("*").alias("pages"))
    return resolve_types(counts, type_map).select(
        "data_type", "pages", "resolved_type", F.col("type_category").alias("category"),
        F.when(F.size("type_warnings") == 0, "Mapped via the type map")
        .otherwise(F.array_join("type_warnings", "; ")).alias("notes"))
